"""The commit log: crashes at every step, writers at once, gathering, views that follow."""

import threading
from datetime import date

import pytest

from gradeledger.plans import run_report_p
from gradeledger.sources import (
    PublishConflict,
    append_audit,
    commits,
    read_audit,
    read_report,
    register_view,
    sinks,
    write_report,
)
from gradeledger.sources.commits import CommitLog, Files
from helpers import CFG
from test_jobs import clock, world

DAY, BEFORE, LATER = CFG.ref_date, date(2022, 9, 29), date(2024, 9, 29)
STEPS = ("write", "give", "delete")


class Killed(BaseException):
    """The process ends here: nothing that handles errors may see it."""


def report(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def values(df):
    return sorted(r.v for r in df.collect())


def dies_at(monkeypatch, step, after):
    """Lets the ``step``-th change to the log's files be the last thing that happens."""
    done = {"n": 0}

    def wrap(name):
        real = getattr(Files, name)

        def work(self, *args):
            if done["n"] > step:
                raise Killed
            done["n"] += 1
            if done["n"] > step and not after:
                raise Killed
            result = real(self, *args)
            if done["n"] > step:
                raise Killed
            return result

        monkeypatch.setattr(Files, name, work)

    for name in STEPS:
        wrap(name)


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("gathers", [False, True])
def test_a_crash_at_any_step_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, after, gathers):
    died, published = 0, []
    for step in range(40):
        path = f"{tmp_path}/r{step}"
        write_report(report(spark, "2021"), path, BEFORE)
        write_report(report(spark, "old"), path, DAY)
        with monkeypatch.context() as patch:
            patch.setattr(commits, "COMPACT_EVERY", 3 if gathers else 50)
            dies_at(patch, step, after)
            try:
                write_report(report(spark, "new"), path, DAY, audit=lambda n: {"LogMessage": "new"})
            except Killed:
                died += 1
            else:
                break
        dated, default = values(read_report(spark, path, DAY)), values(read_report(spark, path))
        assert dated == default and dated in (["old"], ["new"])
        assert values(read_report(spark, path, BEFORE)) == ["2021"]
        told = [r.LogMessage for r in read_audit(spark, path).collect()]
        assert told == (["new"] if dated == ["new"] else [])
        published.append(dated == ["new"])
        # the next run isn't hindered
        write_report(report(spark, "next"), path, DAY)
        assert values(read_report(spark, path)) == ["next"]
    else:
        raise AssertionError("never ran through")
    assert died >= (8 if gathers else 3) and published == sorted(published) and len({*published}) == 2


def test_of_two_runs_of_a_date_the_slower_one_fails(spark, tmp_path):
    path = f"{tmp_path}/r"
    write_report(report(spark, "first"), path, DAY)

    def meanwhile(count):
        write_report(report(spark, "fast"), path, DAY)
        return {"LogMessage": "slow"}

    with pytest.raises(PublishConflict, match="another run"):
        write_report(report(spark, "slow"), path, DAY, audit=meanwhile)
    assert values(read_report(spark, path)) == ["fast"]
    assert read_audit(spark, path).count() == 0
    assert sinks.drop_old_runs(spark, path) == 1  # "first"; the loser left nothing
    assert values(read_report(spark, path)) == ["fast"]


def test_runs_of_other_dates_do_not_conflict(spark, tmp_path):
    path = f"{tmp_path}/r"

    def meanwhile(count):
        write_report(report(spark, "later"), path, LATER)
        return {"LogMessage": "own"}

    write_report(report(spark, "own"), path, DAY, audit=meanwhile)
    assert values(read_report(spark, path, DAY)) == ["own"] and values(read_report(spark, path)) == ["later"]


def test_a_job_that_loses_says_so(spark, tmp_path, monkeypatch):
    out, source, real = str(tmp_path), world(spark), sinks.CommitLog.commit
    seen = []

    def commit(self, entry, check=None):
        if check is not None and not seen:
            seen.append(entry["run"])
            write_report(report(spark, "fast"), f"{out}/report_p", DAY)
        return real(self, entry, check)

    monkeypatch.setattr(sinks.CommitLog, "commit", commit)
    assert run_report_p(spark, source, DAY, out, clock=clock) is False
    assert values(read_report(spark, f"{out}/report_p")) == ["fast"]
    (told,) = read_audit(spark, f"{out}/report_p").collect()
    assert "another run" in told.LogMessage and told.TargetTableCount == 0


def test_no_entry_of_many_writers_is_lost(spark, tmp_path, monkeypatch):
    """Writers at once, while entries are gathered under them."""
    monkeypatch.setattr(commits, "COMPACT_EVERY", 4)
    path, failures = f"{tmp_path}/r", []

    def writer(w):
        try:
            for i in range(12):
                append_audit(spark, path, {"LogMessage": f"{w}-{i}"})
        except Exception as failure:
            failures.append(failure)

    threads = [threading.Thread(target=writer, args=(w,)) for w in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failures
    entries = CommitLog(spark, path).entries()
    assert [e["n"] for e in entries] == list(range(1, 61))
    wanted = sorted(f"{w}-{i}" for w in range(5) for i in range(12))
    assert sorted(e["audit"]["LogMessage"] for e in entries) == wanted
    assert sorted(r.LogMessage for r in read_audit(spark, path).collect()) == wanted


def test_a_number_that_was_gathered_is_not_used_again(spark, tmp_path, monkeypatch):
    """A writer that slept since before entries were gathered puts a number that is free again."""
    path = f"{tmp_path}/r"
    for i in range(3):
        append_audit(spark, path, {"LogMessage": str(i)})
    slow, real = CommitLog(spark, path), CommitLog.state
    stale = [slow.state()]
    for i in range(3, 6):
        append_audit(spark, path, {"LogMessage": str(i)})
    CommitLog(spark, path).compact()
    monkeypatch.setattr(CommitLog, "state", lambda self: stale.pop() if self is slow and stale else real(self))
    assert slow.commit({"audit": {"LogMessage": "slow"}}) == 7
    assert [e["n"] for e in slow.entries()] == list(range(1, 8))


def test_many_runs_leave_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "COMPACT_EVERY", 10)
    path = f"{tmp_path}/r"
    write_report(report(spark, "kept"), path, DAY)
    for i in range(95):
        append_audit(spark, path, {"LogMessage": str(i)})
    assert len(list((tmp_path / "r" / "_log").glob("[!.]*"))) <= 10
    assert read_audit(spark, path).count() == 95
    assert values(read_report(spark, path)) == ["kept"]


def test_put_new_by_rename(spark, tmp_path):
    """The way of file systems without links."""
    files = Files(spark, f"{tmp_path}/log")
    files.local = False
    assert files.put_new("a", "one") and not files.put_new("a", "two")
    assert files.text("a") == "one" and [n for n in files.names() if not n.startswith(".")] == ["a"]


def test_a_view_follows_runs_that_do_not_know_it(spark, tmp_path):
    path = f"{tmp_path}/r"
    write_report(report(spark, "a"), path, DAY)
    register_view(spark, path, "follows")
    register_view(spark, path, "follows_date", DAY)
    held = spark.table("follows")
    write_report(report(spark, "b", "c"), path, DAY)
    assert values(spark.table("follows")) == values(spark.table("follows_date")) == ["b", "c"]
    assert values(held) == ["a"]
    write_report(report(spark, "d"), path, LATER)
    assert values(spark.sql("SELECT * FROM follows")) == ["d"] and values(spark.table("follows_date")) == ["b", "c"]
    write_report(report(spark), path, LATER)
    assert values(spark.table("follows")) == []
    write_report(spark.createDataFrame([("e", 1)], "v string, more int"), path, LATER)
    assert spark.table("follows").columns == ["v", "more"]
    for name in ("follows", "follows_date"):
        spark.sql(f"DROP TABLE {name}")
    write_report(report(spark, "f"), path, LATER)  # a view that is gone is no hindrance


def test_a_view_taken_over_by_another_report_stays_there(spark, tmp_path):
    for r in ("x", "y"):
        write_report(report(spark, r), f"{tmp_path}/{r}", DAY)
        register_view(spark, f"{tmp_path}/{r}", "taken")
    write_report(report(spark, "x2"), f"{tmp_path}/x", DAY)
    assert values(spark.table("taken")) == ["y"]
    spark.sql("DROP TABLE taken")
    with pytest.raises(ValueError, match="not a table name"):
        register_view(spark, f"{tmp_path}/x", "a; b")


def test_reading_a_view_starts_no_job_of_its_own(spark, tmp_path):
    """The location is the pointer: planning runs no Spark job, however many dates there are."""
    path = f"{tmp_path}/r"
    for year in range(2010, 2022):
        write_report(report(spark, str(year)), path, date(year, 9, 29))
    register_view(spark, path, "pointed")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pointed", "planning")
    try:
        spark.table("pointed")._jdf.queryExecution().executedPlan()
        read_report(spark, path)
        assert len(tracker.getJobIdsForGroup("pointed")) <= 1  # the schema of read_report's files
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert values(spark.table("pointed")) == ["2021"]
    spark.sql("DROP TABLE pointed")
