"""Snapshots, view, audit log and failure handling."""

from dataclasses import replace
from datetime import date, datetime

import pytest

from gradeledger.plans import run_report_p, run_report_r
from gradeledger.plans.position import report_p
from gradeledger.plans.risk import report_r
from gradeledger.sources import read_audit, read_report, register_view, sinks, write_report
from helpers import CFG, MemorySource, entity, rating, statement

DAY = CFG.ref_date


def clock():
    return datetime(2024, 1, 2, 3, 4)


def world(spark):
    return MemorySource(
        spark, rating_new=[rating(True, 7, "2023-03-04")], entity_new=[entity(True, 7)],
        statement_new=[statement(True, 7, 1, 2021, "2022-05-01")],
    )


class Broken(MemorySource):
    def load_statements_new(self):
        df = super().load_statements_new()
        return df.selectExpr(
            *[c for c in df.columns if c != "statementyear"],
            "CAST(raise_error('no statements today') AS INT) AS statementyear",
        )


def audit(spark, out):
    return [r.asDict() for t in ("report_p", "report_r") for r in read_audit(spark, f"{out}/{t}").collect()]


def test_both_jobs_write_and_log(spark, tmp_path):
    out, source = str(tmp_path), world(spark)
    assert run_report_p(spark, source, DAY, out, clock=clock)
    assert run_report_r(spark, source, DAY, out, clock=clock)
    assert read_report(spark, f"{out}/report_p", DAY).columns[:2] == ["cdi", "afm"]
    assert len(read_report(spark, f"{out}/report_r").columns) == 44
    log = {r["TargetTableName"]: r for r in audit(spark, out)}
    assert log["report_p"]["TargetTableCount"] == 1
    assert log["report_r"]["LogMessage"] == "report_r has been populated"
    assert log["report_p"]["JobId"] == "populate_report202401020304"
    assert set(log["report_p"]) == {
        "id_", "t_", "JobId", "ETLFunction", "SourceTableName", "SourceTableCount",
        "TargetTableName", "TargetTableCount", "LogMessage", "SchemaName",
    }


def test_persisted_results_are_released(spark, tmp_path):
    cached = spark.sparkContext._jsc.getPersistentRDDs
    before = cached().size()
    cfg = replace(CFG, sharing="persist")
    assert run_report_r(spark, world(spark), DAY, str(tmp_path), cfg)
    assert cached().size() == before


def test_view_survives_reruns(spark, tmp_path):
    """The same date again, a later date, and a later empty run, all after registering."""
    out, source = str(tmp_path), world(spark)
    assert run_report_p(spark, source, DAY, out, view="live_p")
    shown = spark.table("live_p")
    assert run_report_p(spark, source, DAY, out)
    assert shown.count() == spark.table("live_p").count() == 1
    later = date(2024, 9, 29)
    assert run_report_p(spark, source, later, out)
    files = set(read_report(spark, f"{out}/report_p", later).inputFiles())
    assert files and set(spark.table("live_p").inputFiles()) == files
    assert run_report_p(spark, MemorySource(spark), date(2025, 9, 29), out)
    assert spark.table("live_p").count() == 0
    assert read_report(spark, f"{out}/report_p", DAY).count() == 1
    spark.sql("DROP TABLE live_p")


def test_failed_publishing_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/r"
    write_report(spark.createDataFrame([("1", "old")], "cdi string, v string"), out, DAY)

    def fails(*args):
        raise OSError("no commit today")

    monkeypatch.setattr(sinks.CommitLog, "commit", fails)
    with pytest.raises(OSError, match="no commit"):
        write_report(spark.createDataFrame([("1", "new")], "cdi string, v string"), out, DAY)
    monkeypatch.undo()
    assert [r.v for r in read_report(spark, out, DAY).collect()] == ["old"]
    assert sinks.drop_old_runs(spark, out) == 1
    assert [r.v for r in read_report(spark, out, DAY).collect()] == ["old"]


def test_log_that_cannot_be_written_does_not_raise(spark, tmp_path, monkeypatch):
    """The snapshot and its record are one commit: without the one there is none of the other."""
    def fails(*args):
        raise OSError("log is full")

    monkeypatch.setattr(sinks.CommitLog, "commit", fails)
    assert run_report_p(spark, world(spark), DAY, str(tmp_path)) is False
    monkeypatch.undo()
    with pytest.raises(FileNotFoundError):
        read_report(spark, f"{tmp_path}/report_p", DAY)
    assert audit(spark, str(tmp_path)) == []


def test_export_is_ordered(spark, tmp_path):
    rows = spark.range(500).selectExpr("cast(pmod(id * 37, 501) as int) as k", "id")
    sinks.export_report(rows.repartition(5), f"{tmp_path}/e", ["k"])
    files = sorted((tmp_path / "e").glob("part-*"))
    keys = [r.k for f in files for r in spark.read.parquet(str(f)).collect()]
    assert keys == sorted(keys) and len(keys) == 500


def test_reports_leave_nothing_cached(spark):
    cached = spark.sparkContext._jsc.getPersistentRDDs
    before = cached().size()
    report_p(world(spark), CFG).collect()
    report_r(world(spark), CFG).collect()
    assert cached().size() == before


def test_failed_run_keeps_the_old_snapshot(spark, tmp_path):
    out, source = str(tmp_path), world(spark)
    assert run_report_p(spark, source, DAY, out)
    broken = Broken(spark, **source.rows)
    assert run_report_p(spark, broken, DAY, out) is False
    assert read_report(spark, f"{out}/report_p", DAY).count() == 1
    assert any("no statements today" in r["LogMessage"] for r in audit(spark, out))


def test_running_twice_gives_the_same_rows(spark, tmp_path):
    out, source = str(tmp_path), world(spark)
    for _ in range(2):
        assert run_report_p(spark, source, DAY, out)
    assert read_report(spark, f"{out}/report_p").collect() == report_p(source, CFG).collect()


def test_empty_report_replaces_a_full_one(spark, tmp_path):
    out = f"{tmp_path}/r"
    full = spark.createDataFrame([("1", "x")], "cdi string, v string")
    assert write_report(full, out, DAY) == 1
    assert write_report(full.limit(0), out, DAY) == 0
    assert read_report(spark, out, DAY).count() == 0


def test_view_shows_the_latest_date_and_others_stay(spark, tmp_path):
    out = f"{tmp_path}/r"
    for day, value in ((DAY, "new"), (date(2022, 9, 29), "before")):
        write_report(spark.createDataFrame([("1", value)], "cdi string, v string"), out, day)
    register_view(spark, out, "shown")
    assert [tuple(r) for r in spark.sql("SELECT * FROM shown").collect()] == [("1", "new")]
    register_view(spark, out, "shown", date(2022, 9, 29))
    assert [r.v for r in spark.sql("SELECT * FROM shown").collect()] == ["before"]
    spark.sql("DROP TABLE shown")


@pytest.mark.parametrize("sharing", ["none", "persist", "checkpoint"])
def test_sharing_does_not_change_the_report(spark, tmp_path, sharing):
    cfg = replace(CFG, sharing=sharing)
    if sharing == "checkpoint":
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    assert run_report_p(spark, world(spark), DAY, f"{tmp_path}/out", cfg)
    assert read_report(spark, f"{tmp_path}/out/report_p").count() == 1
