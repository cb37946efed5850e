"""Differences of reports against counters, step counts of running jobs, restricted reports."""

import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gradeledger.checks.derived import CONFIG, DerivedSource, store
from gradeledger.config import NEW, OLD
from gradeledger.operators import changed_columns, diff_reports, report_difference, row_balance
from gradeledger.operators.funnel import Funnel
from gradeledger.plans import matched, report_p, report_r, restricted, run_report_p, run_report_r, variants
from gradeledger.plans.risk import perimeter_r
from gradeledger.sources import read_steps
from helpers import CFG, MemorySource
from test_equivalence import world as rated_world
from test_jobs import world
from test_plans import plan, scans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return store(spark, SF, str(tmp_path_factory.mktemp("source")))


def two(spark, seed):
    """Rows with repeats and NULLs; half of them are one and the same row."""
    rnd = random.Random(seed)

    def rows():
        return [("hot", 1, "x")] * rnd.randrange(40, 60) + [
            (rnd.choice("abc"), rnd.choice((1, 2, None)), rnd.choice(("x", None))) for _ in range(50)
        ]

    return [spark.createDataFrame(rows(), "k string, n int, v string").repartition(3) for _ in "ab"]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("ignore", [(), ("v",)])
def test_difference_equals_except(spark, seed, ignore):
    a, b = two(spark, seed)
    cols = [c for c in a.columns if c not in ignore]
    x, y = (Counter(map(tuple, df.select(*cols).collect())) for df in (a, b))
    as_sets = Counter(map(tuple, report_difference(a, b, ignore).collect()))
    assert as_sets == Counter([(*r, "a") for r in x.keys() - y.keys()] + [(*r, "b") for r in y.keys() - x.keys()])
    every = Counter(map(tuple, report_difference(a, b, ignore, every=True).collect()))
    assert every == Counter([(*r, "a") for r in (x - y).elements()] + [(*r, "b") for r in (y - x).elements()])
    only_a, only_b = diff_reports(a, b, ignore)
    assert {*map(tuple, only_a.collect())} == x.keys() - y.keys() and {*map(tuple, only_b.collect())} == y.keys() - x.keys()
    counted = {tuple(r)[:-2]: tuple(r)[-2:] for r in row_balance(a, b, ignore).collect()}
    assert counted == {r: (x[r], y[r]) for r in x.keys() | y.keys()}


def test_difference_is_one_shuffle_of_one_build_each(spark, stored):
    cfg = replace(CONFIG, sharing="none")
    a, b = report_p(stored, cfg), report_p(stored, replace(cfg, portfolio=None))
    text = plan(report_difference(a, b))
    single = [plan(df).count("Exchange hashpartitioning") for df in (a, b)]
    assert text.count("Exchange hashpartitioning") == sum(single) + 1


def test_changed_columns(spark):
    schema = "k int, g string, v string, w double"
    a = spark.createDataFrame([(1, "x", "1", 1.0), (2, "x", None, 2.0), (3, None, "3", 3.0), (4, "y", "4", 4.0), (4, "y", "5", 4.0), (6, "z", "6", 6.0)], schema)
    b = spark.createDataFrame([(1, "x", "1", 1.0), (2, "x", "2", 2.5), (3, None, "3", None), (4, "y", "4", 4.0), (5, "y", "5", 5.0)], schema)
    found = {(r.k, r.g): (r.change, r.columns) for r in changed_columns(a, b, ["k", "g"]).collect()}
    assert found == {
        (1, "x"): ("same", []), (2, "x"): ("changed", ["v", "w"]), (3, None): ("changed", ["w"]),
        (4, "y"): ("repeated", []), (5, "y"): ("added", []), (6, "z"): ("removed", []),
    }
    assert {r.change for r in changed_columns(a, a, ["k"], ignore=("v",)).collect()} == {"same", "repeated"}
    assert changed_columns(a.limit(0), b.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("sharing", ["none", "persist", "checkpoint"])
def test_a_job_counts_its_steps_on_the_way(spark, tmp_path, sharing):
    if sharing == "checkpoint":
        spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    source = DerivedSource(spark, SF)
    cfg = replace(CONFIG, sharing=sharing)
    for run, name in ((run_report_p, "report_p"), (run_report_r, "report_r")):
        assert run(spark, source, cfg.ref_date, str(tmp_path), cfg)
        steps = {r.step: r.n_rows for r in read_steps(spark, f"{tmp_path}/{name}").collect()}
        eligible = matched.eligible if name == "report_p" else matched.eligible_financials
        for g in (OLD, NEW):
            assert steps[f"eligible_{g}"] == eligible(source, cfg, g).count()
        final = matched.final_rating_p(source, cfg) if name == "report_p" else matched.final_rating_r(source, cfg)
        assert steps["final"] == final.count()
        assert steps["perimeter"] == matched.perimeter(final, cfg).count()
        report = report_p(source, cfg) if name == "report_p" else report_r(source, cfg)
        assert steps["report"] == report.count() and steps["statements"] >= steps["report"]


def test_a_step_is_marked_once(spark):
    funnel = Funnel()
    df = funnel("all", spark.range(7))
    with pytest.raises(ValueError, match="marked already"):
        funnel("all", df)
    assert funnel.counts() == {}
    assert df.count() == 7 and funnel.counts() == {"all": 7}


def test_empty_sources_have_steps_of_nothing(spark, tmp_path):
    assert run_report_p(spark, MemorySource(spark), CFG.ref_date, str(tmp_path))
    assert all(r.n_rows == 0 for r in read_steps(spark, f"{tmp_path}/report_p").collect())
    assert run_report_r(spark, world(spark), CFG.ref_date, str(tmp_path))
    steps = {r.step: r.n_rows for r in read_steps(spark, f"{tmp_path}/report_r").collect()}
    assert steps["report"] == 1


@pytest.mark.parametrize("most", [1000, 2])
def test_restricted_reports_equal_a_filter_on_the_whole(spark, stored, monkeypatch, most):
    """With ids in the filters of the scans, and beyond the limit with semi-joins."""
    monkeypatch.setattr(restricted, "MOST_IDS", most)
    cfg = replace(CONFIG, sharing="none")
    for condition in ("cdi LIKE '%3'", "cdi IS NULL", "cdi = 'nobody'"):
        chosen = F.expr(condition)
        for part, whole in ((restricted.report_p_of, report_p), (restricted.report_r_of, report_r)):
            ours, theirs = (sorted(map(str, df.collect())) for df in (part(stored, cfg, chosen), whole(stored, cfg).where(condition)))
            assert ours == theirs
            assert ours or "3" not in condition


def test_many_ids_are_found_once(stored, monkeypatch):
    """Scans meet the ids as they were made, not the plan that finds them, once for each scan."""
    monkeypatch.setattr(restricted, "MOST_IDS", 2)
    cfg = replace(CONFIG, sharing="none")
    text = plan(restricted.report_r_of(stored, cfg, F.expr("cdi LIKE '%3'")))
    found = [line for line in text.splitlines() if "FileScan" in line and "cdicode" in line]
    whole = [line for line in plan(report_r(stored, cfg)).splitlines() if "FileScan" in line and "cdicode" in line]
    assert len(found) == len(whole) > 0


def test_a_rating_with_another_versions_customer(spark):
    """An entity changed hands: rows go by the customer of the rating's own entity version."""
    source = rated_world(spark, 8)
    whole = report_p(source, CFG)
    for customer in ("c1", "c5"):
        part = restricted.report_p_of(source, CFG, F.col("cdi") == customer)
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.where(F.col("cdi") == customer).collect()))


def test_a_slice_reads_balances_of_its_statements_only(stored):
    cfg = replace(CONFIG, sharing="none")
    customer = report_r(stored, cfg).where("cdi IS NOT NULL").first().cdi
    text = plan(restricted.slice_of(stored, cfg, [customer], cols=("gdwill",)))
    for table, column in (("balance_old", "financialid"), ("rating_old", "entityid"), ("entity_old", "entityid"), ("statement_old", "entityid")):
        for scan in scans(text, table):
            pushed = scan[scan.index("PushedFilters"):]
            assert f"In({column}" in pushed or f"EqualTo({column}" in pushed, table
    assert len(scans(text, "balance_new")) == 1 and len(scans(text, "balance_old")) == 1


def test_seeds_read_metrics_of_candidates_only(stored):
    """The old generation's metrics are joined last, after the years are known, and headers meet
    their owners split."""
    cfg = replace(CONFIG, sharing="none")
    scope = perimeter_r(stored, cfg)
    first = scope.select("entityid", "cdicode", "afm").distinct().withColumn("first_year", F.lit(1996))
    text = plan(variants._seeds(stored, cfg, scope, first))
    assert len(scans(text, "statement_metrics_old")) == len(scans(text, "statement_new")) == 1
    lines = text.splitlines()
    metrics = next(i for i, x in enumerate(lines) if "/statement_metrics_old]" in x)
    window = next(i for i, x in enumerate(lines) if "Window [max(" in x)
    assert window < metrics and "_split" in text
