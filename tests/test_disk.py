"""What report R moves and keeps: rows out of scope stay where they are, and finished steps go."""

import os
import time
from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gradeledger.checks.derived import CONFIG as DERIVED
from gradeledger.checks.derived import DerivedSource, store
from gradeledger.checks.registry import CHECKS
from gradeledger.config import NEW, OLD
from gradeledger.operators.reuse import Keeper
from gradeledger.operators.sieve import Sieve
from gradeledger.plans import report_r, restricted, run_report_r
from gradeledger.plans.risk import groups_in_scope, perimeter_r
from gradeledger.sources.sinks import read_report
from helpers import CFG, MemorySource, balance, entity, metrics_of, rating, statement

SF = "/root/testdata/sf0.001"
LAZY = replace(DERIVED, sharing="none")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return store(spark, SF, str(tmp_path_factory.mktemp("source")))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def above(text: str, at: int) -> list[str]:
    """The nodes from line ``at`` of a plan up to its root, nearest first."""
    lines, found = text.splitlines(), []
    deep = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    depth = deep[at]
    for i in range(at - 1, -1, -1):
        if deep[i] < depth:
            depth = deep[i]
            found.append(lines[i].strip(" :+-*()0123456789"))
    return found


def before_shuffle(text: str, table: str) -> list[list[str]]:
    """For each scan of a table the nodes below its first exchange."""
    out = []
    for i, line in enumerate(text.splitlines()):
        if "FileScan" in line and f"/{table}]" in line:
            nodes = above(text, i)
            out.append(nodes[: next(k for k, x in enumerate(nodes) if x.startswith("Exchange"))])
    return out


def test_a_sieve_loses_no_key(spark):
    keys = spark.range(0, 3000, 3).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'a' END AS k", "CAST(id AS INT) AS n"
    )
    some = spark.range(30000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'a' END AS k", "CAST(id AS INT) AS n", "id AS v"
    )
    cut = Sieve(keys).cut(some, ["k", "n"])
    assert cut.columns == some.columns
    left = {r.n for r in cut.collect()}
    assert left >= set(range(0, 3000, 3)) and len(left) < 1200
    assert Sieve(keys.limit(0)).cut(some, ["k", "n"]).count() == 0


def test_a_sieve_leaves_repeats_and_other_types(spark):
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    some = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert Sieve(keys).cut(some, ["k"]).count() == 3
    longs = some.select(F.col("k").cast("long"))
    assert Sieve(keys).cut(longs, ["k"]).count() == 3


def test_balances_out_of_scope_are_not_shuffled(stored):
    text = plan(groups_in_scope(stored, LAZY, perimeter_r(stored, LAZY)))
    for table in ("balance_new", "balance_old"):
        (nodes,) = before_shuffle(text, table)
        assert any("BroadcastHashJoin" in x and "LeftSemi" in x for x in nodes), table


def test_statements_out_of_scope_are_not_shuffled(stored):
    text = plan(report_r(stored, LAZY))
    for table in ("statement_new", "statement_old", "statement_metrics_old"):
        shuffled = [x for x in before_shuffle(text, table) if not any("REPARTITION" in n for n in x)]
        assert shuffled
        for nodes in shuffled:
            assert any("BroadcastHashJoin" in x and "LeftSemi" in x for x in nodes), table


def test_all_metrics_are_shuffled_for_chosen_statements_only(stored):
    """Choosing a statement reads its header and two metrics, not all."""
    lines = plan(report_r(stored, LAZY)).splitlines()
    wide = [x for x in lines if "FileScan" in x and "quickratio" in x]
    assert len(wide) == 2
    # sorted by the year only after the choice: no window of it carries the metrics
    assert not any("statementyear" in x and "quickratio" in x and "hashpartitioning" in x for x in lines)


def test_many_ids_are_not_shuffled_for(stored, monkeypatch):
    monkeypatch.setattr(restricted, "MOST_IDS", 2)
    text = plan(restricted.report_r_of(stored, LAZY, F.expr("cdi LIKE '%3'")))
    joins = [x for x in text.splitlines() if "Join [" in x and "LeftSemi" in x]
    assert joins and all("BroadcastHashJoin" in x for x in joins)


def world(spark, new: dict, old: dict = {}):  # noqa: B006
    """One entity of each generation, each with statement 1 as the dicts say."""
    own = statement(True, 1, 1, 2021, "2021-05-01", **new)
    header = statement(False, 2, 1, 2021, "2021-05-01", **old)
    return MemorySource(
        spark,
        rating_new=[rating(True, 1, "2022-01-01")], rating_old=[rating(False, 2, "2022-01-01")],
        entity_new=[entity(True, 1)], entity_old=[entity(False, 2)],
        statement_new=[own], statement_old=[header],
        statement_metrics_old=[metrics_of(header, ebitda=Decimal("7.00"))],
        balance_new=[balance(True, 1, 1, 1520, "5.00")],
        balance_old=[balance(False, 2, 1, 1520, "6.00"), balance(False, 2, 1, 1520, "6.00")],
    )


def values(df):
    return sorted((r.cdi, r.ebitda, r.inventory) for r in df.collect())


BOTH = [("c1", Decimal("3.00"), Decimal("5.00")), ("c2", Decimal("7.00"), Decimal("6.00"))]


@pytest.mark.parametrize("missing", [{}, {"pkid_": None}, {"versionid_": None},
                                     {"sourcepopulateddate_": None, "statementdatekey_": None}])
def test_a_new_statement_without_keys_has_its_metrics(spark, missing):
    source = world(spark, {"ebitda": Decimal("3.00")} | missing)
    assert values(report_r(source, replace(CFG, sharing="none"))) == BOTH


def test_a_statement_stored_twice_is_listed_once(spark):
    source = world(spark, {"ebitda": Decimal("3.00")})
    for name in ("statement_new", "statement_old", "statement_metrics_old", "balance_new"):
        source.rows[name] *= 2
    assert values(report_r(source, replace(CFG, sharing="none"))) == BOTH


def test_statements_of_one_key_have_their_own_metrics(spark):
    """Two entities whose statements have the same id and version."""
    source = world(spark, {"ebitda": Decimal("3.00"), "pkid_": 5})
    source.rows["statement_new"].append(
        statement(True, 1, 2, 2020, "2020-05-01", pkid_=5, ebitda=Decimal("4.00"))
    )
    # the same record: the newest version counts, with its own metrics
    assert values(report_r(source, replace(CFG, sharing="none"))) == BOTH


def shuffles(spark) -> int:
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    dirs = [str(d) for d in env.blockManager().diskBlockManager().localDirs()]
    return sum(
        name.startswith("shuffle_") for d in dirs for _, _, names in os.walk(d) for name in names
    )


def test_a_step_kept_in_files_lets_go_of_its_shuffles(spark):
    keep = Keeper("files")
    keep(spark.range(10))  # what earlier tests left
    time.sleep(3)
    before = shuffles(spark)
    kept = keep(spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count())
    until = time.time() + 20
    while shuffles(spark) > before and time.time() < until:
        time.sleep(0.5)
    assert shuffles(spark) <= before
    assert kept.count() == 100 and "HashAggregate" not in plan(kept)
    (folder,) = {f.rsplit("/", 1)[0].removeprefix("file://") for f in kept.inputFiles()}
    keep.release()
    assert not os.path.exists(folder)


def test_the_job_in_files_writes_the_same_report(spark, stored, tmp_path):
    when = lambda: datetime(2000, 9, 29)
    for mode in ("files", "persist"):
        cfg = replace(DERIVED, sharing=mode)
        assert run_report_r(spark, stored, cfg.ref_date, str(tmp_path / mode), cfg, when)
    a, b = (
        sorted(map(str, read_report(spark, f"{tmp_path / mode}/report_r").collect()))
        for mode in ("files", "persist")
    )
    assert a == b and a


def test_booked_lines_are_joined_once(spark):
    plain, once = DerivedSource(spark, SF), DerivedSource(spark, SF).with_booked_lines()
    for name in (f"balance_{g}" for g in (OLD, NEW)):
        assert "Join" not in plan(once.raw(name))
        ours, theirs = (sorted(map(str, s.raw(name).collect())) for s in (once, plain))
        assert ours == theirs and ours


def test_queries_of_report_r_run_in_steps(spark):
    """Each step's result is in files, so a query's last plan is small."""
    for name in ("report_r", "report_r_metrics", "rev_r_lag_order", "rev_r_no_portfolio"):
        assert "/orders.parquet" not in plan(CHECKS[name].run(spark, SF)), name
