"""What the physical plans must look like."""

import re
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gradeledger.checks.derived import DerivedSource, store
from gradeledger.checks.derived import CONFIG as DERIVED
from gradeledger.config import NEW, OLD
from gradeledger.operators import account_groups, distinct_on
from gradeledger.plans import matched, report_p, report_r
from gradeledger.plans.risk import groups_in_scope, macros_old, perimeter_r
from gradeledger.plans.variants import reviewed_only
from gradeledger.sources.tables import ReportSource, statements_unified

SF = "/root/testdata/sf0.001"
CFG = replace(DERIVED, sharing="none")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The derived tables written as the source tables they stand for."""
    return store(spark, SF, str(tmp_path_factory.mktemp("source")))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str, table: str) -> list[str]:
    return [line for line in text.splitlines() if f"/{table}]" in line and "FileScan" in line]


def test_stored_tables_give_the_same_report(spark, stored):
    derived = DerivedSource(spark, SF)
    for report in (report_p, report_r):
        ours, theirs = (
            sorted(map(str, report(s, DERIVED).collect())) for s in (stored, derived)
        )
        assert ours == theirs and ours


def test_no_python_and_no_cartesian(stored):
    for report in (report_p, report_r):
        text = plan(report(stored, CFG))
        for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoop"):
            assert word not in text


def test_only_the_rating_scale_is_broadcast(spark, stored):
    """The tables' files look small, but what they hold grows."""
    for source in (stored, DerivedSource(spark, SF)):
        for df in (
            report_p(source, CFG), matched.final_rating_r(source, CFG), statements_unified(source),
            matched.rating_entity_p(source, CFG, OLD), matched.ratings_union(source, CFG),
        ):
            joins = [x for x in plan(df).splitlines() if "BroadcastHashJoin [" in x]
            assert all("BroadcastHashJoin [finalgrade" in x for x in joins), joins
    assert "BroadcastHashJoin [" not in plan(reviewed_only(stored, CFG))


def test_derived_rows_are_made_by_all_cores(spark):
    for name in ("statement_new", "statement_metrics_old", "entity_old", "historical_statement"):
        made = DerivedSource(spark, SF).raw(name).rdd.getNumPartitions()
        assert made == spark.sparkContext.defaultParallelism


def test_top_one_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    text = plan(distinct_on(df, ["k"], ["-v"]))
    before_exchange = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_rating_filters_reach_the_scan(stored):
    for generation, column in ((NEW, "approveddate"), (OLD, "sourcepopulateddate_")):
        text = plan(matched.eligible(stored, CFG, generation))
        (scan,) = scans(text, f"rating_{generation}")
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", scan).group(1)
        assert f"GreaterThanOrEqual({column}" in pushed and f"LessThanOrEqual({column}" in pushed
        assert "isprimary" in pushed


def test_final_rating_scans_each_table_once(stored):
    """Both kinds of matches share one scan; one join, and a top-1 cut before each shuffle."""
    for cfg in (CFG, replace(CFG, nonfin_entity_gen=OLD)):
        text = plan(matched.final_rating_p(stored, cfg))
        for table in ("rating_new", "rating_old", "entity_new", "entity_old"):
            assert len(scans(text, table)) == 1, table
    text = plan(matched.final_rating_r(stored, CFG))
    for table in ("rating_new", "rating_old", "entity_new", "entity_old"):
        assert len(scans(text, table)) == 1, table


def test_balances_are_scanned_once_filtered_and_narrow(stored):
    text = plan(groups_in_scope(stored, CFG, perimeter_r(stored, CFG)))
    for generation in (NEW, OLD):
        (scan,) = scans(text, f"balance_{generation}")
        assert "In(accountid" in scan
        read = scan[scan.index("ReadSchema"):]
        assert ("versionid_" in read) == (generation == NEW)
        assert ",id_:" not in read


def test_report_p_reads_two_metrics(stored):
    text = plan(report_p(stored, CFG))
    for scan in scans(text, "statement_new") + scans(text, "statement_metrics_old"):
        read = scan[scan.index("ReadSchema"):]
        assert "salesrevenues" in read and "ebitda" not in read


@pytest.mark.parametrize("splits", [1, 2])
def test_hot_statement_is_divided(spark, stored, splits):
    """One statement holds most balances: with the split its join is divided at run
    time, without it the grouping behind pins the whole statement to one task."""
    hot = stored.table("balance_old")
    hot = hot.where("statementid = 3").withColumn("financialid", F.lit(1)).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(39)))
    ).withColumn("originbalance", F.expr("CAST(originbalance + copy AS DECIMAL(19,2))"))
    source = ReportSource(spark, stored.root)
    source._tables["balance_old"] = hot.drop("copy").repartition(16).unionByName(
        stored.table("balance_old")
    )
    scope = spark.createDataFrame(
        [("old", e, s, e, datetime(1999, 1, 1)) for e in range(150) for s in range(1, 6)],
        "generation string, entityid int, statementid int, financialid int, "
        "approveddate timestamp_ntz",
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        df = account_groups(macros_old(source, replace(CFG, splits=splits), scope))
        df.collect()
        assert ("skew=true" in plan(df)) == (splits > 1)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_split_join_leaves_room_for_skew_handling(spark, stored):
    """A shuffle follows the balance join, so adaptive execution may divide a hot key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(groups_in_scope(stored, CFG, perimeter_r(stored, CFG)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in text.splitlines() if "SortMergeJoin [financialid" in line]
    assert len(joins) == 2 and all("_split" in line for line in joins)
