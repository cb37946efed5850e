"""Joins by measured weight, and by the layout of the tables."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gradeledger.checks.derived import CONFIG, DerivedSource
from gradeledger.operators import in_scope, key_places, weighed_join
from gradeledger.plans import report_p, report_r
from gradeledger.plans.risk import groups_in_scope, perimeter_r
from gradeledger.sources.layout import lay_out
from test_plans import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """Shuffled joins with 16 partitions that nobody merges or divides."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def skewed(spark, n=8000):
    """Half of the rows have one key, a quarter another; a few have none."""
    key = "CASE WHEN id % 2 = 0 THEN 7 WHEN id % 4 = 1 THEN 9 WHEN id % 97 = 3 THEN NULL ELSE 100 + id % 900 END"
    return spark.range(n).selectExpr(f"CAST({key} AS INT) AS k", "'x' AS x", "id AS v")


def test_a_heavy_key_gets_places_by_its_weight(shuffled):
    df = skewed(shuffled)
    scope = shuffled.range(1200).selectExpr("CAST(id AS INT) AS k", "'x' AS x", "id * 10 AS w")
    places = key_places(df, ["k", "x"])
    assert sorted(places.values()) == [4, 8]
    joined = weighed_join(df, scope, ["k", "x"], ["v"]).withColumn("part", F.spark_partition_id())
    spread = {r.k: r.n for r in joined.groupBy("k").agg(F.countDistinct("part").alias("n")).collect()}
    assert spread[7] >= 5 and spread[9] >= 2  # of 8 and 4 places; some share a partition
    assert all(n == 1 for k, n in spread.items() if k not in (7, 9))
    largest = joined.groupBy("part").count().agg(F.max("count")).first()[0]
    plain = df.join(scope, ["k", "x"])
    at_worst = plain.withColumn("part", F.spark_partition_id()).groupBy("part").count().agg(F.max("count")).first()[0]
    assert at_worst > 4000 and largest < 2500
    assert Counter(map(tuple, joined.drop("part").collect())) == Counter(map(tuple, plain.collect()))


def test_light_keys_are_not_copied(shuffled):
    df = skewed(shuffled)
    scope = shuffled.range(1200).selectExpr("CAST(id AS INT) AS k", "'x' AS x", "id AS w").repartition(3)
    joined = weighed_join(df, scope, ["k", "x"], ["v"])
    copied = [line for line in plan(joined).splitlines() if "Generate explode" in line]
    assert len(copied) == 1
    rows = scope.withColumn("key", F.xxhash64("k", "x")).collect()
    places = key_places(df, ["k", "x"])
    assert sum(places.get(r.key, 1) for r in rows) == 1200 - 2 + 8 + 4


def test_even_and_empty_tables_are_joined_plainly(shuffled):
    even = shuffled.range(4000).selectExpr("CAST(id % 500 AS INT) AS k", "id AS v")
    scope = shuffled.range(10).selectExpr("CAST(id AS INT) AS k")
    assert key_places(even, ["k"]) == {} and key_places(even.limit(0), ["k"]) == {}
    assert "explode" not in plan(in_scope(even, scope, ["k"], splits=0))
    assert in_scope(even, scope, ["k"], splits=0).count() == 80
    assert in_scope(even.limit(0), scope, ["k"], splits=0).count() == 0


def test_reports_with_weighed_keys(shuffled):
    source = DerivedSource(shuffled, SF)
    for report in (report_p, report_r):
        ours, theirs = (
            sorted(map(str, report(source, replace(CONFIG, sharing="none", splits=n)).collect())) for n in (0, 2)
        )
        assert ours == theirs and ours


def test_bucketed_balances_are_joined_where_they_lie(shuffled, tmp_path):
    derived = DerivedSource(shuffled, SF)
    laid = lay_out(derived, "laid_", str(tmp_path), 6)
    cfg = replace(CONFIG, sharing="none", splits=1)
    try:
        scope = shuffled.createDataFrame(perimeter_r(laid, cfg).collect(), perimeter_r(laid, cfg).schema)
        text = plan(groups_in_scope(laid, cfg, scope))
        scans = [i for i, line in enumerate(text.splitlines()) if "FileScan" in line and "balance_" in line]
        assert len(scans) == 2
        lines = text.splitlines()
        for at in scans:
            assert "SelectedBucketsCount: 6 out of 6" in lines[at] and "Bucketed: true" in lines[at]
            depth = lines[at].index("FileScan")
            above = [x for x in lines[:at] if 0 <= len(x) - len(x.lstrip(" :+-*()0123456789")) <= depth]
            join = max(i for i, x in enumerate(lines[:at]) if "SortMergeJoin" in x)
            assert above and not any("Exchange" in x for x in lines[join:at])
        for report in (report_p, report_r):
            ours, theirs = (sorted(map(str, report(s, cfg).collect())) for s in (laid, derived))
            assert ours == theirs and ours
    finally:
        for name in shuffled.catalog.listTables():
            if name.name.startswith("laid_"):
                shuffled.sql(f"DROP TABLE {name.name}")
