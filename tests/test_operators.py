"""Operators against brute force and against each other."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gradeledger.operators import (
    account_group_for,
    account_groups,
    attach_grade,
    change_vs_previous,
    choose_statement_version,
    diff_reports,
    distinct_on,
    find_duplicates,
    in_scope,
    latest_before,
    match_asof,
    metric_slice,
    side_by_side,
    step_counts,
)
from gradeledger.operators.reuse import Keeper, shared

D = Decimal
START = datetime(2020, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_distinct_on_null_wins(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("a", 2), (None, 3), (None, 4)],
                               "k string, v int")
    assert rows(distinct_on(df, ["k"], ["-v"])) == [("a", None), (None, 4)]
    assert rows(distinct_on(df, ["k"], ["v"])) == [("a", 1), (None, 3)]


def test_distinct_on_expression_key(spark):
    df = spark.createDataFrame([("0", 1), ("00", 2), ("1", 3)], "k string, v int")
    assert rows(distinct_on(df, [F.ltrim(F.translate("k", "0", " "))], ["-v"])) == [
        ("00", 2), ("1", 3)
    ]


def timeline(seed, n_left, n_right, n_keys, hot=0.4):
    """Random probes and versions; one key holds a large part, times repeat."""
    rnd = random.Random(seed)

    def key():
        return 0 if rnd.random() < hot else rnd.randrange(1, n_keys)

    def ts():
        return START + timedelta(hours=6 * rnd.randrange(1200))

    left = [(i, key(), ts() if rnd.random() > 0.03 else None) for i in range(n_left)]
    right = [(key(), ts(), f"v{i:04d}") for i in range(n_right)]
    return left, right


def brute_asof(left, right, strict):
    out = []
    for i, k, t in left:
        earlier = [
            r for r in right
            if r[0] == k and t is not None and (r[1] < t if strict else r[1] <= t)
        ]
        if earlier:
            last = max(r[1] for r in earlier)
            out.append((k, t, i, last, min(r[2] for r in earlier if r[1] == last)))
    return sorted(out, key=str)


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("bucket", ["month", "year"])
def test_match_asof_equals_brute_force(spark, strict, bucket):
    left, right = timeline(7, 400, 300, 12)
    got = match_asof(
        spark.createDataFrame(left, "i int, k int, t timestamp_ntz"),
        spark.createDataFrame(right, "k int, ts timestamp_ntz, v string"),
        ["k"], "t", "ts", strict=strict, order=["v"], bucket=bucket,
    ).select("k", "t", "i", "ts", "v")
    assert rows(got) == brute_asof(left, right, strict)


@pytest.mark.parametrize("splits", [1, 5])
def test_latest_before_equals_brute_force(spark, splits):
    left, right = timeline(11, 60, 500, 40)
    left = list({r[1]: r for r in left}.values())
    got = latest_before(
        spark.createDataFrame(left, "i int, k int, t timestamp_ntz"),
        spark.createDataFrame(right, "k int, ts timestamp_ntz, v string"),
        ["k"], "t", "ts", ["v"], splits,
    ).select("k", "t", "i", "ts", "v")
    assert rows(got) == brute_asof(left, right, True)


def test_split_join_equals_plain_join(spark):
    df = spark.createDataFrame(
        [(0 if i % 3 else i % 7, i, i % 5) for i in range(300)], "k int, v int, w int"
    )
    scope = spark.createDataFrame([(0, "a"), (3, "b"), (9, "c")], "k int, tag string")
    plain = rows(in_scope(df, scope, ["k"]).select("k", "v", "tag"))
    assert plain == rows(in_scope(df, scope, ["k"], 4).select("k", "v", "tag"))
    assert plain == rows(in_scope(df, scope, ["k"], 4, ["w"]).select("k", "v", "tag"))


VERSIONS = "k int, ts timestamp_ntz, anchor timestamp_ntz, v string"


@pytest.mark.parametrize(
    ("days", "chosen"),
    [((12, 15), 12), ((5, 8, 12), 8), ((5,), 5), ((None, 11), 11), ((None, 9), 9), ((10, 11), 10)],
)
def test_statement_choice(spark, days, chosen):
    anchor = datetime(2023, 1, 10)
    made = [(1, d and datetime(2023, 1, d), anchor, str(d)) for d in days]
    df = spark.createDataFrame(made, VERSIONS)
    assert choose_statement_version(df, ["k"], "ts", "anchor").first().v == str(chosen)


def test_change_is_against_the_row_before(spark):
    df = spark.createDataFrame(
        [(1, 1, D("10"), 12), (1, 2, D("14"), 6), (1, 3, D("20"), 12), (2, 1, None, 12),
         (2, 2, D("3"), 12)],
        "k int, t int, x decimal(19,2), months int",
    )
    got = change_vs_previous(df, ["k"], ["t"], ["x"]).select("k", "t", "chg_x")
    assert rows(got) == [(1, 1, None), (1, 2, D("4.00")), (1, 3, D("6.00")), (2, 1, None),
                         (2, 2, None)]


BALANCES = ("generation string, entityid int, statementid int, financialid int, accountid int, "
            "originrounding decimal(19,2), originbalance decimal(19,2)")


def balances(spark, *items):
    made = [("old", 1, 1, 1, a, D(code), D(amount)) for a, code, amount in items]
    return spark.createDataFrame(made, BALANCES)


def test_same_amount_counts_once_other_amount_again(spark):
    df = balances(spark, (1520, 0, "5"), (1520, 0, "5"), (1520, 0, "7"), (1521, 0, "5"))
    assert account_groups(df).first().inventories == D("17.00")


def test_equal_amounts_in_different_units_are_one(spark):
    df = balances(spark, (1520, 0, "5000"), (1520, 1, "5"))
    assert account_groups(df).first().inventories == D("5000.00")


def test_allowance_is_subtracted_and_missing_group_is_null(spark):
    row = account_groups(balances(spark, (1640, 0, "100"), (1650, 0, "30"))).first()
    assert row.net_receivables == D("70.00")
    assert row.total_debt is None and row.goodwill is None


def test_goodwill_takes_the_larger(spark):
    row = account_groups(balances(spark, (1100, 0, "3"), (1100, 0, "9"))).first()
    assert row.goodwill == D("9.00")


def test_unknown_rounding_is_zero_not_null(spark):
    row = account_groups(balances(spark, (2100, 3, "9"))).first()
    assert row.long_debt == row.total_debt == D("0.00") and row.short_debt is None


@pytest.mark.parametrize(
    ("entity", "statement", "account", "amount", "group", "value"),
    [(103567, 10, 2680, "1355208.0", "trade_payables", "1355208.00"),
     (89671, 10, 2400, "0.0", "short_debt", "0.00"),
     (91287, 9, 1520, "62798.0", "inventories", "62798.00"),
     (30872, 43, 2460, "18971172.0", "short_debt", "18971172.00"),
     (118468, 10, 1650, "0.0", "net_receivables", "0.00")],
)
def test_account_group_lookup(spark, entity, statement, account, amount, group, value):
    other = ("new", 1, 1, 1, account, D(0), D("44"))
    df = spark.createDataFrame(
        [("new", entity, statement, entity, account, D(0), D(amount)), other], BALANCES
    )
    got = account_group_for(df, group, entityid=entity, statementid=statement).collect()
    assert [r[group] for r in got] == [D(value)]


def test_attach_grade(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "approveid long")
    grades = spark.createDataFrame([(1, 5), (2, 99)], "approveid long, finalgrade long")
    scale = spark.createDataFrame([(5, "G5")], "ratingscalekey_ long, ratingscalevalue string")
    assert rows(attach_grade(df, grades, scale)) == [
        (1, 5, "G5", "true"), (2, 99, None, "false"), (3, None, None, "false")
    ]


def test_quality_operators(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), ("2", "y")], "cdi string, v string")
    b = spark.createDataFrame([("1", "x"), ("3", "z")], "cdi string, v string")
    only_a, only_b = diff_reports(a, b)
    assert rows(only_a) == [("2", "y")] and rows(only_b) == [("3", "z")]
    assert [d.count() for d in diff_reports(a, b, ignore=("cdi", ))] == [1, 1]
    both = side_by_side(a, b, where=F.col("cdi").like("%1%"))
    assert rows(both) == [("a", "1", "x"), ("b", "1", "x")]
    assert rows(find_duplicates(a, ["cdi"])) == [("2", 2)]
    assert rows(step_counts({"a": a, "b": b})) == [("a", 3), ("b", 2)]


def test_metric_slice(spark):
    df = spark.createDataFrame(
        [("1", "t", "2019", D("5"), "d", "1|1"), ("1", "t", "2020", D("6"), "d", "1|1"),
         ("2", "t", "2019", D("7"), "d", "2|1")],
        "cdi string, afm string, fnc_year string, balancedividendspayable decimal(19,2), "
        "approveddate string, entityid string",
    )
    got = metric_slice(df, "1", "2019", ["balancedividendspayable"])
    assert rows(got) == [("1", "t", "2019", D("5.00"), "d", "1|1")]


def test_shared_modes(spark, tmp_path):
    df = spark.range(10)
    keeper = Keeper("persist")
    assert keeper(df).is_cached
    keeper.release()
    assert not df.is_cached
    assert shared(df, "none") is df
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    assert shared(df, "checkpoint").count() == 10
