"""Scalar functions and the context parser, one trap each."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gradeledger.functions import context, scalars

D = Decimal


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return df.select(column.alias("x")).first().x


def contexts(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "financialcontext string")


def test_context_basic(spark):
    df = contexts(spark, "54321:3;12#1:2;22:2;3:1")
    row = context.parse_context(df).first()
    assert (row.financialid, row.entityversion) == (54321, 12)
    assert [r.statementid for r in context.explode_statements(df).collect()] == ["1", "22", "3"]
    pairs = context.explode_statements(df, with_version=True).collect()
    assert [(r.statementid, r.statementid_version) for r in pairs] == [
        ("1", "2"), ("22", "2"), ("3", "1")
    ]


@pytest.mark.parametrize(
    ("text", "pairs"),
    [
        ("77:1;5#100", [("100", None)]),
        ("9:1;4#a1:2;*:7;8:1:2", [(None, "2"), (None, "7"), ("8", "1"), (None, "2")]),
        ("9:1;4#1:2;2:3#", [("1", "2"), ("2", "3")]),
    ],
)
def test_context_pairs_in_lockstep(spark, text, pairs):
    rows = context.explode_statements(contexts(spark, text), with_version=True).collect()
    assert [(r.statementid, r.statementid_version) for r in rows] == pairs


def test_contexts_without_version_drop(spark):
    assert context.parse_context(contexts(spark, "x", "0", "###", None, "")).count() == 0


def test_hash_only_context_has_no_statement_and_is_not_cast(spark):
    df = contexts(spark, "###")
    assert context.explode_statements(df).count() == 0
    assert df.select(context.financial_id("financialcontext").alias("x")).first().x is None


def test_empty_entity_version_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        context.parse_context(contexts(spark, "1:1;#1:1")).collect()


def test_repeated_statement_once_if_distinct(spark):
    df = contexts(spark, "1:1;1#5:1;5:2;6:1")
    assert [r.statementid for r in context.explode_statements(df).collect()] == ["5", "5", "6"]
    got = context.explode_statements(df, distinct=True).collect()
    assert [r.statementid for r in got] == ["5", "6"]


def test_usable_context(spark):
    df = contexts(spark, "0", "", "###", None, "x" * 16, "x" * 17)
    assert df.where(context.usable("financialcontext")).count() == 1


@pytest.mark.parametrize(
    ("tax_id", "canonical"),
    [("000", "00000000"), ("0000000000", "00000000"), ("0", "00000000"), ("010", "010"),
     ("000\n", "000\n"), ("", ""), (None, None)],
)
def test_canonical_tax_id(spark, tax_id, canonical):
    assert one(spark, scalars.canonical_tax_id("t"), t=("string", tax_id)) == canonical


@pytest.mark.parametrize(
    ("n", "d", "plain", "filled"),
    [("1.00", "3.00", "0.33", "0.33"), ("-1.00", "8.00", "-0.13", "-0.13"),
     ("1.00", "8.00", "0.13", "0.13"), ("5.00", "0.00", "0.00", "0.00"),
     ("5.00", None, None, "0.00"), (None, "5.00", None, None)],
)
def test_guarded_ratio(spark, n, d, plain, filled):
    values = {k: ("decimal(19,2)", v and D(v)) for k, v in (("n", n), ("d", d))}
    assert one(spark, scalars.guarded_ratio("n", "d"), **values) == (plain and D(plain))
    assert one(spark, scalars.guarded_ratio("n", "d", True), **values) == (filled and D(filled))
    df = spark.createDataFrame([], "n decimal(19,2), d decimal(19,2)")
    assert dict(df.select(scalars.guarded_ratio("n", "d", True).alias("x")).dtypes) == {
        "x": "decimal(19,2)"
    }


@pytest.mark.parametrize(
    ("code", "amount"), [("0", "5"), ("1", "5000"), ("2", "500000"), ("3", "0"), (None, "0")]
)
def test_rounding_codes(spark, code, amount):
    got = one(
        spark, scalars.scale_amount("b", "c", {0: 1, 1: 1000, 2: 100000}),
        b=("decimal(19,2)", D("5.00")), c=("decimal(19,2)", code and D(code)),
    )
    assert got == D(amount)


@pytest.mark.parametrize(
    ("text", "shown"),
    [("2023-09-29 10:11:12.5", "2023-09-29 10:11:12.5+00"),
     ("2023-09-29 10:11:12", "2023-09-29 10:11:12+00"),
     ("2023-09-29 00:00:00.120300", "2023-09-29 00:00:00.1203+00")],
)
def test_zoned_text(spark, text, shown):
    column = scalars.zoned_text(F.lit(text).cast("timestamp_ntz"))
    assert spark.range(1).select(column.alias("x")).first().x == shown


def test_date_key(spark):
    key = scalars.compact_date(scalars.date_of_key("k"))
    assert one(spark, key, k=("int", 20211231)) == "20211231"
    with pytest.raises(Exception, match="(?i)pars"):
        one(spark, key, k=("int", 20211399))


def test_key_text_skips_null(spark):
    column = scalars.entity_version_key("a", "b")
    assert one(spark, column, a=("int", 7), b=("int", 2)) == "7|2"
    assert one(spark, column, a=("int", 7), b=("int", None)) == "7"
