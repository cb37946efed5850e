"""Comparison and data-quality operators for report snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_balance(a: DataFrame, b: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Each distinct row of both, without the ignored columns, with its counts ``n_a``, ``n_b``.

    Both sides are added up in one grouping, pre-aggregated before its only shuffle; NULLs
    equal each other, as in EXCEPT.
    """
    cols = [c for c in a.columns if c not in ignore]

    def side(df: DataFrame, in_a: int) -> DataFrame:
        return df.select(*cols, F.lit(in_a).alias("_a"), F.lit(1 - in_a).alias("_b"))

    return side(a, 1).unionByName(side(b, 0)).groupBy(*cols).agg(
        F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b")
    )


def report_difference(
    a: DataFrame, b: DataFrame, ignore: Sequence[str] = (), every: bool = False
) -> DataFrame:
    """Rows that only one report has, with ``side`` (``a`` or ``b``): both directions of EXCEPT,
    or with ``every`` of EXCEPT ALL, from one ``row_balance``."""
    cols = [c for c in a.columns if c not in ignore]
    counted = row_balance(a, b, ignore)
    if every:
        more = F.col("n_a") - F.col("n_b")
        only = counted.where(more != 0).withColumn(
            "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.abs(more)))
        )
    else:
        more = F.when(F.col("n_b") == 0, 1).when(F.col("n_a") == 0, -1)
        only = counted.where(more.isNotNull())
    return only.select(*cols, F.when(more > 0, "a").otherwise("b").alias("side"))


def diff_reports(
    a: DataFrame, b: DataFrame, ignore: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows only in a, rows only in b), as sets, without the ignored columns."""
    both = report_difference(a, b, ignore)
    return tuple(both.where(F.col("side") == s).drop("side") for s in ("a", "b"))


def changed_columns(
    a: DataFrame, b: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """What happened to each key: the keys, ``change`` and ``columns``.

    ``change`` is ``added`` (b alone has it), ``removed``, ``changed`` with the names of the
    columns that differ, ``same``, or ``repeated`` where one side has the key more than once.
    One grouping by the keys, in which each side's row is held once.
    """
    cols = [c for c in a.columns if c not in ignore and c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        own = F.struct(*cols)
        parts = {n: own if n == name else F.lit(None) for n in ("_a", "_b")}
        return df.select(*keys, *[v.cast(row).alias(n) for n, v in parts.items()])

    row = a.select(F.struct(*cols).alias("r")).schema["r"].dataType
    both = side(a, "_a").unionByName(side(b, "_b")).groupBy(*keys).agg(
        F.min("_a").alias("_a"), F.min("_b").alias("_b"),
        F.greatest(F.count("_a"), F.count("_b")).alias("_most"),
    )
    differing = F.filter(
        F.array(*[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in cols]),
        lambda c: c.isNotNull(),
    )
    change = (
        F.when(F.col("_most") > 1, "repeated").when(F.col("_a").isNull(), "added")
        .when(F.col("_b").isNull(), "removed").when(F.size(differing) > 0, "changed")
        .otherwise("same")
    )
    columns = F.when(change == "changed", differing).otherwise(F.array().cast("array<string>"))
    return both.select(*keys, change.alias("change"), columns.alias("columns"))


def side_by_side(a: DataFrame, b: DataFrame, where: Column | None = None) -> DataFrame:
    """Both reports' rows under each other as text, tagged ``a`` and ``b``."""
    cols = [c for c in a.columns if c in b.columns]

    def text(df: DataFrame, tag: str) -> DataFrame:
        df = df if where is None else df.where(where)
        return df.select(F.lit(tag).alias("source"), *[F.col(c).cast("string") for c in cols])

    return text(a, "a").unionByName(text(b, "b"))


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def step_counts(steps: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named step, as one lazy DataFrame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("step"), "n_rows")
        for name, df in steps.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def metric_slice(
    report: DataFrame,
    cdi: str | None = None,
    year: str | None = None,
    cols: Sequence[str] = (),
) -> DataFrame:
    """Chosen columns of the risk report, for one customer and year or for all."""
    if cdi is not None:
        report = report.where(F.col("cdi") == cdi)
    if year is not None:
        report = report.where(F.col("fnc_year") == year)
    return report.select("cdi", "afm", "fnc_year", *cols, "approveddate", "entityid")
