"""Compare a registered query with its oracle, row for row."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from gradeledger.checks.registry import CHECKS

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def star_schema(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A DuckDB session with the test tables as views."""
    con = duckdb.connect()
    for name in STAR_TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _row(values: Iterable) -> tuple:
    return tuple(format(v, "f") if isinstance(v, Decimal) else v for v in values)


def differences(
    spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str
) -> tuple[int, Counter, Counter]:
    """(rows, rows only in Spark, rows only in DuckDB) for small test data."""
    check = CHECKS[name]
    ours = Counter(_row(r) for r in check.run(spark, sf_dir).collect())
    relation = con.sql(check.oracle())
    if tuple(relation.columns) != check.columns:
        raise AssertionError(f"{name}: {relation.columns} is not {check.columns}")
    theirs = Counter(_row(r) for r in relation.fetchall())
    return sum(ours.values()), ours - theirs, theirs - ours
