"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeledger.functions.scalars import sort_keys


def distinct_on(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]
) -> DataFrame:
    """First row per key in the given order; NULL keys form a group of their own.

    Names in ``order`` read as in ``sort_keys``: ``-x`` newest (or NULL) first.

    Spark turns ``row_number() = 1`` into a group limit before the shuffle, so each
    map task sends at most one row per key and a hot key stays cheap.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_keys(order)))
    return df.withColumn("_rank", first).where(F.col("_rank") == 1).drop("_rank")
