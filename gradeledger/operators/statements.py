"""Statement versions: the one known at rating time, and changes between statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeledger.functions.scalars import money, sort_keys
from gradeledger.operators.dedup import distinct_on


def is_late(version_ts: str, anchor_ts: str) -> Column:
    """True for a version that appeared after the anchor, or at an unknown time."""
    return ~F.coalesce(F.col(version_ts) <= F.col(anchor_ts), F.lit(False))


def choose_statement_version(
    df: DataFrame,
    key: Sequence[str],
    version_ts: str,
    anchor_ts: str,
    ties: Sequence[str | Column] = (),
) -> DataFrame:
    """Per key the latest version known at the anchor time, else the earliest later one.

    One window does it: late versions sort behind the others, each class by its own
    direction.
    """
    late, ts = is_late(version_ts, anchor_ts), F.col(version_ts)
    order = [
        late.asc(),
        F.when(~late, ts).desc_nulls_last(),
        F.when(late, ts).asc_nulls_last(),
        *ties,
    ]
    return distinct_on(df, key, order)


def change_vs_previous(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str | Column],
    cols: Sequence[str],
) -> DataFrame:
    """Add ``prev_<c>`` and ``chg_<c>``: each column against the row before it."""
    ahead = Window.partitionBy(*partition).orderBy(*sort_keys(order))
    for c in cols:
        df = df.withColumn(f"prev_{c}", F.lag(c, 1).over(ahead))
    return df.select(
        "*", *[(money(c) - money(f"prev_{c}")).alias(f"chg_{c}") for c in cols]
    )
