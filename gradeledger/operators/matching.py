"""Joins: rating to grade, rating to entity version (pinned or as-of), scope joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeledger.functions.scalars import presence_flag
from gradeledger.operators.dedup import distinct_on
from gradeledger.operators.skew import merge_join, weighed_join


def attach_grade(df: DataFrame, grades: DataFrame, scale: DataFrame) -> DataFrame:
    """Add the final grade's label (NULL if there is none) and whether one exists.

    The scale is left to Spark's own size check: it is broadcast when it is below
    the threshold and shuffled otherwise. Rows without an approval have no grade and
    stay out of the join, where they would be one hot key.
    """
    asked = df.where(F.col("approveid").isNotNull())
    graded = merge_join(
        asked, grades.select("approveid", "finalgrade"), ["approveid"], "left"
    ).unionByName(
        df.where(F.col("approveid").isNull()), allowMissingColumns=True
    )
    labels = scale.select(F.col("ratingscalekey_").alias("finalgrade"), "ratingscalevalue")
    return graded.join(labels, "finalgrade", "left").select(
        *df.columns,
        "finalgrade",
        "ratingscalevalue",
        presence_flag("ratingscalevalue").alias("graded"),
    )


def match_pinned_version(
    df: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    version_col: str,
    bound: Column,
    ts: str = "sourcepopulateddate_entity",
    splits: int = 2,
) -> DataFrame:
    """Inner join on the keys and the exact version, versions known by ``bound`` only.

    Every pair of a key is wanted here; the rows of a key go to ``splits`` places.
    """
    known = versions.where(F.col(ts) <= bound).withColumnRenamed("versionid_", version_col)
    return in_scope(df, known, [*keys, version_col], splits)


def match_asof(
    df: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    strict: bool = True,
    order: Sequence[str | Column] | None = None,
    bucket: str = "month",
) -> DataFrame:
    """Add to each row the latest version of its key before its own time.

    Rows without an earlier version drop. ``strict`` excludes a version at exactly
    the same time; ``order`` chooses among versions of one key and time.

    No row is paired with more than one version. The distinct times of both sides
    are merged per key and time bucket, and a bucket starts from the last version of
    the buckets before it. A window thus holds one key's distinct times in one
    bucket, or one key's buckets, however many rows the key has; both inputs
    are reduced before they are shuffled.
    """
    payload = [c for c in versions.columns if c not in keys and c != right_ts]
    tie = payload if order is None else order
    probe, version = (0, 1) if strict else (1, 0)

    def at(ts: str) -> list[Column]:
        start = F.trunc(F.col(ts).cast("date"), bucket)
        return [F.col(ts).alias("_ts"), start.alias("_bucket")]

    best = distinct_on(versions.where(F.col(right_ts).isNotNull()), [*keys, right_ts], tie)
    known = best.select(
        *keys, *at(right_ts), F.lit(version).alias("_side"),
        F.struct(right_ts, *payload).alias("_version"),
    )
    asked = df.select(*keys, left_ts).where(F.col(left_ts).isNotNull()).distinct()
    merged = known.unionByName(
        asked.select(*keys, *at(left_ts), F.lit(probe).alias("_side")),
        allowMissingColumns=True,
    )

    has_version = F.col("_version").isNotNull()
    per_bucket = merged.groupBy(*keys, "_bucket").agg(
        F.max_by("_version", F.when(has_version, F.col("_ts"))).alias("_version")
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = per_bucket.withColumn(
        "_version", F.last("_version", ignorenulls=True).over(before)
    ).where(has_version)

    within = Window.partitionBy(*keys, "_bucket").orderBy(
        F.col("_ts").asc_nulls_first(), "_side"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = (
        merged.unionByName(carried.withColumn("_side", F.lit(version)), allowMissingColumns=True)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(within))
        .where((F.col("_side") == probe) & has_version)
        .select(*keys, F.col("_ts").alias(left_ts), "_version.*")
    )
    return merge_join(df, answers, [*keys, left_ts])


def latest_before(
    df: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    order: Sequence[str | Column] = (),
    splits: int = 2,
) -> DataFrame:
    """As-of match for at most one row per key: the latest version strictly before it.

    With one row per key the join yields no more rows than there are versions. The
    versions of a key are split, the row copied to each split, so that the top-1
    behind the join starts in every split and only its winners are shuffled.
    """
    pairs = in_scope(versions, df, keys, splits)
    return distinct_on(
        pairs.where(F.col(right_ts) < F.col(left_ts)), keys, [f"-{right_ts}", *order]
    )


def in_scope(
    df: DataFrame,
    perimeter: DataFrame,
    on: Sequence[str],
    splits: int = 1,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``df`` that the perimeter asks for, with the perimeter's columns.

    Both sides grow with the number of entities, so neither is broadcast. With
    ``splits`` the rows of one key go to that many places and the perimeter is copied
    to each, so a key that holds a large part of ``df`` does not end in one task.
    Use it where a grouping by the same key follows the join: without the split both
    would share one partitioning, and adaptive execution could not divide it.

    With ``splits=0`` the keys of ``df`` are weighed first: each heavy one gets as many places
    as its rows ask for, and nothing is copied for the others.

    ``spread`` names the columns that decide the place, by default all others; name
    those that are read anyway, so that the scan stays narrow.
    """
    if splits == 0:
        return weighed_join(df, perimeter, on, spread)
    if splits > 1:
        rest = spread or [c for c in df.columns if c not in on]
        place = F.pmod(F.xxhash64(*rest), F.lit(splits)).cast("int")
        places = F.explode(F.array(*[F.lit(i) for i in range(splits)]))
        df, perimeter = df.withColumn("_split", place), perimeter.withColumn("_split", places)
        return merge_join(df, perimeter, [*on, "_split"]).drop("_split")
    return merge_join(df, perimeter, on)
