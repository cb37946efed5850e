"""Joins of tables that both grow: by shuffle, and with each heavy key dealt to as many places as
its weight asks for."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Heavy keys that are told apart at most; more than these can't each hold much.
MOST_HEAVY = 10_000
#: A key is heavy from this many even shares of a partition on.
HEAVY = 2.0


def merge_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by shuffle and sort, whatever sizes Spark expects.

    Before a query runs, Spark knows the size of compressed files only, and that an ``explode``
    makes many rows of one isn't in it. A side that looks below the broadcast threshold
    may thus fill the driver, and each task of the join, however large it is.
    """
    return left.join(right.hint("merge"), list(on), how)


def key_places(df: DataFrame, on: Sequence[str], places: int | None = None) -> Mapping[int, int]:
    """Heavy keys of a join, as hash of the key to number of places.

    One pass over the key columns with a frequent-items sketch, merged on the way: its size is
    fixed, it misses no key that holds a notable share, and its counts only decide how a key is
    dealt, never what the join gives. ``places`` is the number of partitions that the join
    will have, by default the session's.
    """
    spark = df.sparkSession
    places = places or int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = min(max(places, 100), MOST_HEAVY)
    known = df.select(F.xxhash64(*on).alias("key"))
    seen = known.agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(key, {most}, {16 * most})").alias("top")
    ).first()
    even = seen.n / places
    return {
        found["item"]: min(math.ceil(found["count"] / even), places)
        for found in seen.top or () if found["count"] > HEAVY * even
    }


def weighed_join(
    df: DataFrame,
    perimeter: DataFrame,
    on: Sequence[str],
    spread: Sequence[str] | None = None,
    places: Mapping[int, int] | None = None,
) -> DataFrame:
    """Inner join in which the rows of a heavy key of ``df`` go to several places, and only the
    perimeter's rows of such keys are copied, once to each.

    ``places`` comes from ``key_places``, by default of ``df`` itself. ``spread`` names the
    columns that decide a row's place, by default all others.
    """
    places = key_places(df, on) if places is None else places
    if not places:
        return merge_join(df, perimeter, on)
    rest = spread or [c for c in df.columns if c not in on]
    heavy = F.broadcast(df.sparkSession.createDataFrame(
        [(k, n) for k, n in places.items()], "_key long, _places int"
    ))  # at most MOST_HEAVY rows

    def dealt(side: DataFrame) -> DataFrame:
        keyed = side.withColumn("_key", F.xxhash64(*on)).join(heavy, "_key", "left")
        return keyed.withColumn("_places", F.coalesce("_places", F.lit(1))).drop("_key")

    left = dealt(df).withColumn("_place", F.pmod(F.xxhash64(*rest), F.col("_places")).cast("int"))
    right = dealt(perimeter).withColumn("_place", F.explode(F.sequence(F.lit(0), F.col("_places") - 1)))
    return merge_join(left.drop("_places"), right.drop("_places"), [*on, "_place"]).drop("_place")
