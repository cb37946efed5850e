"""Intermediate tables in the shared folder, and joins with tables that are usually small."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a join sends its right side to every executor (a few dozen bytes each).
BROADCAST_ROWS = 200_000
#: The same for tables of one number a row.
BROADCAST_IDS = 1_000_000
#: Parts into which ``join_small`` splits every key of the left side beyond that.
SALTS = 16


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may go without one; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name below the shared one that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written as parquet to the shared folder and read back: cuts the lineage, and a
    lost executor costs no recomputation of what lies before."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Column | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join with a table that has one row per key and is usually small.

    The right side should be a stored table: its rows are counted first. Up to ``limit`` rows
    it is broadcast. Beyond that both sides are shuffled, every key of the left side split
    into ``SALTS`` parts by ``spread`` (an expression that differs within a key), so that a
    hot key never lands in one task. The result is the same either way.
    """
    if right.limit(limit + 1).count() <= limit:
        return left.join(F.broadcast(right), list(on), how)
    salt = F.pmod(F.xxhash64(spread) if spread is not None else F.xxhash64(F.rand()), F.lit(SALTS))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    return (
        left.withColumn("_salt", salt)
        .join(right.withColumn("_salt", salts), [*on, "_salt"], how)
        .drop("_salt")
    )
