"""Keeping a result that several branches of one plan read."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session, where there is one machine, may go
    without a named one."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named is None and re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        named = tempfile.mkdtemp(prefix="gradeledger-")
    if named is None:
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    return named


def shared(df: DataFrame, mode: str) -> DataFrame:
    """Compute once, read many times.

    ``persist`` spills to disk and is recomputed from its lineage when an executor
    is lost; ``checkpoint`` writes to the shared folder and cuts the lineage; ``files`` does so
    in parquet, and lets go of the shuffles that made the result.
    """
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "checkpoint":
        context = df.sparkSession.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_dir(df.sparkSession))
        return df.checkpoint(eager=True)
    if mode == "files":
        return stored(df)
    return df


def stored(df: DataFrame) -> DataFrame:
    """``df`` as parquet in the shared folder, read from there.

    What a query shuffles stays on the executors' disks until the driver's collector finds that
    nothing holds the query. A driver with room may not collect before a long report is through,
    so it is asked to: a report in steps then needs the disk of its largest one, not of all.
    """
    spark, folder = df.sparkSession, f"{shared_dir(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(folder)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a ``stored`` result, which nothing reads any longer."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


class Keeper:
    """``shared`` for one run: remembers what it kept, to let go of it afterwards."""

    def __init__(self, mode: str):
        self.mode = mode
        self.kept: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        kept = shared(df, self.mode)
        self.kept.append(kept)
        return kept

    def release(self) -> None:
        for df in self.kept:
            if self.mode == "persist":
                df.unpersist()
            elif self.mode == "files":
                drop_stored(df)
        self.kept.clear()


Keep = Callable[[DataFrame], DataFrame]
