"""Source tables laid out for the reports: normalised, bucketed and sorted by their join keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeledger.config import GENERATIONS, OLD
from gradeledger.sources.tables import SCHEMAS, ReportSource

#: Tables that are joined on their own keys, and those keys.
BUCKET_KEYS = {
    **{f"balance_{g}": ("financialid", "statementid") for g in GENERATIONS},
    **{f"entity_{g}": ("entityid", "versionid_") for g in GENERATIONS},
    "statement_old": ("pkid_", "versionid_"),
    "statement_metrics_old": ("pkid_", "versionid_"),
}
#: Ids that the new generation keeps as text; a bucket of text is none of a number's.
NUMBERS = ("entityid", "financialid", "statementid")


class BucketedSource(ReportSource):
    """Reads the source tables from the catalog, ``<prefix><name>``, as ``lay_out`` wrote them.

    With ``ReportConfig(splits=1)`` balances then meet the perimeter where they lie: only the
    perimeter is shuffled, to as many partitions as there are buckets.
    """

    def __init__(self, spark: SparkSession, prefix: str):
        super().__init__(spark)
        self.prefix = prefix

    def raw(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}{name}")


def lay_out(source: ReportSource, prefix: str, folder: str, buckets: int) -> BucketedSource:
    """Writes all source tables below ``folder`` and to the catalog as ``<prefix><name>``.

    Tables of ``BUCKET_KEYS`` are dealt by their keys to ``buckets`` files each, sorted. Ids
    that join become numbers in both generations. A table is dealt once before it is
    written, so a bucket is one file, whatever the number of tasks.
    """
    for name in SCHEMAS:
        df = source.table(name)
        if not name.endswith(f"_{OLD}"):
            df = df.withColumns({c: df[c].cast("int") for c in NUMBERS if c in df.columns})
        out = df.write
        if name in BUCKET_KEYS:
            keys = BUCKET_KEYS[name]
            out = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        out.format("parquet").mode("overwrite").option("path", f"{folder}/{name}").saveAsTable(f"{prefix}{name}")
    return BucketedSource(source.spark, prefix)
