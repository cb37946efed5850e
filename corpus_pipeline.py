"""A corpus pipeline: filter, deduplicate, mix and encode ``documents``.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gradeledger.llm.bpe import encode_decode
from gradeledger.llm.importance import keep_sampled
from gradeledger.llm.jaccard import one_per_group
from gradeledger.llm.mixing import mix
from gradeledger.llm.queries import VOCABULARY, ship, table
from gradeledger.llm.rules import keep_good
from gradeledger.llm.store import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    ship(spark)
    return keep_sampled(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level quality rules keep."""
    ship(spark)
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by five-word shingles at 0.8 or more."""
    ship(spark)
    return one_per_group(docs, width=5, num=80, den=100)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights: documents as often as they are drawn."""
    ship(spark)
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of their decoding."""
    ship(spark)
    return encode_decode(docs, VOCABULARY, ("ids", "ids_sha256", "decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classifier),
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("source_mixing", mixing),
    ("bpe_encoding", encoding),
]

#: The classifier's and the encoder's arithmetic has no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result but the last written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
