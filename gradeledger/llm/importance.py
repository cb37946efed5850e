"""Quality by importance resampling over hashed n-gram models.

Two bags of hashed n-grams are counted: the target's from labelled good documents, and the
raw one from all documents. A document's log weight is the log ratio of their likelihoods.
Keys are log weights plus Gumbel noise; the k documents with the largest keys are a sample
without replacement in proportion to the weights (Gumbel top-k). For the keys, log weights
are tempered to texts of ``GRAMS`` grams: otherwise a long clean text with a rate just below
zero would lose to a short bad one.

k is the number of documents that look like the target: those whose log weight per gram
reaches what all but ``MISS`` of the labelled good documents reach that were left out of the
target model (every other one, by a hash). So k follows the data, and a table of good
documents alone loses next to nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from xxhash import xxh3_64_intdigest

from gradeledger.llm.arrow import MIX_A, mix, raw_texts
from gradeledger.llm.store import stored
from gradeledger.llm.workers import begin, keeps

#: Buckets of the hashed n-grams.
BUCKETS = 1 << 14
#: Labelled good documents that are used, at most: those least by hash. Half make the target
#: model, the others set the bar.
TARGET_DOCS = 20_000
#: Share of the labelled good documents that may fall below the bar.
MISS = 0.002
#: Added to every bucket's share, as a part of an even share.
SMOOTH = 0.05
SEED = 10
#: Length of text that log weights are tempered to in the keys.
GRAMS = 300
#: Documents worked on at once.
ROWS = 500
#: Tokens whose hashes a worker remembers at most.
REMEMBERED = 120_000

_TOKEN = re.compile(rb"[\x80-\xff\w]+|[^\x80-\xff\w\s]+")


class _Hashes(dict):
    """Hash of a token, with the hash of its shape (letter case, length, the signs themselves)."""

    def __missing__(self, token: bytes) -> tuple[int, int]:
        if len(self) >= REMEMBERED:
            self.clear()
        text = token.decode("utf-8", "replace")
        if not (text[0].isalnum() or text[0] == "_"):
            shape = b"." + token[:4]
        elif text.isdigit():
            shape = b"9"
        elif text.isupper() and len(text) > 1:
            shape = b"XX"
        elif text[:1].isupper():
            shape = b"Xx"
        else:
            shape = b"x" * (1 + (len(text) > 12))
        own = self[token] = (xxh3_64_intdigest(token.lower()), xxh3_64_intdigest(shape, 1))
        return own


_HASHES = _Hashes()
keeps("importance", _HASHES.clear)


def gram_buckets(raw: bytes | None) -> np.ndarray:
    """Buckets of a text's n-grams: words and pairs of words in lower case, pairs of shapes,
    and one sign for each token that repeats the one or two places before."""
    tokens = _TOKEN.findall(raw) if raw else []
    if not tokens:
        return np.zeros(0, np.int64)
    both = np.array([_HASHES[t] for t in tokens], np.uint64)
    word, shape = both[:, 0], both[:, 1]
    grams = [word, mix(word[:-1] + MIX_A) + word[1:], mix(shape[:-1] + MIX_A) + shape[1:]]
    again = [np.full(int((word[i:] == word[:-i]).sum()), i, np.uint64) for i in (1, 2)]
    return (mix(np.concatenate([*grams, *again])) >> np.uint64(20)).astype(np.int64) % BUCKETS


def _counts(docs: DataFrame) -> np.ndarray:
    """Grams in each bucket over all of ``docs``: summed on the executors, a row per bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("importance")
        total = np.zeros(BUCKETS, np.int64)
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            for raw in raw_texts(batch, "text"):
                total += np.bincount(gram_buckets(raw), minlength=BUCKETS) if raw else 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total)], ["bucket", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(work, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows.where("n > 0").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def good_ids(labels: DataFrame, limit: int = TARGET_DOCS) -> DataFrame:
    """(doc_id): labelled good and never labelled bad; a bounded sample, the least by hash."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    return good.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def log_ratios(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """log(target / raw) for each bucket; raw counts cover all documents."""
    raw, own = _counts(docs), _counts(target)
    share = lambda c: (c / max(c.sum(), 1) + SMOOTH / BUCKETS) / (1 + SMOOTH)
    return np.log(share(own)) - np.log(share(raw))


def _noise(seed: int) -> Column:
    """Standard Gumbel noise from a hash of the row."""
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def _weights(texts: list[bytes | None], ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of grams and log weight of each text; the grams of one text are held at a time."""
    made = [(len(g), float(ratios[g].sum())) for g in map(gram_buckets, texts)]
    return np.array([n for n, _ in made], np.int64), np.array([x for _, x in made], float)


def weighed(docs: DataFrame, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id, n_grams, log_weight and key."""
    table = docs.sparkSession.sparkContext.broadcast(ratios)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("importance")
        own = table.value
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            n, sums = _weights(raw_texts(batch, "text"), own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(sums), batch.column("noise")],
                ["doc_id", "n_grams", "log_weight", "noise"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("noise", _noise(seed))
    rows = rows.mapInArrow(work, "doc_id long, n_grams long, log_weight double, noise double")
    return rows.withColumn("key", F.lit(GRAMS) * F.col("log_weight") / F.greatest("n_grams", F.lit(1)) + F.col("noise")).drop("noise")


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by narrowing the range with histograms of fixed size."""
    if k <= 0:
        return math.inf
    low, high, n = rows.select(F.min(column), F.max(column), F.count(column)).first()
    if k > n or n == 0:
        return -math.inf
    if k == n:
        return low
    above, bins = 0, 4096
    while high > low:
        step = (high - low) / bins
        if step == 0 or low + step == low:
            break
        slot = F.least(F.floor((F.col(column) - low) / step), F.lit(bins - 1))
        inside = rows.where(F.col(column).between(low, high)).groupBy(slot.alias("s")).agg(
            F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")
        ).orderBy(F.desc("s")).collect()
        for r in inside:
            if above + r["n"] >= k:
                low, high = r["lo"], r["hi"]
                break
            above += r["n"]
    return low


def classify(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_grams, log_weight, key and kept.

    Documents without grams (null, empty, white space) are never kept. Without any good label
    nothing is known and everything with grams is kept. Rows of one id and text get one key
    and stay or go together; a null id can't be labelled but is judged. Further columns are
    ignored; an empty table gives no rows.
    """
    rows, _, least = _threshold(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), labels, seed)
    return rows.withColumn("kept", (F.col("n_grams") > 0) & (F.col("key") >= least))


def _threshold(docs: DataFrame, labels: DataFrame, seed: int) -> tuple[DataFrame, np.ndarray, float]:
    """Weighed documents, the log ratios, and the least key that is kept."""
    half = (F.xxhash64(F.lit(seed), "doc_id") % 2 == 0).alias("model")
    good = stored(good_ids(labels.select(F.col("doc_id").cast("long"), "quality")).select("doc_id", half), "good")
    ratios = log_ratios(docs, docs.join(F.broadcast(good.where("model")), "doc_id", "left_semi"))
    rows = stored(weighed(docs, ratios, seed), "weighed")
    per_gram = F.col("log_weight") / F.col("n_grams")
    known = rows.where("n_grams > 0").join(F.broadcast(good.where("not model")), "doc_id", "left_semi")
    known = known.select(per_gram.alias("x"))
    known = stored(known, "known")
    n = known.count()
    bar = kth_largest(known, "x", n - int(MISS * n)) if n else -math.inf
    k = rows.where((F.col("n_grams") > 0) & (per_gram >= bar)).count()
    return rows, ratios, kth_largest(rows.where("n_grams > 0"), "key", k)


def keep_sampled(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents that ``classify`` keeps, their columns unchanged. Weights are made a
    second time on the rows instead of shuffling texts to meet them."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ratios, least = _threshold(narrow, labels, seed)[1:]
    table = docs.sparkSession.sparkContext.broadcast((ratios, least))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("importance")
        own, bar = table.value
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            n, sums = _weights(batch.column("row").field(at).cast(pa.binary()).to_pylist(), own)
            keys = GRAMS * sums / np.maximum(n, 1) + batch.column("noise").to_numpy()
            kept = batch.filter(pa.array((n > 0) & (keys >= bar)))
            yield pa.RecordBatch.from_arrays([kept.column("row")], ["row"])

    # the caller's columns travel as one, so that none can bear a name used here; a text is read
    # from among them, so that no batch holds it twice
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    at = [c.lower() for c in docs.columns].index("text")
    rows = docs.select(_noise(seed).alias("noise"), row)
    return rows.mapInArrow(work, StructType([StructField("row", docs.schema)])).select("row.*")
