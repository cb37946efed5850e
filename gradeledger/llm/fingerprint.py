"""Homomorphic multiset hashes of documents.

A document is the multiset of its paragraphs (split at every line feed). Each paragraph is
hashed to a wide vector; the fingerprint is the sum of the vectors, each place modulo a power
of two. Order doesn't matter, and a paragraph is inserted or deleted by adding or subtracting
its vector. The vector has two parts:

* ``LANES`` places modulo 2**64 from SHAKE-128 of the paragraph: equality of multisets;
* ``PLACES`` places modulo 2**32: the paragraph's 8-byte windows and its digest each add 1 or
  -1 to one place. Read as signed numbers, the sums estimate inner products of the texts'
  window counts, so fingerprints of alike texts are alike.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256, shake_128

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeledger.llm.arrow import mix

LANES = 32
PLACES = 256
WINDOW = 8
WIDTH = 8 * LANES + 4 * PLACES
#: Documents in a bucket of neighbours, about.
BUCKET = 2_000
#: Buckets at most; beyond, buckets grow.
MOST_BUCKETS = 20_000


class Fingerprint:
    """The sum of paragraph vectors."""

    __slots__ = ("lanes", "places")

    def __init__(self, lanes: np.ndarray, places: np.ndarray):
        self.lanes, self.places = lanes, places

    @classmethod
    def of(cls, text: bytes) -> Fingerprint:
        """Fingerprint of a text in UTF-8. The empty text has one empty paragraph."""
        paragraphs = text.split(b"\n")
        digests = b"".join(shake_128(p).digest(8 * LANES) for p in paragraphs)
        vectors = np.frombuffer(digests, "<u8").reshape(len(paragraphs), LANES)
        own = mix(vectors[:, 0])
        signs = [own]
        data = np.frombuffer(text, np.uint8)
        if len(data) >= WINDOW:
            windows = np.zeros(len(data) - WINDOW + 1, np.uint64)
            for i in range(WINDOW):
                windows |= data[i : i + len(windows)].astype(np.uint64) << np.uint64(8 * i)
            ends = np.concatenate([[0], np.cumsum(data == 10)])
            signs.append(mix(windows[ends[WINDOW:] == ends[: len(windows)]]))  # within a paragraph
        places = np.zeros(PLACES, np.int64)
        for h in signs:
            at = (h >> np.uint64(40)) % np.uint64(PLACES)
            up = (h >> np.uint64(20)) & np.uint64(1)
            places += np.bincount(at.astype(np.int64) * 2 + up.astype(np.int64), minlength=2 * PLACES).reshape(-1, 2) @ [-1, 1]
        return cls(vectors.sum(axis=0, dtype=np.uint64), places.astype(np.uint32))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.lanes + other.lanes, self.places + other.places)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.lanes - other.lanes, self.places - other.places)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and self.data() == other.data()

    def __hash__(self) -> int:
        return hash(self.data())

    def data(self) -> bytes:
        return self.lanes.astype("<u8").tobytes() + self.places.astype("<u4").tobytes()

    def text(self) -> str:
        return base64.b64encode(self.data()).decode()

    @classmethod
    def read(cls, text: str) -> Fingerprint:
        data = base64.b64decode(text)
        return cls(np.frombuffer(data[: 8 * LANES], "<u8").copy(), np.frombuffer(data[8 * LANES :], "<u4").copy())

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints; else 2 x.y / (x.x + y.y) of the signed places, within 0 and 1."""
        if np.array_equal(self.lanes, other.lanes):
            return 1.0
        x, y = self.places.astype(np.int32).astype(float), other.places.astype(np.int32).astype(float)
        square = float(x @ x + y @ y)
        return min(max(2 * float(x @ y) / square, 0.0), 1.0) if square else 0.0


def edit(text: str, following: str) -> tuple[str, str, str]:
    """``text`` with its last quarter of code points replaced by the first as many of
    ``following``; and the paragraphs from the cut on, before and after."""
    quarter = len(text) // 4
    cut = len(text) - quarter
    start = text.rfind("\n", 0, cut) + 1
    edited = text[:cut] + following[:quarter]
    return edited, text[start:], edited[start:]


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and bucket, plus per bucket one row with ``last``: the document after it.

    Documents in order of (doc_id, text), null ids first, are cut into buckets by quantiles
    of the ids. The first document of each bucket is repeated at the end of the bucket before
    (that of the first one at the end of the last), so neighbours always meet in one bucket.
    Only the buckets' bounds and first ids come to the driver.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = rows.count()
    n = int(min(max(count // BUCKET, 1), MOST_BUCKETS))
    bounds = np.unique(rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n))) if n > 1 else np.zeros(0)

    @F.pandas_udf("int")
    def bucket(ids):
        return pd.Series(np.searchsorted(bounds, ids.fillna(-np.inf).to_numpy(float), "right").astype(np.int32))

    placed = rows.withColumn("bucket", bucket("doc_id") if len(bounds) else F.lit(0))
    ids = placed.select("doc_id", "bucket").groupBy("bucket").agg(
        F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("first")
    ).orderBy("bucket").collect()
    before = {r["first"]: ids[i - 1]["bucket"] for i, r in enumerate(ids)}
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    firsts = rows.where(key.isin([int(i) for i in before])).withColumn("key", key).groupBy("key", "doc_id").agg(F.min("text").alias("text"))
    targets = docs.sparkSession.createDataFrame([(int(k), int(b)) for k, b in before.items()], "key long, bucket int")
    ends = firsts.join(targets, "key").select("doc_id", "text", "bucket", F.lit(True).alias("last"))
    return placed.withColumn("last", F.lit(False)).unionByName(ends)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many
    (or all) of the next document by (doc_id, text); after the last comes the first. Its
    fingerprint is made from the document's: paragraphs from the cut on are subtracted, those
    of the edited text added. Null texts count as empty; null ids come first; repeated rows
    follow each other; further columns are ignored; an empty table gives no rows.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document before: id, text, bucket, fingerprint
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "last")]
            for doc_id, text, bucket, last in zip(*columns, strict=True):
                own = Fingerprint.of(text.encode())
                if held is not None and held[2] == bucket:
                    at, before, _, mark = held
                    edited, old, new = edit(before, text)
                    changed = mark - Fingerprint.of(old.encode()) + Fingerprint.of(new.encode())
                    out.append((
                        at, len(before), sha256(edited.encode()).hexdigest(), mark.text(), changed.text(),
                        mark.likeness(changed), mark.likeness(own),
                    ))
                held = None if last else (doc_id, text, bucket, own)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], _arrow_schema(names))

    rows = with_next(docs).repartition("bucket").sortWithinPartitions("bucket", "last", "doc_id", "text")
    return rows.mapInArrow(work, schema)


def _arrow_schema(names: list[str]) -> pa.Schema:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.schema(list(zip(names, kinds, strict=True)))
