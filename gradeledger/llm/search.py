"""Ranked lexical search: the documents that score highest for each of a set of texts.

The texts to search for come in blocks of a bounded number of terms. For each block, one pass
over the documents keeps their terms that the block has, with the number of times; counts over
all documents give the weights; then every task builds ball trees over its vectors, a few
thousand at a time, and searches them for all texts of the block, keeping the k best so far as
the bar for the next tree. The k best of each task meet in one group-limited ranking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeledger.llm.arrow import list_column, list_rows, raw_texts
from gradeledger.llm.balltree import BallTree, Queries, Vectors, in_parts
from gradeledger.llm.store import stored

#: Entries (text, term) of one block of searched texts, about.
BLOCK_ENTRIES = 500_000
#: Vectors, and entries of vectors, of one tree.
TREE_ROWS, TREE_ENTRIES = 4096, 1_000_000

# Terms are runs of other bytes than the ASCII signs; A-Z are lower-cased.
_SIGNS = bytes(b for r in ((0, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)) for b in range(r[0], r[1] + 1))


def _table() -> bytes:
    """Signs become spaces, A-Z become a-z."""
    out = bytearray(range(256))
    for b in _SIGNS:
        out[b] = 0x20
    for b in range(ord("A"), ord("Z") + 1):
        out[b] = b + 32
    return bytes(out)


_TABLE = _table()


def terms_of(raw: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats; null has none."""
    return raw.translate(_TABLE).split() if raw else []


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, total: int, length: int) -> np.ndarray:
    """Scores of one unit of weight, for rows (tf, terms of the document)."""
    m = np.array([10 + 90 * int(x) * total // length for x in n], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of all rows of an id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for item, raw in zip(batch.column("item_id").to_pylist(), raw_texts(batch, "text"), strict=True):
                own = {*terms_of(raw)}
                ids += [item] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])

    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "item_id long, term binary").distinct()


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), and terms of the vocabulary with tf, ascending; documents
    without a term of any kind are left out."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            ids, n, terms, counts = [], [], [], []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch, "text"), strict=True):
                all_terms = terms_of(raw)
                if all_terms:
                    mine = np.fromiter((x for x in map(number, all_terms) if x is not None), np.int32)
                    mine, count = np.unique(mine, return_counts=True)
                    ids.append(doc_id)
                    n.append(len(all_terms))
                    terms.append(mine)
                    counts.append(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), list_column(terms, np.int32), list_column(counts, np.int64)],
                ["doc_id", "n", "terms", "tf"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "doc_id long, n long, terms array<int>, tf array<bigint>")


def _document_counts(vectors: DataFrame, width: int) -> dict[int, int]:
    """Documents that hold each term of the vocabulary: one row per task and term, then summed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width, np.int64)
        for batch in batches:
            counts += np.bincount(np.concatenate([np.zeros(0, np.int64), *list_rows(batch, "terms")]).astype(np.int64), minlength=width)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["term", "df"])

    rows = vectors.select("terms").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in rows.collect()}  # at most one row per term of the block


def _search_block(docs: DataFrame, entries: list[tuple[int | None, bytes]], k: int) -> DataFrame:
    """item_id, doc_id, score: the k best of each task for each item."""
    context = docs.sparkSession.sparkContext
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, t in entries}))}
    vectors = stored(_vectors(docs, vocabulary), "vectors")
    all_ = vectors.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    total, length, width = all_.n, all_.length or 1, len(vocabulary)
    weights = {t: weight(total, df) for t, df in _document_counts(vectors, width).items()}
    of_item: dict[int | None, list[int]] = {}
    for item, term in entries:
        t = vocabulary[term]
        if weights.get(t, 0) > 0:
            of_item.setdefault(item, []).append(t)
    items = [*of_item]
    flat = np.array([t for i in items for t in sorted(of_item[i])], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(of_item[i]) for i in items], dtype=np.int64)])
    sent = context.broadcast((items, Queries(starts, flat, np.array([weights[t] for t in flat.tolist()], np.int64))))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[Vectors]:
        ids, rows, values, size = [], [], [], 0
        for batch in batches:
            terms, tf = list_rows(batch, "terms"), list_rows(batch, "tf")
            for doc_id, n, mine, count in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), terms, tf, strict=True):
                ids.append(doc_id)
                rows.append(mine)
                values.append(impacts(count, np.array([n]), total, length))
                size += len(mine)
                if len(ids) >= TREE_ROWS or size >= TREE_ENTRIES:
                    yield _together(ids, rows, values)
                    ids, rows, values, size = [], [], [], 0
        if ids:
            yield _together(ids, rows, values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = sent.value
        best: list[list] = [[] for _ in names]
        for vectors in trees(batches):
            tree = BallTree(vectors, width)
            for first, part in in_parts(queries):
                tree.search(part, best[first : first + len(part)], k)
        rows = [(name, None if null else doc_id, -score) for name, found in zip(names, best, strict=True) for score, null, doc_id in found]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return vectors.where(F.size("terms") > 0).mapInArrow(work, "item_id long, doc_id long, score long")


def _together(ids: list, rows: list[np.ndarray], values: list[np.ndarray]) -> Vectors:
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
    return Vectors(ids, starts, np.concatenate(rows).astype(np.int64), np.concatenate(values))


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: the ``k`` documents (doc_id, text) that score
    highest for each item (item_id, text), if above 0.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))) over the N documents with terms;
    a document gives it (10^9 tf) div (1000 tf + 8 m), where m = 10 + (90 n N) div L.

    An item's terms are those of all rows with its id, once each; null is an id like others.
    Null and empty texts have no terms; such items have no rows. Repeated documents are ranked
    each; of equal scores the smaller doc_id comes first, null last. Further columns are
    ignored; an empty table on either side gives no rows. Long texts count whole; a worker
    holds one batch of texts, and up to ``TREE_ENTRIES`` entries (or one document's) in a tree.
    """
    entries = stored(_item_terms(items), "item-terms")
    size = entries.count()
    blocks = max(-(-size // BLOCK_ENTRIES), 1)
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found: DataFrame | None = None
    for b in range(blocks):
        own = entries if blocks == 1 else entries.where(block == b)
        rows = [(r.item_id, bytes(r.term)) for r in own.collect()]  # about BLOCK_ENTRIES
        if rows or (found is None and b == blocks - 1):
            part = _search_block(docs, rows, k)
            if blocks > 1:
                part = stored(part, "found")
            found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int"), "doc_id", "score")
