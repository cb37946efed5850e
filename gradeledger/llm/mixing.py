"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The mix holds as many words as all sources together. A source whose target is q times its
words and a rest is taken q times whole; the rest is a random part of it. For that, the
documents of a source are dealt by a hash into sqrt(documents) blocks at most, which are put
in a random order, and whole blocks are taken until the rest is reached; of the block on the
border, documents that still fit are taken in random order. Both orders are sorted within a source or a
block and hold about sqrt(documents) rows, so no task sees a whole source.

The units drawn are blocks and their copies. How many units of each source go to which
output shard is drawn by a tree: the root holds the exact numbers of all sources; each node
gives its left half of the shards a multivariate-hypergeometric share of what it holds. A
shard then draws its number of units, without overlap, from the source's permuted units, and
puts its rows in a random order of its own. All randomness is a hash of the seed and of what
is drawn for, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeledger.llm.arrow import mix as mix_bits
from gradeledger.llm.store import join_small, stored
from gradeledger.llm.words import words

SEED = 20
#: Output shards.
SHARDS = 64
#: Documents in a block, about, where a source is small.
LEAST_BLOCK = 256
#: Equal rows that are numbered in one go.
NUMBERED = 10_000
#: A source is repeated this often at most.
REPEATS = 3


def targets(sizes: Sequence[float], weights: Sequence[float], repeats: int = REPEATS) -> list[float]:
    """Shares of the total by weight, none above ``repeats`` times its size; what a source
    can't take is shared by the others by weight, until none is above."""
    total, share = float(sum(sizes)), [0.0] * len(sizes)
    open_, left = [i for i in range(len(sizes)) if sizes[i] > 0], float(sum(sizes))
    while open_ and left > 0:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > repeats * sizes[i]] if weight else open_
        if not full:
            for i in open_:
                share[i] = left * weights[i] / weight
            break
        for i in full:
            share[i] = min(repeats * sizes[i], total)
        left, open_ = left - sum(share[i] for i in full), [i for i in open_ if i not in full]
    return share


def split_units(counts: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Units of each source (rows) for each shard (columns): exact, by the splitting tree."""
    out = np.zeros((len(counts), shards), np.int64)

    def divide(held: np.ndarray, first: int, end: int) -> None:
        if end - first == 1:
            out[:, first] = held
            return
        middle, total = (first + end) // 2, int(held.sum())
        draw = total * (middle - first) // (end - first)
        rng = np.random.default_rng([seed, first, end])
        left = np.zeros_like(held)
        rest = total
        for i, own in enumerate(held.tolist()):  # one margin after the other
            rest -= own
            left[i] = rng.hypergeometric(own, rest, draw) if draw and own else 0
            draw -= left[i]
        divide(left, first, middle)
        divide(held - left, middle, end)

    divide(np.array(counts, np.int64), 0, shards)
    return out


def _key() -> Column:
    """Tells documents apart, also those that share an id."""
    return F.xxhash64("doc_id", "text")


def _fill(block: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Documents of a border block, in random order, as many copies of each (``_m`` of ``_n``) as
    still fit what the block must give; then the one copy more that comes nearest, if the sum
    gets nearer by it."""
    order = mix_bits(block["_key"].to_numpy(np.int64).view(np.uint64) + np.uint64(seed)).argsort(kind="stable")
    block = block.iloc[order].reset_index(drop=True)
    left, taken = block["_part"].iloc[0], []
    for size, n in zip(block["size"], block["_n"], strict=True):
        taken.append(min(n, int(left // size)) if size else n)
        left -= taken[-1] * size
    over = [(abs(left - size), i) for i, size in enumerate(block["size"]) if taken[i] < block["_n"][i]]
    if over and min(over)[0] < left:
        taken[min(over)[1]] += 1
    return block[["_key", "_n"]].assign(_m=taken).query("_m > 0")


def _some_copies(rows: DataFrame) -> DataFrame:
    """``_in`` for ``_m`` of the ``_n`` equal rows of each key.

    Which ones doesn't matter. They are numbered, in several parts where a key has more than
    ``NUMBERED`` rows: a part takes its share to within one row.
    """
    parts = 1 + F.floor(F.col("_n") / NUMBERED)
    rows = rows.withColumn("_number_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts))
    at = F.row_number().over(Window.partitionBy("_key", "_number_part").orderBy(F.lit(1))).cast("long")
    start = F.floor(F.col("_number_part") * F.col("_n") / parts)
    upto = lambda i: F.floor((i * F.col("_m") + start) / F.col("_n"))
    return rows.withColumn("_in", upto(at) > upto(at - 1)).drop("_number_part")


def _hash(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


Weights = Mapping[str | None, float] | Sequence[float]


class _Plan:
    """What is drawn: a row per source, a row per block with the shards of its copies, and the
    documents of border blocks that the rest takes. ``of`` attaches it to documents."""

    def __init__(self, docs: DataFrame, weights: Weights, shards: int, seed: int):
        self.seed = seed
        rows = docs.select("source", F.size(words(F.col("text").cast("string"))).cast("long").alias("size"), "doc_id", _key().alias("_key"))
        rows = stored(rows, "sizes")
        known = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        known.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        names, sizes = [r["source"] for r in known], [r["size"] for r in known]
        cycle = not isinstance(weights, Mapping)
        of = [weights[i % len(weights)] if cycle else weights.get(n, 0.0) for i, n in enumerate(names)]
        goal = targets(sizes, of)
        blocks = [1 << max(0, int(min(np.ceil(np.log2(r["n"]) / 2), np.log2(r["n"] / LEAST_BLOCK)))) for r in known]
        whole = [int(g // s) if s else 0 for g, s in zip(goal, sizes, strict=True)]
        self.sources = stored(docs.sparkSession.createDataFrame(
            [(n or "", n is None, i, int(s), float(g), b, w, float(g - w * s))
             for i, (n, s, g, b, w) in enumerate(zip(names, sizes, goal, blocks, whole, strict=True))],
            "_name string, _null boolean, _source long, source_size long, target double, _blocks long, _whole long, _rest double",
        ), "sources")

        # whole blocks of the rest, in the order of their hash; part: what the rest takes of a block
        rows = self._placed(rows)
        sums = rows.groupBy("_source", "_block", "_whole", "_rest").agg(F.sum("size").alias("words"))
        order = Window.partitionBy("_source").orderBy(_hash(seed + 1, "_source", "_block"), "_block")
        before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
        part = F.greatest(F.least(F.col("_rest") - before, "words"), F.lit(0.0))
        units = sums.withColumn("_part", part).withColumn("n", F.col("_whole") + F.when(F.col("_part") > 0, 1).otherwise(0))
        units = stored(units.drop("_rest", "_whole"), "blocks")
        self.units = stored(self._dealt(units, len(names), shards), "units")

        border = self.units.where("_part > 0 and _part < words").select("_source", "_block", "_part")
        inside = join_small(rows.drop("_part"), stored(border, "border"), ["_source", "_block"], "inner", spread=F.col("_key"))
        # equal rows are one row with their number, so a row that is repeated without end is none
        inside = inside.groupBy("_source", "_block", "_part", "_key").agg(F.min("size").alias("size"), F.count("*").alias("_n"))
        fill = inside.groupBy("_source", "_block").applyInPandas(lambda b: _fill(b, seed), "_key long, _n long, _m long")
        self.border = stored(fill, "taken")
        self.divided = not self.border.where("_m < _n").isEmpty()

    def _placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (source, doc_id, _key) with their source's figures and their block."""
        keyed = rows.withColumns({"_name": F.coalesce("source", F.lit("")), "_null": F.col("source").isNull()})
        known = join_small(keyed, self.sources, ["_name", "_null"], spread=F.col("_key")).drop("_name", "_null")
        return known.withColumn("_block", F.pmod(_hash(self.seed, "_key"), F.col("_blocks"))).drop("_blocks")

    def _dealt(self, units: DataFrame, n_sources: int, shards: int) -> DataFrame:
        """``units`` with ``_shards``: the shard of each copy, drawn by the splitting tree."""
        counts = {r[0]: r[1] for r in units.groupBy("_source").agg(F.sum("n")).collect()}
        quota = split_units([counts.get(i, 0) for i in range(n_sources)], shards, self.seed)
        ends = np.cumsum(quota, axis=1).tolist()
        bounds = units.sparkSession.createDataFrame(list(enumerate(ends)), "_source long, bounds array<long>")
        copies = units.withColumn("copy", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(1), F.col("n").cast("int")))))
        drawn = Window.partitionBy("_source").orderBy(_hash(self.seed + 2, "_source", "_block", "copy"), "_block", "copy")
        copies = copies.withColumn("at", F.row_number().over(drawn) - 1)
        copies = join_small(copies, stored(bounds, "bounds"), ["_source"], "inner", spread=F.col("at"))
        shard = F.size(F.filter("bounds", lambda b: b <= F.col("at"))).alias("shard")
        by_block = copies.groupBy("_source", "_block").agg(F.array_sort(F.collect_list(F.struct("copy", shard))).alias("_shards"))
        return units.drop("n").join(by_block, ["_source", "_block"], "left")

    def of(self, docs: DataFrame) -> DataFrame:
        """``docs`` with source_size, target and copies, in columns of those names with ``_`` before."""
        rows = self._placed(docs.withColumn("_key", _key()))
        rows = join_small(rows, self.units, ["_source", "_block"], spread=F.col("_key"))
        rows = join_small(rows, self.border, ["_key"], spread=F.col("_key"))
        rows = rows.withColumn("_in", F.coalesce(F.col("_m") >= F.col("_n"), F.lit(False)))
        if self.divided:
            some = F.coalesce(F.col("_m") < F.col("_n"), F.lit(False))
            rows = rows.where(~some).unionByName(_some_copies(rows.where(some)))
        in_rest = (F.col("_part") >= F.col("words")) | F.col("_in")
        taken = F.filter(F.coalesce("_shards", F.array()), lambda c: (in_rest & (F.col("_part") > 0)) | (c.copy <= F.col("_whole")))
        return rows.withColumns({
            "_copies": F.transform(taken, lambda c: c.shard), "_source_size": F.col("source_size"), "_target": F.col("target"),
        })


def draws(docs: DataFrame, weights: Weights = (5, 2, 1), shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target, and copies: an
    array of the shards that take it, one entry per repeat, empty if the mix leaves it out.

    ``weights`` are by source, or a cycle over the sources by code point, null last. Null and
    empty texts have size 0 and go with their block. A null source is a source. Equal rows
    lie in one block; of one on the border, some of them are taken and others not. Totals of the sources, a row each, are
    the only rows that come to the driver. An empty table gives no rows; further columns are
    ignored.
    """
    docs = docs.select("doc_id", "source", "text")
    size = F.size(words(F.col("text").cast("string"))).cast("long").alias("size")
    return _Plan(docs, weights, shards, seed).of(docs).select(
        "doc_id", "source", size, F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies")
    )


def mix(docs: DataFrame, weights: Weights = (5, 2, 1), shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix: rows of ``docs``, each as often as it is drawn, dealt to partitions by shard
    and, within a shard, in a random order. Cases are those of ``draws``; columns are kept."""
    plan = _Plan(docs.select("doc_id", "source", "text"), weights, shards, seed)
    named = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select("doc_id", "source", "text", F.struct(*named).alias("_row"))
    rows = plan.of(rows).select("_row", "_key", F.posexplode("_copies").alias("_copy", "_shard"))
    rows = rows.withColumn("_at", _hash(seed + 4, "_key", "_copy"))
    rows = rows.repartition(shards, "_shard").sortWithinPartitions("_shard", "_at")
    return rows.select(*(F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)))
