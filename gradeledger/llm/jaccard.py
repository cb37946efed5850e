"""Exact Jaccard join of documents on word shingles, by token-combination prefixes.

A document is the set of its distinct shingles ("tokens", 64-bit hashes). Two documents
link when their Jaccard similarity reaches a threshold ``num / den``. With n tokens, a
document may lack at most ``slack = n - ceil(n * num / den)`` of them in any partner.

1. *Sets.* Documents with equal sets are one node; copies are never paired with each other.
2. *Classes.* Tokens in the low part of more than ``rare`` nodes' hash order are frequent.
   All documents order their tokens alike: others by hash, then frequent ones by count and hash.
3. *Signatures.* A prefix of that order is extended until no partner can lack enough of it:
   others count one each and are indexed alone; frequent ones fall into ``groups`` subclasses
   and are indexed as pairs of one subclass, where each subclass counts one less than its
   tokens. Documents too short for pairs use single tokens throughout, and sizes on
   the border use both, so that any two sizes that can link share a form.
4. *Candidates.* Documents under one signature are compared with one pivot per round, never
   all with all; those already in one component are not compared again. What is left when
   rounds no longer help (documents of different components under one signature) is compared
   in full, so no link between components is lost. Each document knows some of its signatures
   before the one at hand; a pair with one of them in common is met there instead.
5. *Verification.* Each set has a bit map: bit i is the parity of its tokens that hash to i.
   Two maps differ in no more bits than the sets differ in tokens, which rules out most pairs
   inside the join that finds them (maps folded to a fixed size) and then nearly all others
   (whole maps, which grow with the set); for the rest, the exact sets of the documents
   concerned are made again from their texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeledger.llm.arrow import list_column, list_rows, mix, raw_texts, shingle_hashes
from gradeledger.llm.components import components
from gradeledger.llm.store import BROADCAST_IDS, BROADCAST_ROWS, join_small, stored
from gradeledger.llm.workers import begin

#: Nodes that may hold a token in their low part before it counts as frequent.
RARE = 48
#: Subclasses of the frequent tokens.
GROUPS = 8
#: The low part of a set, as a multiple of the shortest prefix.
LOW_PART = 1.5
#: Rounds with one pivot per signature, at most.
PIVOT_ROUNDS = 3
#: Pairs left per row at which the rest is compared in full.
FEW_PAIRS = 50
#: Share of the pairs that a pivot round must settle for another one to follow.
HELPS = 0.5
#: A document's signatures before the one at hand by which pairs met before are told.
BEFORE = 8
#: Rounds in which only one pair of each component is verified.
SPANNING_ROUNDS = 1
#: Documents worked on at once.
ROWS = 1_000
#: Words of 64 bits in a set's bit map.
MAP_WORDS = 16
MAPS = [f"m{i}" for i in range(MAP_WORDS)]
#: Bits of the filter that selects the texts needed again (1 MB at most).
FILTER_BITS = 1 << 23


def slack(n: int, num: int, den: int) -> int:
    """Tokens that a set of n may lack in a partner."""
    return n - (n * num + den - 1) // den


def low_size(n: int, num: int, den: int) -> int:
    return min(n, int(LOW_PART * (slack(n, num, den) + 1)) + 2)


def bit_map(tokens: np.ndarray) -> np.ndarray:
    """The parities of a set's tokens by their hash: twice as many bits as tokens or more.

    The number of bits is a power of two. ``fold`` halves a map, which is then the map of
    that size.
    """
    size = 64 * MAP_WORDS
    while size < 2 * len(tokens):
        size *= 2
    slots = ((tokens.view(np.uint64) >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
    parity = (np.bincount(slots, minlength=size) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.int64)


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    while len(bits) > words:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def differing_bits(x: np.ndarray, y: np.ndarray) -> int:
    return int(np.bitwise_count((x ^ y).view(np.uint64)).sum())  # of signed numbers it takes the absolute value


def document_sets(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, sid, n, low, bits, m0, m1, ...): set digest (null without words), size, smallest
    token hashes, and bit map, whole and folded to MAP_WORDS words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            sets = [shingle_hashes(raw, width) for raw in raw_texts(batch, "text")]
            sids = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            low = [s[: low_size(len(s), num, den)] for s in sets]
            bits = [bit_map(s) for s in sets]
            maps = np.array([fold(b, MAP_WORDS) for b in bits], np.int64).reshape(len(bits), MAP_WORDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sids, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), list_column(low),
                 list_column(bits), *(pa.array(np.ascontiguousarray(m)) for m in maps.T)],
                ["doc_id", "sid", "n", "low", "bits", *MAPS],
            )

    schema = "doc_id long, sid binary, n long, low array<long>, bits array<long>, " + ", ".join(f"{m} long" for m in MAPS)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, schema)


def signatures(
    n: int, tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray, num: int, den: int
) -> np.ndarray | None:
    """Signatures of a set of n tokens, of which ``tokens`` are the smallest.

    ``frequent`` are the frequent tokens among them, with their counts. None if these tokens
    don't reach: then the whole set is needed. See the module's third step.
    """
    need = slack(n, num, den) + 1
    others = tokens if not len(frequent) else np.setdiff1d(tokens, frequent, assume_unique=True)
    if len(others) >= need:
        return others[:need]
    if len(tokens) < n:
        return None
    order = np.lexsort((frequent, counts))
    frequent = frequent[order]
    parts = [others]
    least_pairs = -(-(GROUPS + 1) * den * den // (num * num))
    if n <= least_pairs:  # short: each token alone
        parts.append(mix(frequent[: need - len(others)].view(np.uint64)).view(np.int64))
    if n * den >= least_pairs * num:
        group = (frequent.view(np.uint64) % np.uint64(GROUPS)).astype(int)
        reached, first, end = len(others), [True] * GROUPS, 0
        while reached < need and end < len(frequent):
            reached, first[group[end]], end = reached + (not first[group[end]]), False, end + 1
        if reached < need and n > least_pairs:
            raise AssertionError("a set is too short for its prefix")
        for g in range(GROUPS):
            own = np.sort(frequent[:end][group[:end] == g]).view(np.uint64)
            if len(own) > 1:
                i, j = np.triu_indices(len(own), 1)
                parts.append(mix(mix(own[i]) + own[j]).view(np.int64))
    return np.concatenate(parts)


def _sign(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(nid, n, sig or null) from (nid, n, tokens, frequent: array of count and token)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nids, ns = batch.column("nid").to_numpy(), batch.column("n").to_numpy()
            tokens = list_rows(batch, "tokens")
            counts, frequent = list_rows(batch, "counts"), list_rows(batch, "frequent")
            ids, sizes, sigs = [], [], []
            for nid, n, t, c, f in zip(nids, ns, tokens, counts, frequent, strict=True):
                own = signatures(int(n), t, f, c, num, den)
                own = np.unique(own) if own is not None else None
                sigs += own.tolist() if own is not None else [None]
                k = 1 if own is None else len(own)
                ids.append(np.full(k, nid))
                sizes.append(np.full(k, n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids) if ids else [], pa.int64()),
                 pa.array(np.concatenate(sizes) if sizes else [], pa.int64()),
                 pa.array(sigs, pa.int64())],
                ["nid", "n", "sig"],
            )

    return rows.select("nid", "n", "tokens", "counts", "frequent").mapInArrow(work, "nid long, n long, sig long")


def _frequent_of(tokens: DataFrame, frequent: DataFrame) -> DataFrame:
    """(nid, counts, frequent): the frequent ones among each node's tokens."""
    rows = tokens.select("nid", F.explode("tokens").alias("token"))
    found = join_small(rows, frequent, ["token"], "inner", spread=F.col("nid"), limit=BROADCAST_IDS)
    pairs = F.sort_array(F.collect_list(F.struct("token", "count")))
    return found.groupBy("nid").agg(pairs.alias("p")).select(
        "nid", F.col("p.count").alias("counts"), F.col("p.token").alias("frequent")
    )


def _tokens_again(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(nid, n, tokens) of ``nodes``: their whole sets, made again from the texts, once each.

    A bit table of fixed size, set from the wanted ids, keeps most other texts out of the
    work; the join on the set's digest is exact. Rows that repeat an id and a set are made one
    before it.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = (
        nodes.select(slot.alias("s"))
        .groupBy(F.expr("s div 32").alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 32 as int))")).alias("bits"))
        .collect()
    )
    table = np.zeros(FILTER_BITS // 32, np.int64)
    for w, bits in words:
        table[w] = bits
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        bits = shared.value
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            s = batch.column("s").to_numpy()
            wanted = batch.filter(pa.array((bits[s // 32] >> (s % 32)) & 1 == 1))
            sets = [shingle_hashes(raw, width) for raw in raw_texts(wanted, "text")]
            sids = [blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays(
                [wanted.column("doc_id"), pa.array(sids, pa.binary()), list_column(sets)],
                ["doc_id", "sid", "tokens"],
            )

    made = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("s", slot)
    made = made.mapInArrow(work, "doc_id long, sid binary, tokens array<long>").dropDuplicates(["doc_id", "sid"])
    return (
        nodes.select("nid", "n", "doc_id", "sid")
        .withColumnRenamed("doc_id", "_id")
        .join(made, (F.col("_id").eqNullSafe(F.col("doc_id"))) & (nodes["sid"] == made["sid"]))
        .select("nid", "n", "tokens")
    )


def _may_link(num: int, den: int, x: str = "a", y: str = "b") -> Column:
    """Whether sizes nx, ny and bit maps x.m0 ..., y.m0 ... leave room for a link."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    # |x| + |y| - 2 |common| with |common| >= num / (num + den) * (|x| + |y|)
    return (nx * den >= ny * num) & (ny * den >= nx * num) & (_differ(x, y) * (num + den) <= (nx + ny) * (den - num))


class _Verifier:
    """Finds which candidate pairs link. ``prepare`` drops those that whole bit maps rule out
    and makes the exact sets of the documents of the others."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int, num: int, den: int):
        self.docs, self.width, self.num, self.den = docs, width, num, den
        self.ids = nodes.select("nid", "n", "doc_id", "sid")
        self.maps = nodes.select("nid", "n", "bits")

    def _met(self, pairs: DataFrame, lists: DataFrame, *columns: str) -> DataFrame:
        """``pairs`` with ``columns`` of both ends, named a_... and b_..."""
        left, right = (lists.select(F.col("nid").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in columns)) for s in "ab")
        if pairs.count() <= BROADCAST_ROWS:
            return left.join(F.broadcast(pairs), "a").join(right, "b")
        return pairs.join(left, "a").join(right, "b")

    def prepare(self, pairs: DataFrame) -> DataFrame:
        num, den = self.num, self.den

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy()
                differ = np.zeros(len(sizes), np.int64)
                for i, (x, y) in enumerate(zip(list_rows(batch, "a_bits"), list_rows(batch, "b_bits"), strict=True)):
                    words = min(len(x), len(y))
                    differ[i] = differing_bits(fold(x, words), fold(y, words))
                names = ["a", "b", "differ"]
                made = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(differ)], names)
                yield made.filter(pa.array(differ * (num + den) <= sizes * (den - num)))

        pairs = self._met(pairs.select("a", "b"), self.maps, "n", "bits").select("a", "b", "a_n", "b_n", "a_bits", "b_bits")
        pairs = stored(pairs.mapInArrow(work, "a long, b long, differ long"), "likely")
        first, second = (pairs.select(F.col(c).alias("nid")).distinct() for c in ("a", "b"))
        ends = stored(first.unionByName(second).distinct(), "ends")
        wanted = stored(join_small(self.ids, ends, ["nid"], "left_semi", spread=F.col("n"), limit=BROADCAST_IDS), "wanted")
        self.sets = stored(_tokens_again(self.docs, wanted, self.width), "exact")
        return pairs

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose exact sets reach the threshold."""
        num, den = self.num, self.den

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                both = zip(list_rows(batch, "a_tokens"), list_rows(batch, "b_tokens"), strict=True)
                keep = np.zeros(batch.num_rows, bool)
                for i, (x, y) in enumerate(both):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = den * common >= num * (len(x) + len(y) - common)
                yield batch.filter(pa.array(keep)).select(["a", "b"])

        both = self._met(pairs, self.sets, "tokens").select("a", "b", "a_tokens", "b_tokens")
        return stored(both.mapInArrow(work, "a long, b long"), "verified")


def _differ(x: str = "a", y: str = "b") -> Column:
    """Bits in which the maps x.m0 ... and y.m0 ... differ."""
    return sum((F.bit_count(F.col(f"{x}.{m}").bitwiseXOR(F.col(f"{y}.{m}"))) for m in MAPS), F.lit(0))


class _Settled:
    """Links found so far, and the components that they make: ``comp`` (node, comp)."""

    def __init__(self, verify: _Verifier, spark: SparkSession):
        self.verify = verify
        self.links: DataFrame | None = None
        self.comp = spark.createDataFrame([], "node long, comp long")

    def settle(self, pairs: DataFrame, spanning: int = SPANNING_ROUNDS) -> None:
        """Verifies candidates (a, b) until each has both ends in one component or is
        known to be no link. For ``spanning`` rounds only the most alike pair of each component is
        verified, which makes most of the others needless; then all that are left."""
        pairs = self.verify.prepare(pairs)
        for turn in range(spanning + 1):
            ends = self.comp
            for side in ("a", "b"):
                names = ends.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
                pairs = pairs.join(names, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
            pairs = stored(pairs.where("ca <> cb"), "open")
            if pairs.isEmpty():
                return
            chosen = pairs.select("a", "b")
            if turn < spanning:
                each = pairs.select(F.explode(F.array("ca", "cb")).alias("c"), F.struct("differ", "a", "b").alias("p"))
                chosen = each.groupBy("c").agg(F.min("p").alias("p")).select("p.a", "p.b").distinct()
            chosen = stored(chosen, "chosen")
            new = self.verify.links(chosen)
            self.links = new if self.links is None else self.links.unionByName(new)
            self.comp = components(self.links)
            pairs = pairs.join(chosen, ["a", "b"], "left_anti").drop("ca", "cb")


def _in_full(live: DataFrame, maps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of different components under one signature that sizes and maps don't rule
    out, from (sig, nid, comp): each at least once, and under few of the signatures it shares.

    The least signature that a pair shares has no shared one before it, so the pair is met there.
    """
    before = Window.partitionBy("nid").orderBy("sig").rowsBetween(-BEFORE, -1)
    rows = live.select("sig", "nid", "comp").withColumn("before", F.collect_list("sig").over(before)).join(maps, "nid")
    return rows.alias("a").join(rows.alias("b"), (
        (F.col("a.sig") == F.col("b.sig")) & (F.col("a.nid") < F.col("b.nid"))
        & (F.col("a.comp") != F.col("b.comp")) & _may_link(num, den)
        & ~F.arrays_overlap("a.before", "b.before")
    )).select(F.col("a.nid").alias("a"), F.col("b.nid").alias("b"))


def _linked(buckets: DataFrame, nodes: DataFrame, verify: _Verifier, num: int, den: int) -> DataFrame:
    """(node, comp) from (sig, nid); see the module's fourth step."""
    found = _Settled(verify, buckets.sparkSession)
    maps = nodes.select("nid", "n", *MAPS)
    before = None
    for turn in range(PIVOT_ROUNDS + 1):
        named = buckets.join(found.comp.withColumnRenamed("node", "nid"), "nid", "left").select(
            "sig", "nid", F.coalesce("comp", "nid").alias("comp")
        )
        several = named.groupBy("sig").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")
        )
        live = stored(named.join(several.where("lo <> hi").select("sig", "size"), "sig"), "live")
        left = live.select(F.count("*").alias("rows"), F.sum("size").alias("pairs")).first()
        if not left["rows"]:
            break
        within = live.groupBy("sig", "comp").agg(F.count("*").alias("k")).select(F.sum(F.col("k") * F.col("k")))
        pairs = left["pairs"] - within.first()[0]
        helped = before is None or pairs <= (1 - HELPS) * before
        last, before = turn == PIVOT_ROUNDS or not helped or pairs <= FEW_PAIRS * left["rows"], pairs
        if last:
            met = _in_full(live, maps, num, den).distinct()
        else:
            pick = F.xxhash64(F.lit(turn), "nid")
            pivots = live.groupBy("sig").agg(F.min_by("nid", pick).alias("p"), F.min_by("comp", pick).alias("pc"))
            met = live.join(pivots, "sig").where("pc <> comp")
            met = met.select(F.least("p", "nid").alias("x"), F.greatest("p", "nid").alias("y")).distinct()
            met = met.join(maps.alias("a"), F.col("x") == F.col("a.nid"))
            met = met.join(maps.alias("b"), F.col("y") == F.col("b.nid")).where(_may_link(num, den))
            met = met.select(F.col("a.nid").alias("a"), F.col("b.nid").alias("b"))
        found.settle(stored(met, "pairs"), SPANNING_ROUNDS if last else 0)
        if last:
            break
    return found.comp


def jaccard_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id.

    Documents link when den * |intersection| >= num * |union| of their sets of distinct
    ``width``-word shingles (A-Z lower-cased; words end at space and the ASCII control
    spaces; fewer words are one shingle). component_id is the smallest doc_id reachable by
    links, the document itself included.

    Null, empty and wordless texts have the empty set and link with nothing. Repeated rows
    stay rows of their own. A null doc_id takes part; its component is the smallest id that
    isn't null there. Further columns are ignored. An empty table gives no rows.
    """
    sets = document_sets(docs, width, num, den).withColumn("nid", F.monotonically_increasing_id())
    sets = stored(sets, "sets")
    ids = sets.where("n > 0").select("sid", "nid", "doc_id")
    firsts = stored(
        ids.groupBy("sid").agg(F.min("nid").alias("first"), F.min("doc_id").alias("least"), F.count("*").alias("k")),
        "firsts",
    )
    copies = stored(ids.join(firsts.where("k > 1").select("sid", "first"), "sid").where("nid <> first").select("nid"), "copies")
    nodes = join_small(sets.where("n > 0"), copies, ["nid"], "left_anti", spread=F.col("nid"), limit=BROADCAST_IDS)

    tokens = nodes.select("nid", "n", F.col("low").alias("tokens"))
    frequent = stored(
        tokens.select(F.explode("tokens").alias("token")).groupBy("token").count().where(F.col("count") > RARE),
        "frequent",
    )
    empty = F.array().cast("array<long>")
    fill = {"counts": F.coalesce("counts", empty), "frequent": F.coalesce("frequent", empty)}
    signed = stored(
        _sign(tokens.join(_frequent_of(tokens, frequent), "nid", "left").withColumns(fill), num, den), "signed"
    )
    ids = nodes.select("nid", "n", "doc_id", "sid")
    whole = stored(ids.join(signed.where("sig is null"), "nid", "left_semi"), "whole")
    again = stored(_tokens_again(docs, whole, width), "again")
    more = _sign(again.join(_frequent_of(again, frequent), "nid", "left").withColumns(fill), num, den)
    signed = signed.where("sig is not null").unionByName(stored(more, "more")).select("nid", "sig")

    # of the signatures that the same nodes share, one is enough
    members = [F.bit_xor(F.xxhash64(F.lit(i), "nid")).alias(f"x{i}") for i in (1, 2)]
    shared = signed.groupBy("sig").agg(F.count("*").alias("m"), *members).where("m > 1")
    shared = stored(shared.groupBy("m", "x1", "x2").agg(F.min("sig").alias("sig")).select("sig"), "shared")
    buckets = stored(join_small(signed, shared, ["sig"], "left_semi", spread=F.col("nid"), limit=BROADCAST_IDS).distinct(), "buckets")
    comp = _linked(buckets, nodes, _Verifier(docs, nodes, width, num, den), num, den)

    named = firsts.join(comp.withColumnRenamed("node", "first"), "first", "left")
    named = named.select("sid", "least", F.coalesce("comp", "first").alias("comp"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_set = named.select("sid", "comp").join(least, "comp").select("sid", "component_id")
    return sets.select("doc_id", "sid", F.col("n").alias("n_shingles")).join(by_set, "sid", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_per_group(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id; columns
    are unchanged. Equal rows of that id stay once. Rows without an id can't be named and stay,
    as do documents without words."""
    groups = jaccard_components(docs, width, num, den).where("doc_id is not null")
    rows = stored(groups, "groups")
    gone = stored(rows.where("component_id < doc_id").select("doc_id").distinct(), "gone")
    left = join_small(docs, gone, ["doc_id"], "left_anti", spread=F.col("text"), limit=BROADCAST_IDS)
    again = stored(rows.groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id"), "again")
    if again.isEmpty():
        return left
    once = join_small(left, again, ["doc_id"], "left_anti", spread=F.col("text"))
    often = join_small(left, again, ["doc_id"], "left_semi", spread=F.col("text"))
    return once.unionByName(often.dropDuplicates(["doc_id", "text"]))
