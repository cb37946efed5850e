"""Conversations collapsed to maximal ones, then rendered.

Logs often hold a conversation several times, once after each turn. Every prefix of turns
has a hash: the sum over its turns of a hash of position, role and text (two 64-bit hashes in
four sums of 32 bits, exact). Sums roll on from turn to turn, so a long conversation is cut
into blocks whose totals are added first. A conversation whose whole hash is the hash of a
proper prefix of another one goes; of equal ones, that with the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeledger.llm.store import stored

#: Turn numbers in one block.
BLOCK = 1_024
SUMS = ["s0", "s1", "s2", "s3"]
#: The marks of a rendered turn.
START, END = "<|im_start|>", "<|im_end|>"


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, block, position (from 1), role, text and the rolling sums after each turn.

    Equal rows count once. Turns are ordered by (turn, role, text), nulls first.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).distinct()
    rows = rows.withColumn("block", F.coalesce(F.expr(f"turn div {BLOCK}"), F.lit(-(2**60))))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    within = Window.partitionBy("conv_id", "block").orderBy(*order)
    rows = rows.withColumn("at", F.row_number().over(within))
    sizes = stored(rows.groupBy("conv_id", "block").agg(F.count("*").alias("n")), "sizes")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))
    rows = rows.join(starts, same).withColumn("position", F.col("at") + F.col("start")).drop("_c", "_b", "at", "start")
    parts = [F.col("position"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    rows = rows.withColumns({"h0": F.xxhash64(F.lit(0), *parts), "h1": F.xxhash64(F.lit(1), *parts)})
    halves = [f(F.col(h)) for h in ("h0", "h1") for f in (lambda c: c.bitwiseAND(F.lit(0xFFFFFFFF)), lambda c: F.shiftrightunsigned(c, 32))]
    rows = stored(rows.select("conv_id", "block", "position", "role", "text", *(h.alias(s) for h, s in zip(halves, SUMS, strict=True))), "turns")

    totals = rows.groupBy("conv_id", "block").agg(*(F.sum(s).alias(s) for s in SUMS))
    carried = totals.select(
        F.col("conv_id").alias("_c"), F.col("block").alias("_b"), *(F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_{s}") for s in SUMS)
    )
    rolling = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rolled = rows.select("conv_id", "block", "position", *(F.sum(s).over(rolling).alias(s) for s in SUMS))
    rolled = rolled.join(carried, same).withColumns({s: F.col(s) + F.col(f"_{s}") for s in SUMS})
    return rows.drop(*SUMS), rolled.select("conv_id", "position", *SUMS)


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(END + "\n"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """One row per block of ``BLOCK`` turn numbers of each conversation that stays: conv_id,
    n_turns, n_logged (how many equal conversations it stands for), part (from 0) and text.
    The parts of a conversation, one after the other, are its rendering.

    A null conv_id is one conversation. Null roles and texts differ from empty ones but are
    rendered empty. An empty table gives no rows; further columns are ignored.
    """
    rows, prefixes = numbered(turns)
    prefixes = stored(prefixes, "prefixes")
    lengths = prefixes.groupBy("conv_id").agg(F.max("position").alias("n_turns"))
    lengths = lengths.select(F.col("conv_id").alias("_c"), "n_turns")
    marked = stored(prefixes.join(lengths, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c"), "marked")
    key = ["position", *SUMS]
    whole = marked.where("position = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_logged"))
    proper = marked.where("position < n_turns").select(*key).distinct()
    kept = whole.join(proper, key, "left_anti").select(
        F.col("conv_id").alias("_c"), F.col("position").alias("n_turns"), "n_logged"
    )
    texts = rows.join(stored(kept, "kept"), F.col("conv_id").eqNullSafe(F.col("_c")))
    parts = texts.groupBy("conv_id", "n_turns", "n_logged", "block").agg(
        F.array_sort(F.collect_list(F.struct("position", render(F.col("role"), F.col("text")).alias("t")))).alias("turns")
    )
    part = F.row_number().over(Window.partitionBy("conv_id").orderBy("block")) - 1
    return parts.select("conv_id", "n_turns", "n_logged", part.alias("part"), F.array_join(F.col("turns.t"), "").alias("text"))
