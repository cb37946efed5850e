"""Cutting a table to the keys of another before it is shuffled, by a filter of fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filter's size: so many blocks of 4,096 bits, 16 MB at most however many keys there are.
BLOCKS = 1 << 15
#: 64-bit words of a block.
WORDS = 64


class Sieve:
    """A Bloom filter of the rows of ``keys``, made by Spark and broadcast.

    ``cut`` leaves out rows that surely have none of the keys, so that a join behind shuffles
    little more than it finds. It lets some others through: about one in a hundred at 6 million
    keys, most of them from 50 million on, where the filter is full. So it never stands
    for the join. Each key sets two bits of one block. Only blocks that hold a key exist.

    Keys of other types than the ``keys`` have, whose hashes differ, are all let through.
    """

    def __init__(self, keys: DataFrame):
        self.types = [t for _, t in keys.dtypes]
        hashed = F.xxhash64(*keys.columns)
        dealt = keys.select(_block(hashed).alias("_block"), hashed.alias("_hash")).repartition("_block")
        spots = dealt.select("_block", F.explode(F.array(*_bits(F.col("_hash")))).alias("_bit"))
        words = spots.groupBy("_block", F.shiftright("_bit", 6).cast("int").alias("_word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(_bit & 63 AS int)))").alias("_set")
        )
        found = F.map_from_entries(F.collect_list(F.struct("_word", "_set")))
        every = F.sequence(F.lit(0), F.lit(WORDS - 1))
        self.table = words.groupBy("_block").agg(found.alias("_found")).select(
            "_block",
            F.transform(every, lambda w: F.coalesce(F.try_element_at("_found", w), F.lit(0).cast("long")))
            .alias("_words"),
        )

    def cut(self, df: DataFrame, on: Sequence[str | Column]) -> DataFrame:
        """Rows of ``df`` that may have one of the keys; columns in the order of the keys'."""
        if [t for _, t in df.select(*on).dtypes] != self.types:
            return df
        hashed = F.xxhash64(*on)
        fits = _block(hashed) == F.col("_block")
        for bit in _bits(hashed):
            word = F.get("_words", F.shiftright(bit, 6).cast("int"))
            fits &= F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1
        return df.join(F.broadcast(self.table), fits, "left_semi")


def _block(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BLOCKS - 1).cast("long"))


def _bits(hashed: Column) -> list[Column]:
    """Two places in a block, from bits of the hash that don't choose the block."""
    last = F.lit(64 * WORDS - 1).cast("long")
    return [F.shiftrightunsigned(hashed, at).bitwiseAND(last) for at in (24, 44)]
