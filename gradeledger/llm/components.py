"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeledger.llm.store import join_small, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for each node of ``edges`` (a, b); comp is one of the component's nodes.

    Each round, every node takes the least of itself and its neighbours, in an order drawn
    anew from a hash, and links are moved to the nodes taken; links within a node go. A
    constant share of the nodes goes with each round whatever the shape, chains included.
    Minima are pre-aggregated, so a node with very many links is no burden. Null ends and
    links from a node to itself are ignored; an empty table gives none.
    """
    spark = edges.sparkSession
    edges = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(), "links",
    )
    names: DataFrame | None = None
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        taken = stored(
            both.groupBy("a").agg(F.min(order("b").h).alias("h"), F.min_by("b", order("b").h).alias("v"))
            .select(
                F.col("a").alias("node"),
                F.when(F.col("h") < order("a").h, F.col("v")).otherwise(F.col("a")).alias("next"),
            ), "taken",
        )
        names = taken.withColumnRenamed("next", "comp") if names is None else stored(
            join_small(names, taken.withColumnRenamed("node", "comp"), ["comp"], spread=F.col("node"))
            .select("node", F.coalesce("next", "comp").alias("comp")), "names",
        )
        for side, other in (("a", "b"), ("b", "a")):
            ends = taken.select(F.col("node").alias(side), F.col("next").alias(f"new_{side}"))
            edges = join_small(edges, ends, [side], "inner", spread=F.col(other))
        edges = stored(
            edges.where("new_a <> new_b")
            .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
            .distinct(), "links",
        )
    if names is None:
        names = spark.createDataFrame([], "node long, comp long")
    return names
