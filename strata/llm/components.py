"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"),
                    F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1_000_003))).alias("s")).first()
    return tuple(row)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of all nodes of undirected edges (u, v), whose root, the
    smallest node of the component, is another node.

    Every round aggregates a node's neighbours to their minimum (map-side
    combined) and joins it back, so a hub's neighbours are never in one row;
    the edges halve their distance to the root each round.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, "edges")
    state = _state(edges)
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _state(edges)
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
