"""Connected components as an iterated DataFrame algorithm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, materialise


def connected_components(edges: DataFrame, label: str = "components", max_rounds: int = 40) -> DataFrame:
    """(node, component): smallest node reachable over ``edges`` (a, b: long); nodes without edges are absent.

    Alternates large-star and small-star steps (each a group-by and an exchange over the surviving edges), written
    to the shared folder after every round, until no edge changes. The star of a node is never gathered in one
    task: both steps need only the minimum neighbour, which partial aggregation finds before the shuffle.
    """
    pairs = materialise(
        edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), label
    )
    before = None
    for _ in range(max_rounds):
        # Large star: each node's larger neighbours move to its smallest neighbour (or itself).
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(pairs.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").where("v <> m").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        ).distinct()
        # Small star: each node and its smaller neighbours move to the smallest of them.
        small_min = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(small_min, "hi")
        nxt = (
            small.where("lo <> m").select(F.col("m").alias("x"), F.col("lo").alias("y"))
            .union(small_min.select(F.col("m").alias("x"), F.col("hi").alias("y")))
            .distinct()
            .select(F.col("x").alias("lo"), F.col("y").alias("hi"))
        )
        nxt = materialise(nxt, label)
        n, s = nxt.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        discard(pairs)
        pairs = nxt
        if (n, s) == before:
            break
        before = (n, s)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
