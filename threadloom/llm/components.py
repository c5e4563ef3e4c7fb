"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _least(edges: DataFrame) -> DataFrame:
    """Each node with the least of its neighbours; partial sums come before the shuffle, so hubs do no harm."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (two integer columns); root is the least node reachable.

    Self-loops and repeated edges are harmless; no edges give no rows. Each round is
    written to the shared folder. Raises if ``max_rounds`` do not suffice.
    """
    a, b = edges.columns[:2]
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    was = None
    for _ in range(max_rounds):
        pairs = materialise(pairs, label)
        now = tuple(pairs.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
        if now == was or not now[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        was = now
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = _least(large)
        pairs = (
            large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        )
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
