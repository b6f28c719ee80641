"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.session import checkpoint_root


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v of any one orderable type); root is the component's smallest node.

    Every round links nodes to smaller neighbours, first the larger neighbours of each node, then the
    smaller ones, until nothing changes (rounds grow with the logarithm of the longest path). Minima are
    partially aggregated and joined back, so a node that holds a third of all edges is split by AQE.
    Each round is a checkpoint in the shared folder; only a row count and a checksum reach the driver.
    Self-links, repeated and NULL edges are dropped; no edge gives an empty result.
    """
    checkpoint_root(edges.sparkSession)

    def oriented(x: DataFrame) -> DataFrame:  # u > v, once each
        return x.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(x: DataFrame):
        return x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    cur = oriented(edges.select("u", "v")).checkpoint()
    last = state(cur)
    for _ in range(max_rounds):
        if not last[0]:
            break
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, both.u == low.k).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = oriented(large).checkpoint()  # every larger neighbour hangs on the smallest node around
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u")
        cur = oriented(hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))).checkpoint()
        now = state(cur)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
