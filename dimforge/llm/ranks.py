"""Gapless ranks without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


def gapless_rank(df: DataFrame, groups: list[str], spread: Column, order: list[Column], name: str, blocks: int = 256, known_groups: int | None = None) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... within each group (NULL group values are equal), without gaps.

    A hot group is cut into ``blocks`` by the hash column ``spread``; rows are numbered inside
    (group, block), and the block sizes, at most groups x blocks pre-aggregated rows, give the
    offsets. The order is (block, ``order``). Rows that tie in all of them get distinct numbers. Where ``known_groups``
    bounds the number of groups, and with it the offsets by BROADCAST_ROWS, they are broadcast, so rows are shuffled once.
    """
    blk, keys = "__blk", [F.col(f"`{g}`") for g in groups]
    df = df.withColumn(blk, F.pmod(spread, F.lit(blocks)).cast("int"))
    sizes = df.groupBy(*groups, blk).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(f"`{g}`").alias(f"__o_{i}") for i, g in enumerate(groups)], F.col(blk).alias("__o_blk"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    if known_groups is not None and known_groups * blocks <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    numbered = df.withColumn("__row", F.row_number().over(Window.partitionBy(*keys, blk).orderBy(*order)))
    on = [numbered[g].eqNullSafe(offsets[f"__o_{i}"]) for i, g in enumerate(groups)] + [numbered[blk] == offsets["__o_blk"]]
    return numbered.join(offsets, on).select(
        *[numbered[f"`{c}`"] for c in df.columns if c != blk], (F.col("__off") + F.col("__row") - 1).cast("long").alias(name))
