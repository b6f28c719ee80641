"""Mixing sources to target weights by Pfair scheduling.

Every source's rows are cut into blocks. Block j of a source of weight w (a share of 1) is released at
slot floor(j / w) and due at slot ceil((j + 1) / w); one block is emitted per slot, the released one
with the earliest deadline. Before any slot t each source that has rows left has then emitted within
less than one block of t * w. Weights are taken as they are, as exact whole numbers out of their own
total, so the law holds against the target however long the mix is and however many sources there are.
The law is stated in blocks; a block has as many rows as keep the schedule at about ENTRIES blocks,
so the serial part of the work, the order of the deadlines, does not grow with the table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm.ranks import gapless_rank
from dimforge.session import scratch_path

BLOCK_ROWS = 16  # rows of a block, at least
ENTRIES = 1 << 18  # blocks of a schedule, about: larger tables have larger blocks
MAX_SOURCES = 1 << 18  # sources with weights of their own; beside ENTRIES the bound of what the driver holds and broadcasts
WINDOW_ROWS = 1 << 20  # rows of a source that are numbered in one task, about
SCHEDULE_ROWS = 1 << 18  # scheduled blocks that the driver writes at once
SCHEDULE = "k int, block long, release long, deadline long, slot long"


def whole(weights: list) -> list[int]:
    """The weights times one factor, as whole numbers, without rounding."""
    exact = [Fraction(w) for w in weights]
    scale = lcm(*[w.denominator for w in exact]) if exact else 1
    return [int(w * scale) for w in exact]


def edf(share: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, release, deadline, slot) of ``blocks[k]`` blocks of each source k of whole weight ``share[k]``, by slot.

    Earliest deadline first, ties by the order of the sources. A source that has run out leaves its slots to the
    others or empty, and no deadline is missed. Blocks of weight 0 come after all others.
    """
    total = sum(share)
    waiting = [(0, k, 0) for k, w in enumerate(share) if w and blocks[k]]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple] = []
    slot = 0
    while waiting or ready:
        if not ready and waiting[0][0] > slot:
            slot = waiting[0][0]
        while waiting and waiting[0][0] <= slot:
            release, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // share[k]), k, j, release))
        due, k, j, release = heapq.heappop(ready)
        assert slot < due
        yield k, j, release, due, slot
        slot += 1
        if j + 1 < blocks[k]:
            heapq.heappush(waiting, ((j + 1) * total // share[k], k, j + 1))
    for k, w in enumerate(share):
        for j in range(0 if w else blocks[k]):
            yield k, j, slot, slot + 1, slot
            slot += 1


def scheduled(spark: SparkSession, share: list[int], blocks: list[int], rows_at_once: int = SCHEDULE_ROWS) -> DataFrame:
    """``edf`` as a table. It is laid out once on the driver, a row per block, and written piece by piece."""
    path, laid, piece = "", edf(share, blocks), []

    def table() -> DataFrame:
        names = [c.split()[0] for c in SCHEDULE.split(", ")]
        columns = zip(*piece) if piece else [[]] * len(names)
        return spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names=names)).withColumn("k", F.col("k").cast("int"))

    for row in laid:
        piece.append(row)
        if len(piece) == rows_at_once:
            path = path or scratch_path(spark, "llm-schedule")
            table().write.mode("append").parquet(path)
            piece = []
    if not path:
        return table()
    if piece:
        table().write.mode("append").parquet(path)
    return spark.read.schema(SCHEDULE).parquet(path)


def tempered_weights(docs: DataFrame, source_col: str = "source", alpha: float = 0.5, max_sources: int | None = None) -> tuple[dict, float]:
    """Target weights from the data: rows ** alpha of each source (NULL is a source), and one weight for all rows of other sources.

    All sources have weights of their own, or the ``max_sources`` largest of them. A row per weighted source reaches the driver;
    above MAX_SOURCES of them this raises ValueError."""
    sizes = docs.groupBy(F.col(f"`{source_col}`").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    top = (sizes.limit(MAX_SOURCES + 1) if max_sources is None else sizes.orderBy(F.desc("n"), F.asc_nulls_first("s")).limit(max_sources)).collect()
    if len(top) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: give max_sources")
    rest = 0 if max_sources is None else docs.count() - sum(r.n for r in top)
    named = sorted(((r.s, float(r.n) ** alpha) for r in top), key=lambda x: (x[0] is not None, str(x[0])))
    return dict(named), float(rest) ** alpha if rest else 0.0


def _indexed(spark: SparkSession, weights: dict) -> DataFrame:
    """(__source as text, __k): the place of each source but NULL in the mapping."""
    pairs = [(str(s), k) for k, s in enumerate(weights) if s is not None]
    names, places = zip(*pairs) if pairs else ([], [])
    return spark.createDataFrame(pa.table([pa.array(names, pa.string()), pa.array(places, pa.int64())], names=["__source", "__k"]))


def mix(docs: DataFrame, weights: dict, rest: float = 0.0, id_col: str = "doc_id", source_col: str = "source",
        keep: tuple[str, ...] = (), block_rows: int | None = None, blocks: int | None = None, tie: Column | None = None) -> DataFrame:
    """One row per input row: id, source, block, release, deadline, slot, position, and ``kept`` with the columns ``keep``.

    ``weights`` maps sources (NULL: None) to positive weights; rows of all other sources are one more group of weight
    ``rest`` (0: they come after all others). Inside a source rows come in hash order of their id and ``tie`` (without it, a hash
    of the whole row); repeated and NULL ids keep a place each. ``position`` orders the mix: slot * block_rows + place
    in the block. When a source runs out the others go on in their proportions; no row is dropped or repeated. An
    empty table gives an empty one. Weights are exact; so far apart that a deadline is beyond 64 bits, they raise ValueError.
    ``block_rows`` is BLOCK_ROWS, or more so that the schedule has about ENTRIES blocks.

    The driver counts the rows of each source and lays out the schedule, ENTRIES and MAX_SOURCES blocks at most with
    ``block_rows`` left out; within that bound it is broadcast. Rows with what they keep are shuffled once, to be numbered.
    """
    if any(not 0 < w < float("inf") for w in weights.values()) or not 0 <= rest < float("inf"):
        raise ValueError("weights must be positive")
    if len(weights) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} weights: leave some sources to rest")
    spark, named, other = docs.sparkSession, list(weights), len(weights)
    source = F.col(f"`{source_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), source.alias("source"),
                       F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("kept"), (row_hash(docs) if tie is None else tie).alias("tie"))
    index = F.when(F.col("source").isNull(), F.lit(named.index(None) if None in weights else other)).otherwise(F.coalesce("__k", F.lit(other)))
    rows = rows.join(F.broadcast(_indexed(spark, weights)), F.col("source").cast("string") == F.col("__source"), "left").select("id", "source", index.cast("int").alias("k"), "kept", "tie")
    sizes = {r.k: r.n for r in rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, share = sum(sizes.values()), whole([*weights.values(), rest])
    block_rows = block_rows or max(BLOCK_ROWS, -(-total // ENTRIES))
    many = [-(-sizes.get(k, 0) // block_rows) for k in range(other + 1)]
    if any(w and n * sum(share) // w >= 1 << 62 for w, n in zip(share, many)):
        raise ValueError("weights are too far apart: a block's deadline has no 64-bit number")
    schedule = scheduled(spark, share, many)
    hashed = F.xxhash64("id", "tie")
    ranked = gapless_rank(rows, ["k"], hashed, [hashed, F.col("id"), F.col("tie")], "n", blocks or max(256, total // WINDOW_ROWS), known_groups=other + 1)
    ranked = ranked.withColumn("block", F.expr(f"n div {block_rows}"))
    timed = ranked.join(F.broadcast(schedule) if sum(many) <= ENTRIES + MAX_SOURCES else schedule, ["k", "block"])
    position = F.col("slot") * block_rows + F.expr(f"n % {block_rows}")
    out = timed.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "block", "release", "deadline", "slot", position.alias("position"), "kept")
    return out if keep else out.drop("kept")


def row_hash(docs: DataFrame) -> Column:
    """Hash of a row's values, whatever else is selected beside them."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows and columns of ``docs``, sorted by their position in the mix at tempered weights.

    NULL sources are a source, NULL ids and repeated rows keep a place each, ties are impossible, an empty table gives
    an empty one. Whole rows are shuffled twice: to be numbered in their source, and to their place.
    """
    weights, rest = tempered_weights(docs)
    out = mix(docs, weights, rest, keep=tuple(docs.columns), tie=row_hash(docs), **options)
    return out.orderBy("position").select(*[F.col(f"kept.`{c}`").alias(c) for c in docs.columns])
