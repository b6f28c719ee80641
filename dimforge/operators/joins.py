"""Join operators: size-guarded broadcast and the as-of (validity) join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Dimensions within both limits are shipped to every task; above, the join falls back to a
# shuffled sort-merge join (AQE may still switch it at runtime, and splits skewed partitions
# of the large side).
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 128 << 20

# Exact counts observed while a model was written, by its plan (fresh, never rewritten folders).
_ROW_COUNTS: dict[int, int] = {}


def remember_row_count(df: DataFrame, rows: int) -> None:
    """Record an exact count known from elsewhere (e.g. observed while writing ``df``)."""
    _ROW_COUNTS[df.semanticHash()] = rows


def size_bound(df: DataFrame) -> int:
    """Bytes that the optimizer expects at most: file sizes for a written model, no more for a filter or
    projection of it, products for joins. Nothing runs and no file list reaches Python."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, known_rows: int | None = None) -> bool:
    """Size check without a job: ``known_rows`` is a proven bound (e.g. 24 hours + unknown, 2x2 flags) of generated, narrow
    rows. A written model has its observed count, and like anything else has to pass by the optimizer's size in bytes,
    taken as four times compressed."""
    if known_rows is not None:
        return known_rows <= max_rows
    return _ROW_COUNTS.get(df.semanticHash(), 0) <= max_rows and max_rows > 0 and size_bound(df) * 4 <= DEFAULT_BROADCAST_MAX_BYTES


def broadcast_if_small(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, known_rows: int | None = None
) -> DataFrame:
    """Broadcast hint only behind a checked size."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, known_rows) else df


def _left_join(fact: DataFrame, d: DataFrame, cond, fact_keys: Sequence[str], small: bool, how: str) -> DataFrame:
    """Join; on the shuffled (non-broadcast) left-join path, rows with a NULL key skip the
    shuffle - they can never match, and would otherwise all hash into one partition
    (one NULL-heavy key holding a third of the rows would become a single hot task)."""
    if small or how != "left":
        return fact.join(F.broadcast(d) if small else d, cond, how)
    is_null = None
    for k in fact_keys:
        t = fact[k].isNull()
        is_null = t if is_null is None else (is_null | t)
    keyed = fact.where(~is_null).join(d, cond, "left")
    nulls = fact.where(is_null).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in d.schema.fields]
    )
    return keyed.unionByName(nulls)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    take: dict[str, str],
    unknown: dict[str, object] | None = None,
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    known_rows: int | None = None,
    how: str = "left",
) -> DataFrame:
    """Join fact -> dimension on equal keys (C1, C2, C4); NULL results -> unknown value.

    ``on`` pairs (fact column, dim column); ``take`` maps dim column -> output name.
    Dimension columns are renamed before the join, so names never clash.
    """
    unknown = unknown or {}
    d = dim.select(
        *[F.col(dc).alias(f"_k{i}") for i, (_, dc) in enumerate(on)],
        *[F.col(src).alias(f"_t_{out}") for src, out in take.items()],
    )
    small = fits_broadcast(dim, max_rows, known_rows)
    cond = [fact[fc] == d[f"_k{i}"] for i, (fc, _) in enumerate(on)]
    j = _left_join(fact, d, cond, [fc for fc, _ in on], small, how)
    outs = []
    for _, out in take.items():
        c = F.col(f"_t_{out}")
        if out in unknown:
            c = F.coalesce(c, F.lit(unknown[out]))
        outs.append(c.alias(out))
    return j.select(*fact.columns, *outs)


def _carried(fact: DataFrame, d: DataFrame, fact_key: str, ts: str, bucket: str) -> DataFrame:
    """The rows of ``fact`` (key and time not NULL) as ``_row`` with ``_open``, the version of ``d`` that holds at ``ts`` (else NULL).

    Versions and events are put in one order by key and time, and the last version is carried forward. The order is cut
    into time buckets, each of which starts with one row: the version that the buckets before leave open, from one
    pre-aggregated row per key and bucket. So no task gets a whole key, and no version meets an event but its own.
    """
    version = F.struct("_at", *[c for c in d.columns if c not in ("_ak", "_af", "_at")])
    vs = d.where(F.col("_ak").isNotNull() & F.col("_af").isNotNull()).select(F.col("_ak").alias("_k"), F.col("_af").alias("_t"), F.lit(1).alias("_kind"), version.alias("_v"))
    row = F.struct(*[F.col(f"`{c}`") for c in fact.columns])
    es = fact.select(F.col(f"`{fact_key}`").alias("_k"), F.col(f"`{ts}`").alias("_t"), F.lit(2).alias("_kind"), row.alias("_row"))
    both = vs.unionByName(es, allowMissingColumns=True).withColumn("_b", F.date_trunc(bucket, "_t"))
    last = F.max_by("_v", F.when(F.col("_kind") == 1, F.struct("_t", "_v._at")))
    buckets = both.groupBy("_k", "_b").agg(last.alias("_last"), F.max("_kind").alias("_kinds"))
    before = F.last("_last", ignorenulls=True).over(Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    carry = buckets.select("_k", "_b", "_kinds", before.alias("_v")).where("_kinds = 2 AND _v IS NOT NULL").select("_k", "_b", F.lit(0).alias("_kind"), "_v")
    merged = both.unionByName(carry, allowMissingColumns=True)
    order = Window.partitionBy("_k", "_b").orderBy(F.col("_t").asc_nulls_first(), "_kind", "_v._at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_version = merged.withColumn("_open", F.last("_v", ignorenulls=True).over(order)).where("_kind = 2")
    return open_version.select("_row", F.when(F.col("_t") < F.col("_open._at"), F.col("_open")).alias("_open"))


def asof_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    ts: str,
    take: dict[str, str],
    valid_from: str = "valido_de",
    valid_to: str = "valido_ate",
    unknown: dict[str, object] | None = None,
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    known_rows: int | None = None,
    bucket: str = "hour",
) -> DataFrame:
    """As-of / validity join (C3, K8): key equal and ``valid_from <= ts < valid_to``.

    Versions of a key do not overlap. Plans as a broadcast hash join on the key with the range as residual when
    the dimension passes the size check. Otherwise versions and events are merged in time order and the last
    version is carried forward, in buckets of ``bucket`` (hour, day, ...): neither a key with a
    third of the events nor one with very many versions reaches one task, and there is no range residual.
    Unmatched facts, also those without key or time, are kept and get the unknown member.
    """
    unknown = unknown or {}
    d = dim.select(
        F.col(dim_key).alias("_ak"),
        F.col(valid_from).alias("_af"),
        F.col(valid_to).alias("_at"),
        *[F.col(src).alias(f"_t_{out}") for src, out in take.items()],
    )
    def result(column, out):
        return (F.coalesce(column, F.lit(unknown[out])) if out in unknown else column).alias(out)

    if fits_broadcast(dim, max_rows, known_rows):
        cond = (fact[fact_key] == d["_ak"]) & (fact[ts] >= d["_af"]) & (fact[ts] < d["_at"])
        return fact.join(F.broadcast(d), cond, "left").select(*[fact[c] for c in fact.columns], *[result(d[f"_t_{out}"], out) for out in take.values()])
    known = fact[fact_key].isNotNull() & fact[ts].isNotNull()
    whole = fact.where(~known).select(F.struct(*[F.col(f"`{c}`") for c in fact.columns]).alias("_row"))
    j = _carried(fact.where(known), d, fact_key, ts, bucket).unionByName(whole, allowMissingColumns=True)
    return j.select(*[F.col(f"_row.`{c}`").alias(c) for c in fact.columns], *[result(F.col(f"_open._t_{out}"), out) for out in take.values()])
