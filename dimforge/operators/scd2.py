"""SCD type 2 history operators (K2-K7, K9).

* ``snapshot_merge``   - one check-strategy snapshot run with hard deletes (K2)
* ``merge_changes``     - the same for changed keys and explicit deletes only, as a stream gives them
* ``snapshot_replay``  - many runs in one job, same rows as folding ``snapshot_merge`` (K3)
* ``scd2_validity``    - back-date inaugural versions, close open ends, current flag (K4, K5)
* ``with_current``     - current attributes beside every version (K6)
* ``scd2_from_events`` - versions cut where an attribute changes over event time (K9)

History rows carry ``valid_from`` / ``valid_to`` (NULL = open). Comparisons of the checked
columns are NULL-safe. Every operator shuffles at most on the natural key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_if_small

VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"


def _ts(v: dt.datetime | str) -> Column:
    """Wall-clock literal; built from text so no session/process time zone can shift it."""
    if isinstance(v, dt.datetime):
        v = v.isoformat(sep=" ")
    return F.lit(v).cast("timestamp_ntz")


def _null_ts() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def _same(a: Sequence[Column], b: Sequence[Column]) -> Column:
    out = F.lit(True)
    for x, y in zip(a, b):
        out = out & x.eqNullSafe(y)
    return out


def snapshot_merge(
    state: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: dt.datetime | str,
    history: DataFrame | None = None,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> DataFrame:
    """Apply one snapshot run taken at ``as_of`` with source ``state`` (one row per key).

    new key -> open row; changed -> close at ``as_of`` + open new; unchanged -> keep;
    key missing from state -> close (hard delete); returning key -> new open row.
    Closed history rows pass through untouched. One full outer join on ``key``.
    """
    cols = list(check_cols)
    t = _ts(as_of)
    if history is None:
        return state.select(key, *cols, t.alias(valid_from), _null_ts().alias(valid_to))

    closed = history.where(F.col(valid_to).isNotNull()).select(key, *cols, valid_from, valid_to)
    open_h = history.where(F.col(valid_to).isNull()).select(
        key, *[F.col(c).alias(f"_h_{c}") for c in cols], F.col(valid_from).alias("_h_from")
    )
    src = state.select(key, *[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_s_present"))
    j = open_h.join(src, on=key, how="full_outer")

    h_present = F.col("_h_from").isNotNull()
    s_present = F.col("_s_present").isNotNull()
    same = _same([F.col(f"_h_{c}") for c in cols], [F.col(f"_s_{c}") for c in cols])
    keep_open = s_present & same

    old_row = F.when(
        h_present,
        F.struct(
            *[F.col(f"_h_{c}").alias(c) for c in cols],
            F.col("_h_from").alias(valid_from),
            F.when(keep_open, _null_ts()).otherwise(t).alias(valid_to),
        ),
    )
    new_row = F.when(
        s_present & (~h_present | ~same),
        F.struct(*[F.col(f"_s_{c}").alias(c) for c in cols], t.alias(valid_from), _null_ts().alias(valid_to)),
    )
    merged = (
        j.select(key, F.explode(F.array(old_row, new_row)).alias("_r"))
        .where(F.col("_r").isNotNull())
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in cols], f"_r.{valid_from}", f"_r.{valid_to}")
    )
    return merged.unionByName(closed)


def merge_changes(
    changes: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: dt.datetime | str,
    history: DataFrame | None = None,
    gone: str = "_gone",
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> DataFrame:
    """``snapshot_merge`` for the keys of ``changes`` alone (one row per key); all other keys stay as they are.

    A key whose boolean column ``gone`` is true is an explicit delete: its open version is closed. Equal to the full merge with a
    state in which the changed keys are replaced and the deleted ones left out. The changes are joined to the
    open versions only; closed ones and those of other keys pass through.
    """
    state = changes.where(~F.col(gone)).select(key, *check_cols)
    if history is None:
        return snapshot_merge(state, key, check_cols, as_of, None, valid_from, valid_to)
    keys = changes.select(F.col(key).alias("_changed"))
    touched = F.col(valid_to).isNull() & F.col("_changed").isNotNull()
    marked = history.join(broadcast_if_small(keys), history[key] == keys["_changed"], "left")
    cols = [key, *check_cols, valid_from, valid_to]
    return snapshot_merge(state, key, check_cols, as_of, marked.where(touched).select(*cols), valid_from, valid_to).unionByName(marked.where(~touched).select(*cols))


def snapshot_replay(
    states: Sequence[tuple[dt.datetime | str, DataFrame]],
    key: str,
    check_cols: Sequence[str],
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> DataFrame:
    """Fold any number of snapshot runs in one job (gaps-and-islands over run numbers).

    A version starts where a key appears after an absence or its checked columns change;
    it ends at the next run where the key is absent or changed. Windows are partitioned
    by key and hold at most one row per run, so no key can overload a task.
    """
    cols = list(check_cols)
    u = None
    for i, (_, st) in enumerate(states):
        part = st.select(key, *cols, F.lit(i).alias("_run"))
        u = part if u is None else u.unionByName(part)
    return replay_indexed(u, [a for a, _ in states], key, cols, valid_from, valid_to)


def run_states(
    df: DataFrame,
    filters: Sequence[str],
    key: str,
    attrs: Sequence[str],
    order_by: Sequence[str],
    where: str | None = None,
) -> DataFrame:
    """Latest ``attrs`` per ``key`` for every run in one scan of ``df``.

    Each row gets the set of runs whose filter (SQL text) it passes, and the latest row per (set, key) is
    partially aggregated; only those few rows are then counted towards every run of their set. Time cuts
    make at most one set more than there are runs. Returns ``_run`` (0-based), ``key``, ``attrs``.
    """
    src = df.where(F.col(key).isNotNull())
    if where:
        src = src.where(where)
    passed = F.concat(*[F.when(F.expr(f"({f})"), "1").otherwise("0") for f in filters])
    best = F.max_by(F.struct(*attrs), F.struct(*order_by)).alias("_v")
    latest = src.select(passed.alias("_set"), key, *attrs, *order_by).groupBy("_set", key).agg(best, F.max(F.struct(*order_by)).alias("_at"))
    runs = F.array_compact(F.array(*[F.when(F.substring("_set", i + 1, 1) == "1", F.lit(i)) for i in range(len(filters))]))
    per_run = latest.select(F.explode(runs).alias("_run"), key, "_v", "_at")
    return per_run.groupBy("_run", key).agg(F.max_by("_v", "_at").alias("_v")).select("_run", key, "_v.*")


def replay_indexed(
    states: DataFrame,
    as_ofs: Sequence[dt.datetime | str],
    key: str,
    check_cols: Sequence[str],
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> DataFrame:
    """``snapshot_replay`` over one DataFrame of states tagged with a 0-based ``_run``."""
    cols = list(check_cols)
    n = len(as_ofs)
    u = states
    w = Window.partitionBy(key).orderBy("_run")
    prev_run = F.lag("_run").over(w)
    same_prev = _same([F.col(c) for c in cols], [F.lag(c).over(w) for c in cols])
    starts = prev_run.isNull() | (prev_run != F.col("_run") - 1) | ~same_prev
    grp = F.sum(starts.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    versions = (
        u.withColumn("_grp", grp)
        .groupBy(key, "_grp")
        .agg(
            F.min("_run").alias("_start"),
            F.max("_run").alias("_end"),
            F.min_by(F.struct(*cols), F.col("_run")).alias("_a"),
        )
    )
    run_ts = F.array(*[_ts(a) for a in list(as_ofs)])
    return versions.select(
        key,
        *[F.col(f"_a.{c}").alias(c) for c in cols],
        F.element_at(run_ts, F.col("_start") + 1).alias(valid_from),
        F.when(F.col("_end") < n - 1, F.element_at(run_ts, F.col("_end") + 2)).otherwise(_null_ts()).alias(valid_to),
    )


def scd2_validity(
    history: DataFrame,
    beginning: dt.datetime,
    end: dt.datetime,
    per_key: bool = False,
    key: str | None = None,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> DataFrame:
    """Add ``valido_de`` / ``valido_ate`` / ``flag_versao_atual`` (K4, K5).

    The inaugural version is back-dated to ``beginning`` when its start equals the
    *global* first run (scalar subquery, no join); ``per_key=True`` back-dates each key's
    own first version instead. Open versions end at ``end``.
    """
    if per_key:
        first = F.min(valid_from).over(Window.partitionBy(key))
    else:
        first = history.select(F.min(valid_from)).scalar()
    return history.select(
        "*",
        F.when(F.col(valid_from) == first, _ts(beginning)).otherwise(F.col(valid_from)).alias("valido_de"),
        F.coalesce(F.col(valid_to), _ts(end)).alias("valido_ate"),
        F.col(valid_to).isNull().alias("flag_versao_atual"),
    )


def with_current(
    history: DataFrame,
    key: str,
    attrs: dict[str, str],
    valid_to: str = VALID_TO,
) -> DataFrame:
    """Beside each version, the attributes of the key's open version (K6).

    ``attrs`` maps history column -> output name. A key without an open version (hard
    deleted) gets NULLs. One window per key (few versions per key) instead of a self join.
    """
    cur = F.max(F.when(F.col(valid_to).isNull(), F.struct(*[F.col(a) for a in attrs]))).over(
        Window.partitionBy(key)
    )
    out = history.withColumn("_cur", cur)
    return out.select(
        *history.columns, *[F.col(f"_cur.{a}").alias(name) for a, name in attrs.items()]
    )


def scd2_from_events(
    events: DataFrame,
    key: str,
    attr: str,
    ts: str,
    tie: str,
    end: dt.datetime,
    bucket: str = "hour",
) -> DataFrame:
    """K9: versions from event history - a new version starts at the first event whose
    ``attr`` differs from the key's previous event (ordered by ``ts``, then ``tie``).

    Events are compared inside (key, time bucket) only, so neither a hot key nor one that alternates
    with every event lands in one task. What a bucket has to know of the others, the attribute before
    its first event and the next change after its last, comes from one pre-aggregated row per key and bucket.
    Events with NULL key, attribute or time are ignored.
    """
    e = events.where(F.col(key).isNotNull() & F.col(attr).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("_k"), F.col(attr).alias("_a"), F.col(ts).alias("_ts"), F.col(tie).alias("_tie"),
        F.date_trunc(bucket, F.col(ts)).alias("_b"))
    inside = Window.partitionBy("_k", "_b").orderBy("_ts", "_tie")
    buckets = Window.partitionBy("_k").orderBy("_b")
    last = e.groupBy("_k", "_b").agg(F.max_by("_a", F.struct("_ts", "_tie")).alias("_last"))
    before = last.select("_k", "_b", F.lag("_last").over(buckets).alias("_before"))
    seen = e.withColumn("_prev", F.lag("_a").over(inside)).join(before, ["_k", "_b"])
    prev = F.coalesce("_prev", "_before")
    changes = seen.where(prev.isNull() | (prev != F.col("_a"))).select("_k", "_b", "_a", "_ts", "_tie")
    after = changes.groupBy("_k", "_b").agg(F.min("_ts").alias("_first")).select("_k", "_b", F.lead("_first").over(buckets).alias("_after"))
    ended = changes.withColumn("_next", F.lead("_ts").over(inside)).join(after, ["_k", "_b"])
    return ended.select(F.col("_k").alias(key), F.col("_a").alias(attr), F.col("_ts").alias("valido_de"),
                        F.coalesce("_next", "_after", _ts(end)).alias("valido_ate"))
