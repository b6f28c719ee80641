"""Incremental loading with Structured Streaming.

The original reloads the whole raw file and re-runs staging and snapshots in batch.
Here new raw files dropped into a landing folder are picked up incrementally:

* ``stream_staging``  - file source (all-text landing schema) -> staging projection ->
  Parquet sink. Exactly-once through the checkpoint; ``availableNow`` processes what has
  arrived and stops, so it runs as a scheduled job too.
* ``stream_snapshots`` - the latest state per natural key is a streaming aggregation
  (``max_by`` keeps one row of state per key); every micro-batch is one snapshot run:
  the keys it touches are merged into the persisted history (``HistoryStore``) under the next
  run number; the log keeps (stream, batch id), so a replayed batch is a no-op.

Both keep all state inside Spark (checkpointed state store); nothing passes through the
driver except the batch id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.scd2 import merge_changes
from ..plans.staging import stage_crimes, staged_and_quarantined
from ..sources.history import HistoryStore, run_snapshot
from ..sources.landing import read_landing_stream
from ..sources.tables import materialize


def stream_staging(
    spark: SparkSession,
    landing_dir: str,
    staged_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    lenient: bool = False,
    quarantine_dir: str | None = None,
) -> StreamingQuery:
    """Type and clean newly landed raw files into the staging table (append-only).

    Strict by default, like batch staging: a malformed line or value stops the feed. With ``lenient=True`` lines that cannot
    be staged go to ``quarantine_dir`` (by default beside ``staged_dir``) with the reason, as in ``plans.staging.staged_and_quarantined``;
    each micro-batch writes its own folder of both tables, so a replayed batch replaces what it had written.
    """
    raw = read_landing_stream(spark, landing_dir, checked=lenient)
    if lenient:
        bad_dir = quarantine_dir or f"{staged_dir.rstrip('/')}_quarantine"

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            for df, to in zip(staged_and_quarantined(batch), (staged_dir, bad_dir)):
                df.write.mode("overwrite").parquet(f"{to.rstrip('/')}/batch={batch_id}")

        w = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    else:
        w = (stage_crimes(raw).writeStream.format("parquet").outputMode("append")
             .option("path", staged_dir).option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_snapshots(
    staged: DataFrame,
    store: HistoryStore,
    key: str,
    check_cols: list[str],
    ts: str,
    tie: str,
    checkpoint_dir: str,
    where: str | None = None,
    available_now: bool = True,
    clock=lambda: dt.datetime.now().replace(microsecond=0),
    deleted: str | None = None,
) -> StreamingQuery:
    """Keep a persisted SCD2 history of ``staged`` (a streaming DataFrame) up to date.

    The streaming aggregation holds, per key, the attributes of its latest row. In ``update`` mode a micro-batch
    sees the keys that its rows touch and no others, and only those are merged into the history
    (``scd2.merge_changes``). A key whose latest row satisfies the condition ``deleted`` (SQL text) is closed, and opens again with
    its next row. State is one row per natural key, independent of the event volume; the input is partially aggregated
    per micro-batch before the state update.
    """
    src = staged if where is None else staged.where(where)
    src = src.where(F.col(key).isNotNull())
    stream = checkpoint_dir.rstrip("/")  # batch ids count within a checkpoint
    gone = F.coalesce(F.expr(f"({deleted})"), F.lit(False)) if deleted else F.lit(False)
    latest = src.groupBy(key).agg(
        F.max_by(F.struct(*check_cols, gone.alias("_gone")), F.struct(ts, tie)).alias("_v")
    )

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if store.has_batch(stream, batch_id):
            batch.write.format("noop").mode("overwrite").save()  # a replay: the state store has to see its batch consumed
            return
        changes = materialize(batch.sparkSession, batch.select(key, "_v.*"), "stream-changes")  # the batch is consumed once
        run_snapshot(store, changes, key, check_cols, clock(), stream=stream, batch=batch_id, merge=merge_changes)

    w = latest.writeStream.outputMode("update").foreachBatch(merge_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
