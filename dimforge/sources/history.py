"""Snapshot history persisted across runs.

Each run writes the complete new history to a folder of its own and commits it under the next
run number (``commits.CommitLog``). Readers take the newest commit and read only its folder, so an
attempt that failed before its commit is never visible, and older runs remain as time travel. Two
writers that start from the same run cannot both commit the next one: the second merges again with
what the first has committed, or fails with a clear error if its date is the older one. Re-submitting a
committed run number is a no-op, which makes retries idempotent. Streams commit (stream, batch) beside the
run, so that a replayed micro-batch is recognised and numbers of other runs never stand for batches.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.scd2 import snapshot_merge
from .commits import CommitLog


@dataclass(frozen=True)
class SnapshotRun:
    """One snapshot run: taken at ``as_of`` over the staged rows matching the filters."""

    as_of: dt.datetime
    crime_filter: str = "true"
    geo_filter: str = "true"


class HistoryStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, self.root)

    def last_run(self) -> int | None:
        last = self.log.last()
        if last is None and (self.log.numbers() or self.log.holds_older_log()):
            raise RuntimeError(f"{self.root} holds no finished commit, or the log of an older layout; refusing to start over")
        return None if last is None else last[0]

    def has_batch(self, stream: str, batch: int) -> bool:
        """Whether this micro-batch of the stream is committed."""
        return any(e.get("stream") == stream and e.get("batch") == batch for _, e in self.log.all())

    def latest(self) -> DataFrame | None:
        """History as of the newest committed run (None before the first run)."""
        last = self.last_run()
        return None if last is None else self.at_run(last)

    def at_run(self, run: int) -> DataFrame:
        entry = self.log.at(run)
        if entry is None:
            raise ValueError(f"run {run} is not committed below {self.root}")
        return self.spark.read.parquet(f"{self.root}/{entry['folder']}")

    def run_at(self, as_of: dt.datetime) -> int | None:
        """The newest run number committed for ``as_of`` (None if there is none)."""
        return max((n for n, e in self.log.all() if e.get("as_of") == as_of.isoformat(sep=" ")), default=None)

    def last_as_of(self) -> dt.datetime | None:
        last = self.log.last()
        return dt.datetime.fromisoformat(last[1]["as_of"]) if last and last[1].get("as_of") else None

    def append(self, history: DataFrame, run: int, as_of: dt.datetime | None = None, stream: str | None = None, batch: int | None = None) -> bool:
        """Commit ``history`` as run ``run``; returns False if that run is already committed, also by another writer meanwhile."""
        last = self.last_run()
        if last is not None and run <= last:
            return False
        folder = f"snapshot_run={run}/{uuid.uuid4().hex[:12]}"
        history.write.parquet(f"{self.root}/{folder}")
        entry = {"folder": folder, "as_of": as_of.isoformat(sep=" ") if as_of else None, "stream": stream, "batch": batch,
                 "committed_at": dt.datetime.now(dt.timezone.utc).isoformat()}
        return self.log.commit(run, entry)


def run_snapshot(
    store: HistoryStore,
    state: DataFrame,
    key: str,
    check_cols: list[str],
    as_of: dt.datetime,
    run: int | None = None,
    stream: str | None = None,
    batch: int | None = None,
    merge=snapshot_merge,
) -> DataFrame:
    """One snapshot run against a persisted history (the incremental production path).

    ``state`` is the current source state (one row per key, e.g. ``latest_per_key`` of
    staging), or with ``merge=scd2.merge_changes`` the keys that changed. The merged history is written as the next run and returned as read back. When another
    writer commits that run first, the state is merged again with the writer's history.
    """
    while True:
        last = store.last_run()
        if last is not None and run is None:
            last_as_of = store.last_as_of()
            if last_as_of == as_of and stream is None:
                return store.at_run(last)  # the run was already committed (retry): no-op
            if last_as_of is not None and as_of < last_as_of:
                raise ValueError(f"snapshot run at {as_of} is older than the last run ({last_as_of})")
        n = run if run is not None else (0 if last is None else max(last + 1, store.log.next_number()))
        merged = merge(state, key, check_cols, as_of, history=None if last is None else store.at_run(last))
        if store.append(merged, n, as_of, stream, batch) or run is not None:
            return store.at_run(n)
