"""A7 across runs: which partition every key of a table is in, without reshuffling the table's keys.

The index is an append-only Parquet table in hash buckets of the key: (key, part, attempt), newest attempt last. A run
joins its new keys with it bucket by bucket, so only the new keys are shuffled; the index itself is read where it lies.
Entries count once their attempt is committed (the caller keeps the list), so what a failed run has appended is ignored.
A part of NULL says that the key is deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int, key_type: str = "bigint"):
        self.spark, self.path, self.buckets, self.key_type = spark, path, buckets, key_type

    @contextmanager
    def _registered(self):
        """The table under a name of its own in the session's catalog, for as long as it takes to plan a query or write."""
        name = f"key_index_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"CREATE TABLE {name} (key {self.key_type}, part int, attempt string) USING parquet "
                       f"CLUSTERED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE {name}")  # external: the files stay

    def append(self, keys: DataFrame, attempt: str) -> None:
        """Adds (key, part) rows under ``attempt``: one file per bucket."""
        with self._registered() as name:
            rows = keys.select(F.col("key").cast(self.key_type), F.col("part").cast("int"), F.lit(attempt).alias("attempt"))
            rows.repartition(self.buckets, "key").write.insertInto(name)

    def table(self, attempts: Sequence[str]) -> DataFrame:
        with self._registered() as name:
            return self.spark.table(name).where(F.col("attempt").isin(*attempts))

    def found(self, keys: DataFrame, attempts: Sequence[str]) -> DataFrame:
        """(key, part) of those ``keys`` (distinct, column ``key``) that the index holds; ``attempts`` in the order of their commits."""
        if not attempts:
            return keys.select("key", F.lit(None).cast("int").alias("part")).where("false")
        order = F.array_position(F.array(*[F.lit(a) for a in attempts]), F.col("attempt"))
        new = keys.select(F.col("key").cast(self.key_type).alias("key")).hint("shuffle_hash")
        hits = self.table(attempts).join(new, "key").select("key", "part", order.alias("at"))
        return hits.groupBy("key").agg(F.max_by("part", "at").alias("part")).where("part IS NOT NULL")
