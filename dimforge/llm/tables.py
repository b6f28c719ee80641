"""Intermediate tables in the shared folder that spark.checkpoint.dir names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from dimforge.session import scratch_path


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet and read back, with its own columns: cuts lineage, and lost executors reread files."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As ``materialized``, in ``buckets`` hash buckets of ``key``: joins of such tables on that column shuffle neither.

    Rows go to the buckets from where they are; ``df`` should hold each key in one task, or be dealt by it. The
    catalog knows the table for as long as it takes to read its layout.
    """
    spark, table = df.sparkSession, f"llm_{name}_{uuid.uuid4().hex[:12]}".replace("-", "_")
    df.write.format("parquet").option("path", scratch_path(spark, f"llm-{name}")).bucketBy(buckets, key).saveAsTable(table)
    back = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    return back
