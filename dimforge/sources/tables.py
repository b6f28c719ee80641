"""Table IO: persisting models as Parquet tables (A2, A5, A6, A8) and cutting lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.zorder import BITS
from ..session import scratch_path


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    sort_within: Sequence[str] | None = None,
    cluster_by: Sequence[str] | None = None,
) -> None:
    """Persist a model (A5; ``mode='overwrite'`` is the full reload of A2).

    ``cluster_by`` hash-clusters rows on the given columns first, and ``sort_within``
    orders rows inside each file so Parquet min/max statistics prune row groups for
    range filters on those columns (the access-path role of the reference's indexes, A8).
    Never overwrite a path that ``df`` itself reads from; write to a new path instead.
    """
    out = df
    if cluster_by:
        out = out.repartition(*cluster_by)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def assert_unique(df: DataFrame, cols: Sequence[str], name: str = "table") -> None:
    """Enforce a unique key on write, like a unique index - raise on duplicates.

    One partially aggregated shuffle of the key columns; rows with a NULL key part are
    ignored (an index allows several NULLs).
    """
    keyed = df
    for c in cols:
        keyed = keyed.where(F.col(c).isNotNull())
    dups = keyed.groupBy(*cols).count().where(F.col("count") > 1)
    n = dups.count()
    if n:
        raise ValueError(f"{name}: {n} duplicated value(s) of unique key ({', '.join(cols)})")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a model as a (session) view, like a non-materialised model."""
    df.createOrReplaceTempView(name)
    return df


def materialize(
    spark: SparkSession, df: DataFrame, name: str, sort_within: Sequence[str] | None = None, partition_by: str | None = None,
    cluster: Column | None = None, lookup: Sequence[str] = (), is_dealt: bool = False
) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint root and read it back.

    Cuts lineage (a lost executor re-reads the written files instead of recomputing the
    upstream plan) and gives later joins real file statistics. Reliable storage only:
    this never uses executor-local checkpoints. ``sort_within`` orders rows inside each
    file so Parquet row-group min/max statistics prune range filters on those columns.
    """
    path = scratch_path(spark, name)
    return write_observed(spark, df, path, "errorifexists", sort_within, partition_by, cluster, lookup, is_dealt)


def dealt(df: DataFrame, partition_by: str | None, cluster: Column, cells: int = 64) -> DataFrame:
    """Rows of a partition dealt to files by the upper part of ``cluster`` (a z-order value).

    The shuffle is by (partition, cell): AQE joins small cells and splits large ones, so files are of an even size and each
    covers few cells."""
    top = F.shiftright(cluster, 3 * BITS - (cells - 1).bit_length()).cast("int")
    keys = [partition_by] if partition_by else []
    return df.withColumn("__cell", top).hint("rebalance", *keys, "__cell").drop("__cell")


def sorted_by(df: DataFrame, partition_by: str | None, cluster: Column) -> DataFrame:
    """Rows sorted by ``cluster`` inside each file of a partition. Row-group statistics then prune by every column that
    the z-order value is made of (A8)."""
    keys = [partition_by] if partition_by else []
    return df.withColumn("__z", cluster).sortWithinPartitions(*keys, "__z").drop("__z")


def clustered(df: DataFrame, partition_by: str | None, cluster: Column, cells: int = 64) -> DataFrame:
    """``dealt`` to files and ``sorted_by`` the same z-order value inside each."""
    z = F.col("__zc")
    return sorted_by(dealt(df.withColumn("__zc", cluster), partition_by, z, cells), partition_by, z).drop("__zc")


# Models are written once and read a few times: a stronger codec and delta-encoded pages cost less than the bytes they save.
STORED = {"compression": "zstd", "parquet.writer.version": "v2"}


def lookup_options(columns: Sequence[str]) -> dict[str, str]:
    """Parquet options that give ``columns`` a Bloom filter in every row group, for lookups of single values."""
    out = {"parquet.bloom.filter.adaptive.enabled": "true"} if columns else {}
    return out | {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}


def write_observed(
    spark: SparkSession, df: DataFrame, path: str, mode: str = "errorifexists", sort_within: Sequence[str] | None = None,
    partition_by: str | None = None, cluster: Column | None = None, lookup: Sequence[str] = (), is_dealt: bool = False,
) -> DataFrame:
    """Write ``df`` as Parquet, in a folder per value of ``partition_by``, and read it back; the exact row count is observed as a metric
    of the write itself (no extra job) and remembered for later broadcast size checks. ``cluster`` orders rows inside a partition by
    a z-order value instead of ``sort_within``, without a shuffle if ``df`` ``is_dealt`` to files by it; ``lookup`` columns get Bloom filters."""
    from pyspark.sql import Observation

    from ..operators.joins import remember_row_count

    obs = Observation()
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer_keys = [*([partition_by] if partition_by else []), *(sort_within or [])]
    if cluster is not None:
        out = sorted_by(out, partition_by, cluster) if is_dealt else clustered(out, partition_by, cluster)
    elif partition_by:  # files of an even size: small values share a task, large ones are split
        out = out.hint("rebalance", partition_by)
    if writer_keys and cluster is None:
        out = out.sortWithinPartitions(*writer_keys)
    writer = out.write.mode(mode).options(**STORED, **lookup_options(lookup))
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    back = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    remember_row_count(back, obs.get["rows"])
    return back
