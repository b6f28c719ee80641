"""Partitioned tables whose partitions are replaced one by one, each version in a folder of its own.

A manifest, ``{part: folder}``, names the current folder of every part. A run writes the parts that it changes to new
folders and commits a new manifest with them (``commits.CommitLog``), so readers see all of a run or nothing of it, no
file that is being read is overwritten, and a part that did not change is not touched.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import clustered, lookup_options

PART = "part"


def write_parts(df: DataFrame, root: str, attempt: str, parts: Iterable[int], sort_within: Sequence[str] = (), cluster: Column | None = None, lookup: Sequence[str] = ()) -> dict[str, str]:
    """Writes ``df`` (with its int column ``part``) below ``<root>/<attempt>``, a folder per part; returns the manifest entries.

    ``parts`` are all parts that ``df`` may hold rows of; one without rows has no folder any more. Files are of an even
    size within a part and sorted by ``sort_within``, or clustered as ``tables.clustered`` does; ``lookup`` columns get Bloom filters.
    """
    path = f"{root.rstrip('/')}/{attempt}"
    out = df.hint("rebalance", PART).sortWithinPartitions(PART, *sort_within) if cluster is None else clustered(df, PART, cluster)
    out.write.options(**lookup_options(lookup)).partitionBy(PART).parquet(path)
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    written = {int(n.split("=")[1]) for n in names if n.startswith(f"{PART}=")}
    if not written <= set(parts):
        raise ValueError(f"rows of parts {sorted(written - set(parts))} beside those to be replaced")
    return {str(p): f"{attempt}/{PART}={p}" for p in written}


def replaced(manifest: dict[str, str], parts: Iterable[int], new: dict[str, str]) -> dict[str, str]:
    """The manifest after ``parts`` have been replaced by what ``new`` holds of them."""
    gone = {str(p) for p in parts}
    return {p: f for p, f in manifest.items() if p not in gone} | new


def read_parts(spark: SparkSession, root: str, manifest: dict[str, str], schema: str, parts: Iterable[int] | None = None) -> DataFrame:
    """The current rows of the table, or of some parts of it. ``schema`` (DDL, without ``part``) holds where no part has rows."""
    chosen = sorted(int(p) for p in manifest) if parts is None else sorted(set(map(int, manifest)) & set(parts))
    frames = []
    by_attempt: dict[str, list[str]] = {}
    for p in chosen:
        by_attempt.setdefault(manifest[str(p)].split("/")[0], []).append(f"{root.rstrip('/')}/{manifest[str(p)]}")
    full = f"{schema}, {PART} int"
    for attempt, paths in by_attempt.items():  # the folder of one attempt is a partitioned table
        frames.append(spark.read.schema(full).option("basePath", f"{root.rstrip('/')}/{attempt}").parquet(*paths))
    if not frames:
        return spark.createDataFrame([], full)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select(*[c.strip().split()[0] for c in _split_ddl(schema)], F.col(PART))


def _split_ddl(schema: str) -> list[str]:
    """The columns of a flat DDL schema; commas inside parentheses belong to a type."""
    out, depth, cur = [], 0, ""
    for c in schema:
        depth += (c in "(<") - (c in ")>")
        if c == "," and not depth:
            out.append(cur)
            cur = ""
        else:
            cur += c
    return [*out, cur]
