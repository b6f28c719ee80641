"""Dimension-building helpers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_unknown(dim: DataFrame, row: Sequence[object]) -> DataFrame:
    """Append the unknown ("substitute") member, values in column order.

    The literal row is built JVM-side (one-row range + casts to the dimension's types).
    """
    spark = dim.sparkSession
    lits = [
        F.lit(v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v).cast(f.dataType).alias(f.name)
        for v, f in zip(row, dim.schema.fields)
    ]
    return dim.unionByName(spark.range(1).select(*lits))


def first_match_in(c: Column, categories: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Searched CASE over IN lists, first match wins."""
    out = None
    for label, values in categories:
        cond = c.isin(*values)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def first_match_contains(c: Column, categories: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """CASE over OR-combined ``LIKE '%word%'`` tests, first match wins; order matters."""
    out = None
    for label, words in categories:
        cond = contains_any(c, words)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def contains_any(c: Column, words: Sequence[str]) -> Column:
    cond = None
    for w in words:
        t = c.contains(w)
        cond = t if cond is None else (cond | t)
    return cond


def in_ranges(c: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    cond = None
    for lo, hi in ranges:
        t = c.between(lo, hi)
        cond = t if cond is None else (cond | t)
    return cond


def shrink(dim: DataFrame, by: Sequence[Column | str], where: Column | None = None, aggregates: Sequence[Column] = ()) -> DataFrame:
    """A coarser dimension conformed with ``dim``: its distinct values of ``by`` among the rows ``where``, and what
    ``aggregates`` say of each. One partially aggregated shuffle."""
    rows = dim if where is None else dim.where(where)
    return rows.groupBy(*by).agg(*aggregates) if aggregates else rows.select(*by).distinct()
