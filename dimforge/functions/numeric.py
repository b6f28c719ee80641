"""Exact ratio measures.

Rates are never stored or averaged: they are derived from additive sums at query time,
in decimal arithmetic (never double), rounded half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_TYPE = "decimal(27,2)"


def ratio_pct(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num / nullif(den, 0) * 100, scale) in exact decimal; NULL when den = 0."""
    n = num.cast("decimal(20,0)")
    d = den.cast("decimal(20,0)")
    q = n / F.when(d == 0, F.lit(None).cast("decimal(20,0)")).otherwise(d) * F.lit(100)
    return F.round(q, scale).cast(f"decimal(27,{scale})")
