"""Surrogate keys (H17): md5 over the fields joined by '-', NULLs replaced by a token.

Matches the widely used dbt_utils ``generate_surrogate_key`` macro, so keys agree with a
warehouse built by that macro: every field is cast to text (booleans print
``true``/``false``, timestamps ``yyyy-MM-dd HH:mm:ss`` without trailing zero fraction).
Pure built-in expressions: stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NULL placeholder and the field separator of the key text.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def surrogate_key_sql(*exprs: str) -> str:
    """The same key as SQL text (used by the DuckDB oracle and Spark SQL alike)."""
    parts = [f"coalesce(cast({e} as varchar), '{NULL_TOKEN}')" for e in exprs]
    return "md5(" + f" || '{SEPARATOR}' || ".join(parts) + ")"
