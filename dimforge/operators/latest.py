"""Latest row per key (``DISTINCT ON (key) ORDER BY key, ts DESC``).

Expressed as an aggregate, not a window: ``max_by(payload, (ts, tie))`` is computed
partially on the map side, so only one candidate per key and task is shuffled and a key
holding a third of all rows collapses before the exchange (a ``row_number`` window would
ship every row of the hot key to a single task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    attrs: Sequence[str],
    order_by: Sequence[str],
    where: str | None = None,
) -> DataFrame:
    """Latest ``attrs`` per ``key`` by descending ``order_by`` (last column breaks ties).

    Rows whose key is NULL are dropped. A NULL ordering value ranks lowest.
    """
    keys = [key] if isinstance(key, str) else list(key)
    src = df
    if where:
        src = src.where(where)
    src = src.where(F.expr(" AND ".join(f"{k} IS NOT NULL" for k in keys)))
    payload = F.struct(*[F.col(a) for a in attrs])
    ordering = F.struct(*[F.col(c) for c in order_by])
    return src.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_latest")).select(*keys, "_latest.*")
