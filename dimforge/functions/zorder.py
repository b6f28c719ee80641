"""Z-order values: rows that are near in several columns get near numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 8  # of every column


def date_rank(date_key: Column) -> Column:
    """A YYYYMMDD key's place in its year in BITS bits, ascending with the key; others 0."""
    day = F.floor(date_key / 100) % 100 * 31 + date_key % 100 - 32
    return F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), F.floor(day * (1 << BITS) / 372))).cast("int")


def hex_rank(key: Column) -> Column:
    """The first BITS bits of a hexadecimal key, ascending with its text; keys that are none ('-1', NULL) 0."""
    high, low = (F.position(F.substring(key, i, 1), F.lit("0123456789abcdef")) - 1 for i in (1, 2))
    return F.when((F.length(key) >= 2) & (high >= 0) & (low >= 0), high * 16 + low).otherwise(0).cast("int")


def z_value(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The ranks' bits interleaved, highest first; the first rank's bit leads. Built-in bit operations only."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, r in enumerate(reversed(list(ranks))):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(r.cast("long"), b).bitwiseAND(F.lit(1).cast("long")), b * len(ranks) + i))
    return out
