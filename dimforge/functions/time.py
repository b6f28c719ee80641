"""Date/time expressions (H3, H4, H6-H9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The source's US 12-hour wall-clock format ('MM/DD/YYYY HH12:MI:SS AM').
# Single-letter fields accept padded and unpadded numbers, as SQL to_timestamp does.
US_TIMESTAMP_FORMAT = "M/d/yyyy h:mm:ss a"
US_TIMESTAMP_PATTERN = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{2}):(\d{2}) ([AaPp][Mm])$"


def parse_us_timestamp(c: Column, lenient: bool = False) -> Column:
    """'MM/DD/YYYY HH12:MI:SS AM' text -> TIMESTAMP_NTZ (wall clock, no zone shifts).

    Strict by default: malformed text raises (ANSI), as the reference does. ``lenient``
    turns malformed text into NULL instead.
    """
    if lenient:
        part = lambda i: F.regexp_extract(c, US_TIMESTAMP_PATTERN, i).try_cast("int")
        hour = part(4) % 12 + F.when(F.upper(F.regexp_extract(c, US_TIMESTAMP_PATTERN, 7)) == "PM", 12).otherwise(0)
        made = F.try_make_timestamp_ntz(part(3), part(1), part(2), hour, part(5), part(6))  # no zone at any step
        return F.when(part(4).between(1, 12) & (part(6) < 60), made)
    return F.to_timestamp_ntz(c, F.lit(US_TIMESTAMP_FORMAT))


def date_key(d: Column) -> Column:
    """Smart integer key YYYYMMDD."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_weekday(d: Column) -> Column:
    """Monday=1 .. Sunday=7."""
    return ((F.dayofweek(d) + 5) % 7 + 1).cast("int")
