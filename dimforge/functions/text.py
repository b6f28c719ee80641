"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters/digits; everything else separates words.
WORD_OR_GAP = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def blank_to_null(c: Column) -> Column:
    """nullif(trim(x), '')."""
    t = F.trim(c)
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def clean_upper(c: Column) -> Column:
    """upper(trim(x)); NULL stays NULL, blank stays blank."""
    return F.upper(F.trim(c))


def digits_to_int(c: Column) -> Column:
    """Keep only digits, blank -> NULL, then integer: '004' -> 4, '12.0' -> 120, 'x' -> NULL.

    A digit string longer than an int raises under ANSI mode, like the reference's cast. Text of digits alone is cast as it is;
    the expression that takes other characters out runs on the rest.
    """
    d = F.regexp_replace(c, r"\D", "")
    kept = F.when(F.ltrim(c, F.lit("0123456789")) == "", c).otherwise(d)
    return F.when(kept == "", F.lit(None).cast("int")).otherwise(kept.cast("int"))


def initcap_words(c: Column) -> Column:
    """Capitalise every word, lower-case the rest; a word starts after any non-alphanumeric.

    Spark's own ``initcap`` only splits on spaces ('Non-criminal'); this splits on any
    non-letter/digit ('Non-Criminal (Subject Specified)'). Built-in higher-order functions
    only, so no Python runs per row.
    """
    tokens = F.regexp_extract_all(F.lower(c), F.lit(WORD_OR_GAP), 0)
    cap = F.transform(tokens, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cap, ""))


def zero_pad(c: Column, n: int) -> Column:
    """lpad(cast(x as text), n, '0'); truncates longer text like SQL lpad."""
    return F.lpad(c.cast("string"), n, "0")
