"""M1: typed, cleaned staging of the raw incident text table.

One narrow projection + filter: a single map-only stage, no shuffle, fully codegen'd.
Rows with NULL dimension attributes are kept (they map to unknown members later); only
rows without id or date text are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, clean_upper, digits_to_int
from ..functions.time import parse_us_timestamp
from ..sources.landing import CORRUPT

STAGING_COLUMNS = [
    "id_ocorrencia", "case_number", "data_hora_ocorrencia", "data_ocorrencia", "hora_ocorrencia",
    "data_atualizacao_fonte", "iucr", "primary_type", "description", "fbi_code", "beat", "district",
    "ward", "community_area", "location_description", "block", "latitude", "longitude",
    "flag_prisao", "flag_domestico",
]


def _flag(c):
    return F.upper(F.trim(c)) == F.lit("TRUE")


def stage_crimes(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Cast and clean ``crimes_raw`` (22 text columns) into ``stg_crimes``.

    ``lenient=False`` (default) raises on malformed timestamps/ids like the reference;
    ``lenient=True`` turns them into NULL instead.
    """
    ts = parse_us_timestamp(F.col("date"), lenient)
    cast_long = (lambda c: c.try_cast("bigint")) if lenient else (lambda c: c.cast("bigint"))
    cast_dec = (lambda c: c.try_cast("decimal(12,8)")) if lenient else (lambda c: c.cast("decimal(12,8)"))
    return raw.where(F.col("id").isNotNull() & F.col("date").isNotNull()).select(
        cast_long(F.col("id")).alias("id_ocorrencia"),
        blank_to_null(F.col("case_number")).alias("case_number"),
        ts.alias("data_hora_ocorrencia"),
        F.to_date(ts).alias("data_ocorrencia"),
        F.hour(ts).cast("int").alias("hora_ocorrencia"),
        parse_us_timestamp(F.col("updated_on"), lenient).alias("data_atualizacao_fonte"),
        clean_upper(F.col("iucr")).alias("iucr"),
        clean_upper(F.col("primary_type")).alias("primary_type"),
        clean_upper(F.col("description")).alias("description"),
        clean_upper(F.col("fbi_code")).alias("fbi_code"),
        digits_to_int(F.col("beat")).alias("beat"),
        digits_to_int(F.col("district")).alias("district"),
        digits_to_int(F.col("ward")).alias("ward"),
        digits_to_int(F.col("community_area")).alias("community_area"),
        blank_to_null(F.upper(F.col("location_description"))).alias("location_description"),
        blank_to_null(F.col("block")).alias("block"),
        cast_dec(blank_to_null(F.col("latitude"))).alias("latitude"),
        cast_dec(blank_to_null(F.col("longitude"))).alias("longitude"),
        _flag(F.col("arrest")).alias("flag_prisao"),
        _flag(F.col("domestic")).alias("flag_domestico"),
    )


def lenient_losses(raw: DataFrame) -> DataFrame:
    """One row: how many values of the staged rows ``lenient`` staging turns into NULL, by column."""
    kept = raw.where(F.col("id").isNotNull() & F.col("date").isNotNull())
    stamp = lambda c: F.col(c).isNotNull() & parse_us_timestamp(F.col(c), lenient=True).isNull()
    number = lambda c, kind: blank_to_null(F.col(c)).isNotNull() & blank_to_null(F.col(c)).try_cast(kind).isNull()
    lost = {"date": stamp("date"), "updated_on": stamp("updated_on"), "id": F.col("id").try_cast("bigint").isNull(),
            "latitude": number("latitude", "decimal(12,8)"), "longitude": number("longitude", "decimal(12,8)")}
    return kept.agg(*[F.count_if(c).alias(k) for k, c in lost.items()])


def quarantine_reason(raw: DataFrame) -> Column:
    """Why a landed line cannot be staged (A1); NULL if it can."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    return (F.when(corrupt, "not in the landing layout")
            .when(F.col("id").isNull(), "no id").when(F.col("date").isNull(), "no date")
            .when(F.col("id").try_cast("bigint").isNull(), "id is no number")
            .when(parse_us_timestamp(F.col("date"), lenient=True).isNull(), "date is no timestamp"))


def staged_and_quarantined(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lenient staging of the lines that have an id and a date, and (reason, line) of all others: each line is in one of them.

    ``line`` is the raw text of a line outside the layout, else the landed fields as JSON. Map-only, like staging; values other
    than id and date that cannot be read become NULL in staging and are counted by ``lenient_losses``."""
    reason = quarantine_reason(raw)
    fields = F.to_json(F.struct(*[c for c in raw.columns if c != CORRUPT]))
    line = F.coalesce(F.col(CORRUPT), fields) if CORRUPT in raw.columns else fields
    return stage_crimes(raw.where(reason.isNull()), lenient=True), raw.where(reason.isNotNull()).select(reason.alias("reason"), line.alias("line"))
