"""Dimensions of the incident warehouse.

All dimensions are small (24 hours, ~9.5k days, hundreds of codes/beats/locations), so
they are built with ordinary aggregates and later broadcast into the fact after a size
check. Generated dimensions (calendar, hours, flags) come from ``spark.range`` so even
their generation is distributed and codegen'd.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.text import initcap_words, zero_pad
from ..functions.time import date_key, iso_weekday
from ..operators.dimensional import (
    contains_any,
    first_match_contains,
    first_match_in,
    in_ranges,
    shrink,
    with_unknown,
)
from ..operators.joins import lookup_join
from ..operators.latest import latest_per_key
from ..operators.scd2 import scd2_validity, with_current
from . import constants as K

LATEST_ORDER = ["data_hora_ocorrencia", "id_ocorrencia"]


def date_spine(spark: SparkSession, start=K.CALENDAR_START, end=K.CALENDAR_END) -> DataFrame:
    """One row per day in [start, end] (``generate_series``), split across tasks."""
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("data"))


def dim_data(spark: SparkSession, unknown_member: bool = False) -> DataFrame:
    """M2: calendar day dimension, smart key YYYYMMDD, Portuguese labels.

    As coded in the original there is no unknown row (S1), so facts with ``sk_data = -1``
    fail the relationship test; ``unknown_member=True`` adds the documented -1 row.
    """
    d = F.col("data")
    dow = iso_weekday(d)
    months = F.array(*[F.lit(m) for m in K.MONTH_NAMES])
    weekdays = F.array(*[F.lit(w) for w in K.WEEKDAY_NAMES])
    cal = date_spine(spark).select(
        date_key(d).alias("sk_data"),
        d.alias("data_completa"),
        F.year(d).alias("ano"),
        F.quarter(d).alias("trimestre"),
        F.month(d).alias("numero_mes"),
        F.dayofmonth(d).alias("dia_do_mes"),
        F.dayofyear(d).alias("dia_do_ano"),
        F.weekofyear(d).alias("semana_do_ano"),
        dow.alias("numero_dia_semana"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        F.concat(F.lit(K.QUARTER_PREFIX), F.quarter(d).cast("string")).alias("nome_trimestre"),
        F.element_at(months, F.month(d)).alias("nome_mes"),
        F.element_at(weekdays, dow).alias("nome_dia_semana"),
        dow.isin(*K.WEEKEND_ISO_DAYS).alias("flag_fim_de_semana"),
        (F.year(d) == K.PARTIAL_YEAR).alias("flag_ano_parcial"),
    )
    if unknown_member:
        return with_unknown(cal, [K.UNKNOWN_INT, None, K.UNKNOWN_INT, K.UNKNOWN_INT, K.UNKNOWN_INT, K.UNKNOWN_INT,
                                  K.UNKNOWN_INT, K.UNKNOWN_INT, K.UNKNOWN_INT, K.NOT_AVAILABLE, K.NOT_AVAILABLE,
                                  K.NOT_INFORMED, K.NOT_INFORMED, False, False])
    return cal


def dim_hora(spark: SparkSession) -> DataFrame:
    """M3: hour-of-day dimension, 24 rows + unknown."""
    h = F.col("id").cast("int")
    period = F.when(h.between(*K.DAY_PERIODS[0][:2]), K.DAY_PERIODS[0][2])
    for lo, hi, label in K.DAY_PERIODS[1:]:
        period = period.when(h.between(lo, hi), label)
    period = period.otherwise(K.DAY_PERIOD_ELSE)
    band = None
    for ranges, label in K.OPERATIONAL_BANDS:
        cond = in_ranges(h, ranges)
        band = F.when(cond, label) if band is None else band.when(cond, label)
    band = band.otherwise(K.OPERATIONAL_ELSE)
    hours = spark.range(24).select(
        h.alias("sk_hora"),
        h.alias("hora_do_dia"),
        F.concat(zero_pad(h, 2), F.lit(":00")).alias("hora_formatada"),
        period.alias("periodo_do_dia"),
        band.alias("faixa_operacional"),
        in_ranges(h, K.NIGHT_HOURS).alias("flag_noturno"),
    )
    return with_unknown(hours, [K.UNKNOWN_INT, K.UNKNOWN_INT, K.NOT_INFORMED, K.NOT_INFORMED, K.NOT_INFORMED, False])


def dim_local(stg: DataFrame) -> DataFrame:
    """M6: distinct location texts with ordered substring categories + unknown."""
    loc = F.col("location_description")
    locs = stg.where(loc.isNotNull()).select("location_description").distinct()
    d = locs.select(
        surrogate_key(loc).alias("sk_local"),
        loc.alias("descricao_local"),
        first_match_contains(loc, K.LOCATION_CATEGORIES, K.LOCATION_CATEGORY_ELSE).alias("categoria_local"),
        contains_any(loc, K.PUBLIC_PLACE_WORDS).alias("flag_local_publico"),
    )
    return with_unknown(d, [K.UNKNOWN_KEY, K.NOT_INFORMED, K.NOT_INFORMED, False])


def dim_flags(spark: SparkSession) -> DataFrame:
    """M7: junk dimension, all 2 x 2 combinations of the arrest / domestic flags."""
    p = F.col("id") < 2
    d = F.col("id") % 2 == 0
    combined = None
    for pv, dv, label in K.COMBINED_FLAG_LABELS:
        cond = (p == F.lit(pv)) & (d == F.lit(dv))
        combined = F.when(cond, label) if combined is None else combined.when(cond, label)
    return spark.range(4).select(
        surrogate_key(p, d).alias("sk_flags"),
        p.alias("flag_prisao"),
        d.alias("flag_domestico"),
        F.when(p, K.ARREST_LABELS[0]).otherwise(K.ARREST_LABELS[1]).alias("descricao_prisao"),
        F.when(d, K.DOMESTIC_LABELS[0]).otherwise(K.DOMESTIC_LABELS[1]).alias("descricao_domestico"),
        combined.alias("descricao_combinada"),
    )


def dim_crime(snap_crime: DataFrame, backdate_per_key: bool = False) -> DataFrame:
    """M4: IUCR x version (SCD2) with historical and current wording and a category
    derived from the *historical* primary type."""
    h = scd2_validity(snap_crime, K.BEGINNING_OF_TIME, K.END_OF_TIME, per_key=backdate_per_key, key="iucr")
    h = with_current(h, "iucr", {"primary_type": "primary_type_atual", "description": "description_atual"})
    d = h.select(
        surrogate_key("iucr", "dbt_valid_from").alias("sk_crime"),
        "iucr", "primary_type", "description", "fbi_code", "primary_type_atual", "description_atual",
        first_match_in(F.col("primary_type"), K.CRIME_CATEGORIES, K.CRIME_CATEGORY_ELSE).alias("categoria_analitica"),
        "valido_de", "valido_ate", "flag_versao_atual",
    )
    return with_unknown(
        d,
        [K.UNKNOWN_KEY, K.NOT_AVAILABLE, K.NOT_INFORMED, K.NOT_INFORMED, K.NOT_AVAILABLE,
         K.NOT_INFORMED, K.NOT_INFORMED, K.NOT_INFORMED, K.BEGINNING_OF_TIME, K.END_OF_TIME, True],
    )


def beat_attributes(stg: DataFrame) -> DataFrame:
    """Ward / community area of the latest incident per beat having both."""
    return latest_per_key(
        stg, "beat", ["ward", "community_area"], LATEST_ORDER,
        where="ward IS NOT NULL AND community_area IS NOT NULL",
    )


def dim_geografia(snap_geografia: DataFrame, stg: DataFrame, backdate_per_key: bool = False) -> DataFrame:
    """M5: beat x version (SCD2): historical and current district, informative ward and
    community area, reorganised flag."""
    h = scd2_validity(snap_geografia, K.BEGINNING_OF_TIME, K.END_OF_TIME, per_key=backdate_per_key, key="beat")
    h = with_current(h, "beat", {"district": "district_atual"})
    h = lookup_join(h, beat_attributes(stg), [("beat", "beat")], {"ward": "ward", "community_area": "community_area"})
    b, dist, ward = F.col("beat"), F.col("district"), F.col("ward")
    d = h.select(
        surrogate_key("beat", "dbt_valid_from").alias("sk_geografia"),
        b.alias("beat"),
        zero_pad(b, 4).alias("beat_formatado"),
        dist.alias("district"),
        zero_pad(dist, 3).alias("district_formatado"),
        F.concat(F.lit(K.DISTRICT_PREFIX), dist.cast("string")).alias("nome_district"),
        F.col("district_atual"),
        ward.alias("ward"),
        F.concat(F.lit(K.WARD_PREFIX), ward.cast("string")).alias("nome_ward"),
        F.col("community_area"),
        (dist != F.col("district_atual")).alias("flag_distrito_reorganizado"),
        "valido_de", "valido_ate", "flag_versao_atual",
    )
    return with_unknown(
        d,
        [K.UNKNOWN_KEY, K.UNKNOWN_INT, K.NOT_AVAILABLE, K.UNKNOWN_INT, K.NOT_AVAILABLE, K.NOT_INFORMED,
         K.UNKNOWN_INT, K.UNKNOWN_INT, K.NOT_INFORMED, K.UNKNOWN_INT, False,
         K.BEGINNING_OF_TIME, K.END_OF_TIME, True],
    )


def dim_mes(dim_data_df: DataFrame) -> DataFrame:
    """M8: month, shrunken conformed dimension of the calendar (same attribute values)."""
    m = shrink(dim_data_df, ["ano", "numero_mes", "trimestre", "nome_mes", "ano_mes", "nome_trimestre", "flag_ano_parcial"],
               F.col("sk_data") != K.UNKNOWN_INT)
    return m.select(
        (F.col("ano") * 100 + F.col("numero_mes")).cast("int").alias("sk_mes"),
        "ano_mes", "ano", "trimestre", "numero_mes", "nome_mes", "nome_trimestre",
        F.concat(F.col("nome_mes"), F.lit("/"), F.col("ano").cast("string")).alias("descricao_mes"),
        F.make_date(F.col("ano"), F.col("numero_mes"), F.lit(1)).alias("primeiro_dia_mes"),
        "flag_ano_parcial",
    )


def dim_distrito(dim_geo: DataFrame) -> DataFrame:
    """M9: district, shrunken from the beat dimension: earliest start, latest end, current
    if any beat version is current (one row per district, S6) + unknown."""
    c = shrink(dim_geo, ["district"], (F.col("sk_geografia") != K.UNKNOWN_KEY) & F.col("district").isNotNull(), [
        F.min("valido_de").alias("valido_de"),
        F.max("valido_ate").alias("valido_ate"),
        F.bool_or("flag_versao_atual").alias("flag_versao_atual"),
    ])
    dist = F.col("district")
    d = c.select(
        surrogate_key("district", "valido_de").alias("sk_distrito"),
        dist.alias("district"),
        zero_pad(dist, 3).alias("district_formatado"),
        F.concat(F.lit(K.DISTRICT_PREFIX), dist.cast("string")).alias("nome_district"),
        dist.isin(*K.DEACTIVATED_DISTRICTS).alias("flag_distrito_desativado"),
        "valido_de", "valido_ate", "flag_versao_atual",
    )
    return with_unknown(
        d, [K.UNKNOWN_KEY, K.UNKNOWN_INT, K.NOT_AVAILABLE, K.NOT_INFORMED, False,
            K.BEGINNING_OF_TIME, K.END_OF_TIME, True],
    )


def dim_tipo_crime(dim_crime_df: DataFrame) -> DataFrame:
    """Primary type (current wording), shrunken from the code dimension + unknown.

    DISTINCT over (current type, category) with the key from the type only, as in the
    original: a type whose codes span categories yields duplicate keys (S7), which the
    uniqueness data test reports.
    """
    current = F.col("primary_type_atual")
    t = shrink(dim_crime_df, [current.alias("primary_type"), "categoria_analitica"],
               (F.col("sk_crime") != K.UNKNOWN_KEY) & current.isNotNull() & (current != K.NOT_INFORMED))
    d = t.select(
        surrogate_key("primary_type").alias("sk_tipo_crime"),
        "primary_type",
        initcap_words(F.col("primary_type")).alias("nome_tipo_crime"),
        "categoria_analitica",
        (F.col("categoria_analitica") == K.VIOLENT_CATEGORY).alias("flag_crime_violento"),
    )
    return with_unknown(d, [K.UNKNOWN_KEY, K.NOT_AVAILABLE, K.NOT_INFORMED, K.NOT_INFORMED, False])
