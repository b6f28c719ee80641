"""Facts (M11, M12).

``fct_ocorrencias``: one row per staged incident, never dropped. Four equi lookups and two
as-of lookups against size-checked broadcast dimensions: the fact is built in a single
map-only stage without a shuffle. To be written as a table it is dealt to even files by year: once the versions are
known, before the other keys are attached, so that the shuffle carries no text keys.

``fct_desempenho_mensal``: month x district x type, additive measures only. The grain is
reduced first (broadcast joins to the three dimensions, then a partial + final
aggregation: one small shuffle), and the shrunken-dimension keys are attached to the
few aggregated rows afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.zorder import date_rank, hex_rank, z_value
from ..operators.joins import asof_join, fits_broadcast, lookup_join
from ..sources.tables import dealt
from . import constants as K

CALENDAR_ROWS = (K.CALENDAR_END - K.CALENDAR_START).days + 1
CALENDAR_MONTHS = ((K.CALENDAR_END.year - K.CALENDAR_START.year) * 12
                   + K.CALENDAR_END.month - K.CALENDAR_START.month + 1)


# Year of the incident's date key (0: unknown date), the column the written fact is partitioned by.
YEAR = "ano_fato"


def access_order() -> Column:
    """The order of the fact's rows inside a year, by date, geography and crime together."""
    return z_value([date_rank(F.col("sk_data")), hex_rank(F.col("sk_geografia")), hex_rank(F.col("sk_crime"))])


def lookups_fit(*dims: DataFrame) -> bool:
    """No lookup shuffles the fact: rows that were dealt to files stay where they are."""
    return all(fits_broadcast(d) for d in dims)


def _numbered(dim: DataFrame, sk: str) -> DataFrame:
    """A (broadcastable) dimension with a small number for each key, ``_n``, and the key's place in the access order."""
    return dim.withColumn("_n", F.dense_rank().over(Window.orderBy(sk))).withColumn("_rank", hex_rank(F.col(sk)))


def _dealt_with_versions(f: DataFrame, dim_crime: DataFrame, dim_geografia: DataFrame) -> DataFrame:
    """The staged rows with ``sk_crime`` and ``sk_geografia``, dealt to files by year and ``access_order``. The versions cross the
    shuffle as numbers; text keys follow afterwards."""
    crime, geo = _numbered(dim_crime, "sk_crime"), _numbered(dim_geografia, "sk_geografia")
    f = asof_join(f, crime, "iucr", "iucr", "data_hora_ocorrencia", {"_n": "_crime", "_rank": "_crime_rank"}, unknown={"_crime_rank": 0})
    f = asof_join(f, geo, "beat", "beat", "data_hora_ocorrencia", {"_n": "_geo", "_rank": "_geo_rank"}, unknown={"_geo_rank": 0})
    order = z_value([date_rank(F.col("sk_data")), F.col("_geo_rank"), F.col("_crime_rank")])
    f = dealt(f.withColumn(YEAR, _year()), YEAR, order).drop(YEAR, "_crime_rank", "_geo_rank")
    for dim, sk, n in ((crime, "sk_crime", "_crime"), (geo, "sk_geografia", "_geo")):
        f = lookup_join(f, dim.select("_n", sk).distinct(), [(n, "_n")], {sk: sk}, unknown={sk: K.UNKNOWN_KEY})
    return f


def _year() -> Column:
    return (F.col("sk_data") / 10000).cast("int")


def fct_ocorrencias(
    stg: DataFrame,
    dim_data: DataFrame,
    dim_hora: DataFrame,
    dim_local: DataFrame,
    dim_flags: DataFrame,
    dim_crime: DataFrame,
    dim_geografia: DataFrame,
    deal: bool = False,
) -> DataFrame:
    """``deal`` places the rows for a table by year and access order, if ``lookups_fit``; the rows are the same."""
    f = stg.select(
        "id_ocorrencia", "data_hora_ocorrencia", "latitude", "longitude", "case_number", "data_ocorrencia", "hora_ocorrencia",
        "location_description", "flag_prisao", "flag_domestico", "iucr", "beat",
    )
    f = lookup_join(f, dim_data, [("data_ocorrencia", "data_completa")], {"sk_data": "sk_data"},
                    unknown={"sk_data": K.UNKNOWN_INT}, known_rows=CALENDAR_ROWS)
    if deal:
        f = _dealt_with_versions(f, dim_crime, dim_geografia)
    f = lookup_join(f, dim_hora, [("hora_ocorrencia", "sk_hora")], {"sk_hora": "sk_hora"},
                    unknown={"sk_hora": K.UNKNOWN_INT}, known_rows=25)
    f = lookup_join(f, dim_local, [("location_description", "descricao_local")], {"sk_local": "sk_local"},
                    unknown={"sk_local": K.UNKNOWN_KEY})
    # the only key without a fallback to the unknown member, as in the original
    f = lookup_join(f, dim_flags, [("flag_prisao", "flag_prisao"), ("flag_domestico", "flag_domestico")],
                    {"sk_flags": "sk_flags"}, known_rows=4)
    if not deal:
        f = asof_join(f, dim_crime, "iucr", "iucr", "data_hora_ocorrencia", {"sk_crime": "sk_crime"},
                      unknown={"sk_crime": K.UNKNOWN_KEY})
        f = asof_join(f, dim_geografia, "beat", "beat", "data_hora_ocorrencia", {"sk_geografia": "sk_geografia"},
                      unknown={"sk_geografia": K.UNKNOWN_KEY})
    return f.select(
        F.col("id_ocorrencia").alias("sk_ocorrencia"),
        "id_ocorrencia", "case_number",
        "sk_data", "sk_hora", "sk_crime", "sk_geografia", "sk_local", "sk_flags",
        "latitude", "longitude", "data_hora_ocorrencia",
        F.lit(1).alias("qtd_ocorrencia"),
        F.when(F.col("flag_prisao"), 1).otherwise(0).alias("qtd_prisao"),
        F.when(F.col("flag_domestico"), 1).otherwise(0).alias("qtd_domestico"),
        _year().alias(YEAR),
    )


def fct_desempenho_mensal(
    fct: DataFrame,
    dim_data: DataFrame,
    dim_geografia: DataFrame,
    dim_crime: DataFrame,
    dim_mes: DataFrame,
    dim_distrito: DataFrame,
    dim_tipo_crime: DataFrame,
    include_closed: bool = False,
    regroup: bool = False,
) -> DataFrame:
    """As coded in the original, districts without a current version and unknown types
    collapse into the ``'-1'`` keys, which can repeat a (month, district, type) key (S8,
    S8b). ``include_closed=True`` keeps closed districts (one row per district, S6);
    ``regroup=True`` sums the rows again at the final keys so the grain is unique."""
    o = fct.select("sk_data", "sk_crime", "sk_geografia", "qtd_ocorrencia", "qtd_prisao", "qtd_domestico")
    o = lookup_join(o, dim_data, [("sk_data", "sk_data")], {"ano": "ano", "numero_mes": "numero_mes"},
                    known_rows=CALENDAR_ROWS, how="inner")
    o = lookup_join(o, dim_geografia, [("sk_geografia", "sk_geografia")], {"district": "district_natural"},
                    how="inner")
    o = lookup_join(o, dim_crime, [("sk_crime", "sk_crime")], {"primary_type_atual": "tipo_crime_natural"},
                    how="inner")
    o = o.where(F.col("sk_data") != K.UNKNOWN_INT)
    a = o.groupBy(
        (F.col("ano") * 100 + F.col("numero_mes")).alias("sk_mes_natural"), "district_natural", "tipo_crime_natural"
    ).agg(
        F.sum("qtd_ocorrencia").cast("int").alias("qtd_ocorrencias"),
        F.sum("qtd_prisao").cast("int").alias("qtd_prisoes"),
        F.sum("qtd_domestico").cast("int").alias("qtd_domesticos"),
        F.sum(F.col("qtd_ocorrencia") - F.col("qtd_prisao")).cast("int").alias("qtd_sem_prisao"),
    )
    a = lookup_join(a, dim_mes, [("sk_mes_natural", "sk_mes")], {"sk_mes": "sk_mes"},
                    unknown={"sk_mes": K.UNKNOWN_INT}, known_rows=CALENDAR_MONTHS)
    districts = dim_distrito if include_closed else dim_distrito.where(F.col("flag_versao_atual"))
    a = lookup_join(a, districts, [("district_natural", "district")],
                    {"sk_distrito": "sk_distrito"}, unknown={"sk_distrito": K.UNKNOWN_KEY})
    a = lookup_join(a, dim_tipo_crime, [("tipo_crime_natural", "primary_type")], {"sk_tipo_crime": "sk_tipo_crime"},
                    unknown={"sk_tipo_crime": K.UNKNOWN_KEY})
    measures = ["qtd_ocorrencias", "qtd_prisoes", "qtd_domesticos", "qtd_sem_prisao"]
    if regroup:
        a = a.groupBy("sk_mes", "sk_distrito", "sk_tipo_crime").agg(*[F.sum(m).cast("int").alias(m) for m in measures])
    return a.select("sk_mes", "sk_distrito", "sk_tipo_crime", *measures)
