"""Report and semantic-model questions (O1-O18) over the star schema.

Pattern: filter each (small) dimension first, broadcast it after the size check, inner-
join it into the fact (the filter prunes fact rows inside the scan stage - the
"cross-filter" of O12), then aggregate with partial aggregation. Rates are recomputed
from additive sums at every level, never averaged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio_pct
from ..operators.joins import broadcast_if_small, lookup_join
from . import constants as K
from .facts import CALENDAR_MONTHS, CALENDAR_ROWS, YEAR, fct_desempenho_mensal
from .warehouse import Warehouse

# Defaults that select data in the fixture years (2007-2013); the original's report
# defaults are 2020-2025, district 1, THEFT.
P1_DEFAULTS = dict(year_from=2009, year_to=2013, district=12)
P2_DEFAULTS = dict(year_from=2009, year_to=2013, crime_type="THEFT")
THROUGH_CELL = dict(ano=2012, numero_mes=6, district=12, categoria_analitica="Crime violento")


def _join(fact: DataFrame, dim: DataFrame, key: str, take: list[str] | dict[str, str], how="inner", **kw):
    take_map = take if isinstance(take, dict) else {c: c for c in take}
    return lookup_join(fact, dim, [(key, key)], take_map, how=how, **kw)


def _level(*cols: str) -> Column:
    return F.grouping_id(*cols).cast("int").alias("nivel")


def rollup_sums(df: DataFrame, keys: list[str], sums: dict[str, str], sets: list[list[str]] | None = None) -> DataFrame:
    """Subtotals of additive measures: ROLLUP over ``keys`` (or the grouping ``sets``).

    The input is first aggregated to the finest grain (partial aggregation, one small
    shuffle); the rollup then expands only those few rows instead of every fact row.
    Sums of sums equal sums, and a subtotal row exists exactly when a fine group does.
    Adds ``nivel`` = grouping id.
    """
    fine = df.groupBy(*keys).agg(*[F.sum(src).alias(out) for out, src in sums.items()])
    grouped = fine.rollup(*keys) if sets is None else fine.groupingSets([[F.col(c) for c in g] for g in sets], *keys)
    return grouped.agg(*[F.sum(out).alias(out) for out in sums], _level(*keys))


def ratio_measure(df: DataFrame, keys: list[str], num: str, den: str, out: str = "taxa_prisao_pct") -> DataFrame:
    """Non-additive rate = SUM(num) / SUM(den) * 100 at the requested grain."""
    return df.groupBy(*keys).agg(
        F.sum(num).alias(num), F.sum(den).alias(den)
    ).select(*keys, num, den, ratio_pct(F.col(num), F.col(den)).alias(out))


# --- paginated report datasets ------------------------------------------------------

def date_key_range(year_from: int, year_to: int) -> Column:
    """The smart YYYYMMDD key makes a year range a key range: pushed into the fact scan,
    it prunes whole years (the fact's partitions) and row groups (its files are sorted by ``sk_data``). Same rows as the
    calendar join alone; the unknown key -1 is outside every range."""
    return F.col(YEAR).between(year_from, year_to) & F.col("sk_data").between(year_from * 10000 + 101, year_to * 10000 + 1231)


def _p1_base(w: Warehouse, year_from: int, year_to: int, district: int) -> DataFrame:
    f = w.fct_ocorrencias.where(date_key_range(year_from, year_to)).select(
        "sk_data", "sk_geografia", "sk_crime", "qtd_ocorrencia", "qtd_prisao")
    d = w.dim_data.where(F.col("ano").between(year_from, year_to))
    g = w.dim_geografia.where(F.col("district") == district)
    f = _join(f, d, "sk_data", ["ano", "numero_mes", "nome_mes"], known_rows=CALENDAR_ROWS)
    f = _join(f, g, "sk_geografia", ["nome_district"])
    return _join(f, w.dim_crime, "sk_crime", {"categoria_analitica": "categoria_analitica",
                                                 "primary_type_atual": "tipo_crime"})


def report_p1(w: Warehouse, year_from=2009, year_to=2013, district=12) -> DataFrame:
    """O1: month x district x category x type, incidents, arrests, arrest rate."""
    keys = ["ano", "numero_mes", "nome_mes", "nome_district", "categoria_analitica", "tipo_crime"]
    return (
        _p1_base(w, year_from, year_to, district)
        .groupBy(*keys)
        .agg(F.sum("qtd_ocorrencia").alias("ocorrencias"), F.sum("qtd_prisao").alias("prisoes"))
        .select(*keys, "ocorrencias", "prisoes", ratio_pct(F.col("prisoes"), F.col("ocorrencias")).alias("taxa_prisao_pct"))
        .orderBy("ano", "numero_mes", F.col("ocorrencias").desc())
    )


def report_p1_rollup(w: Warehouse, year_from=2009, year_to=2013, district=12) -> DataFrame:
    """Year -> district -> category with subtotals and grand total; the rate is
    re-derived from the sums at each level."""
    keys = ["ano", "nome_district", "categoria_analitica"]
    return (
        rollup_sums(_p1_base(w, year_from, year_to, district), keys,
                    {"ocorrencias": "qtd_ocorrencia", "prisoes": "qtd_prisao"})
        .select(*keys, "nivel", "ocorrencias", "prisoes",
                ratio_pct(F.col("prisoes"), F.col("ocorrencias")).alias("taxa_prisao_pct"))
    )


def _p2_base(w: Warehouse, year_from: int, year_to: int, crime_type: str) -> DataFrame:
    f = w.fct_desempenho_mensal.where(F.col("sk_mes").between(year_from * 100 + 1, year_to * 100 + 12))
    m = w.dim_mes.where(F.col("ano").between(year_from, year_to))
    tc = w.dim_tipo_crime.where(F.col("primary_type") == crime_type)
    f = _join(f, m, "sk_mes", ["ano", "numero_mes", "nome_mes"])
    f = _join(f, w.dim_distrito, "sk_distrito", ["nome_district"])
    return _join(f, tc, "sk_tipo_crime", ["nome_tipo_crime", "categoria_analitica"])


def report_p2(w: Warehouse, year_from=2009, year_to=2013, crime_type="THEFT") -> DataFrame:
    """O2: month x district x type from the monthly fact: three additive sums."""
    keys = ["ano", "numero_mes", "nome_mes", "nome_district", "nome_tipo_crime", "categoria_analitica"]
    return (
        _p2_base(w, year_from, year_to, crime_type)
        .groupBy(*keys)
        .agg(F.sum("qtd_ocorrencias").alias("ocorrencias"), F.sum("qtd_prisoes").alias("prisoes"),
             F.sum("qtd_domesticos").alias("domesticos"))
        .orderBy("ano", "numero_mes", F.col("ocorrencias").desc())
    )


def report_p2_rollup(w: Warehouse, year_from=2009, year_to=2013, crime_type="THEFT") -> DataFrame:
    """Year -> district with subtotals and grand total."""
    keys = ["ano", "nome_district"]
    return (
        rollup_sums(_p2_base(w, year_from, year_to, crime_type), keys,
                    {"ocorrencias": "qtd_ocorrencias", "prisoes": "qtd_prisoes", "domesticos": "qtd_domesticos"})
        .select(*keys, "nivel", "ocorrencias", "prisoes", "domesticos")
    )


def pick_district(w: Warehouse) -> DataFrame:
    """O3: district picker - current districts (the unknown member included, S14)."""
    return w.dim_distrito.where(F.col("flag_versao_atual")).select("district", "nome_district").orderBy("district")


def pick_type(w: Warehouse) -> DataFrame:
    """Crime-type picker - all but the unknown member, by label."""
    return (w.dim_tipo_crime.where(F.col("sk_tipo_crime") != K.UNKNOWN_KEY)
            .select("primary_type", "nome_tipo_crime").orderBy("nome_tipo_crime"))


# --- semantic-model questions ---------------------------------------------------------

def arrest_rate_by_year_district(w: Warehouse) -> DataFrame:
    """O7 applied: arrest rate per year and district from the monthly fact's sums."""
    f = _join(w.fct_desempenho_mensal, w.dim_mes, "sk_mes", ["ano"])
    f = _join(f, w.dim_distrito, "sk_distrito", ["nome_district"])
    return ratio_measure(f, ["ano", "nome_district"], "qtd_prisoes", "qtd_ocorrencias")


def drill_across(w: Warehouse) -> DataFrame:
    """Both facts at the shared grain (month, district), full outer join on the
    conformed keys. Each side is aggregated before the join (two small shuffles)."""
    f = w.fct_ocorrencias.select("sk_data", "sk_geografia", "qtd_ocorrencia", "qtd_prisao")
    f = _join(f, w.dim_data, "sk_data", ["ano", "numero_mes"], known_rows=CALENDAR_ROWS)
    f = _join(f, w.dim_geografia, "sk_geografia", ["district"])
    p1 = f.groupBy((F.col("ano") * 100 + F.col("numero_mes")).cast("int").alias("sk_mes"), "district").agg(
        F.sum("qtd_ocorrencia").alias("ocorrencias_p1"), F.sum("qtd_prisao").alias("prisoes_p1"))
    g = _join(w.fct_desempenho_mensal, w.dim_distrito, "sk_distrito", ["district"])
    p2 = g.groupBy("sk_mes", "district").agg(
        F.sum("qtd_ocorrencias").alias("ocorrencias_p2"), F.sum("qtd_prisoes").alias("prisoes_p2"))
    return p1.join(p2, ["sk_mes", "district"], "full_outer").select(
        "sk_mes", "district",
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
          for c in ("ocorrencias_p1", "prisoes_p1", "ocorrencias_p2", "prisoes_p2")],
    )


def _fact_with(w: Warehouse, date_cols=None, geo_cols=None, crime_cols=None, date_where=None,
               fact_where=None) -> DataFrame:
    f = w.fct_ocorrencias if fact_where is None else w.fct_ocorrencias.where(fact_where)
    if date_cols is not None:
        d = w.dim_data if date_where is None else w.dim_data.where(date_where)
        f = _join(f, d, "sk_data", date_cols, known_rows=CALENDAR_ROWS)
    if geo_cols is not None:
        f = _join(f, w.dim_geografia, "sk_geografia", geo_cols)
    if crime_cols is not None:
        f = _join(f, w.dim_crime, "sk_crime", crime_cols)
    return f


COUNTS = {"ocorrencias": "qtd_ocorrencia", "prisoes": "qtd_prisao"}


def _counts() -> list[Column]:
    return [F.sum("qtd_ocorrencia").alias("ocorrencias"), F.sum("qtd_prisao").alias("prisoes")]


def drill_calendar(w: Warehouse) -> DataFrame:
    """Drill-down Ano -> Trimestre -> Mês -> Dia with every subtotal."""
    keys = ["ano", "trimestre", "numero_mes", "dia_do_mes"]
    return rollup_sums(_fact_with(w, date_cols=keys), keys, COUNTS)


def drill_geo(w: Warehouse) -> DataFrame:
    """Drill-down District -> Beat (historical district of the version)."""
    keys = ["district", "beat"]
    return rollup_sums(_fact_with(w, geo_cols=keys), keys, COUNTS)


def drill_parallel(w: Warehouse) -> DataFrame:
    """Ward and community area as parallel (not nested) paths: grouping sets."""
    keys = ["ward", "community_area"]
    return rollup_sums(_fact_with(w, geo_cols=keys), keys, COUNTS, sets=[["ward"], ["community_area"]])


CELL_KEYS = ["ano", "numero_mes", "district", "categoria_analitica"]


def pushed_keys(dim: DataFrame, key: str, most: int = 1000) -> Column:
    """The keys of a filtered dimension as a list that the fact scan can prune row groups by; above ``most`` keys, no restriction.

    It stands beside the semi join on the same keys, which decides; at most ``most`` + 1 keys reach the driver."""
    keys = [r[0] for r in dim.select(key).distinct().limit(most + 1).collect()]
    return F.col(key).isin(*keys) if len(keys) <= most else F.lit(True)


def incidents_by_id(w: Warehouse, ids: list[int]) -> DataFrame:
    """The incidents of some ids; the fact's Bloom filters leave out the row groups that do not hold them."""
    return w.fct_ocorrencias.where(F.col("id_ocorrencia").isin(*ids)).drop(YEAR)


def drill_through_cells(w: Warehouse, cells: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """The incidents behind any set of report cells (ano, numero_mes, district,
    categoria_analitica) - a left semi join of the fact, enriched with the cell keys by
    broadcast lookups, against the (size-checked) cell set. The cells' date range is
    pushed into the fact scan as a key range first."""
    month = F.col("ano") * 10000 + F.col("numero_mes") * 100
    lo, hi = cells.select(F.min(month + 1)).scalar(), cells.select(F.max(month + 31)).scalar()  # no cell: NULL, no row
    years = [cells.select(x("ano")).scalar() for x in (F.min, F.max)]
    f = w.fct_ocorrencias.where(F.col(YEAR).between(*years) & F.col("sk_data").between(lo, hi))
    f = _join(f, w.dim_data, "sk_data", ["ano", "numero_mes"], known_rows=CALENDAR_ROWS)
    f = _join(f, w.dim_geografia, "sk_geografia", ["district"])
    f = _join(f, w.dim_crime, "sk_crime", ["categoria_analitica"])
    f = f.join(broadcast_if_small(cells.select(*CELL_KEYS).distinct(), max_rows), CELL_KEYS, "left_semi")
    return f.select("id_ocorrencia", "case_number", "data_hora_ocorrencia", "sk_crime", "sk_geografia", "qtd_prisao")


def drill_through(w: Warehouse, ano=2012, numero_mes=6, district=12, categoria_analitica="Crime violento", push_keys: bool = False) -> DataFrame:
    """O11 for one selected cell: left semi joins with the filtered dimensions (the cell's
    month is also pushed into the fact scan as a date-key range). ``push_keys`` reads the few keys of its places and codes
    first and pushes them too, so that a large fact gives up the row groups without them; planning then starts jobs."""
    first = ano * 10000 + numero_mes * 100
    f = w.fct_ocorrencias.where((F.col(YEAR) == ano) & F.col("sk_data").between(first + 1, first + 31))
    d = w.dim_data.where((F.col("ano") == ano) & (F.col("numero_mes") == numero_mes)).select("sk_data")
    g = w.dim_geografia.where(F.col("district") == district).select("sk_geografia")
    c = w.dim_crime.where(F.col("categoria_analitica") == categoria_analitica).select("sk_crime")
    if push_keys:
        f = f.where(pushed_keys(g, "sk_geografia") & pushed_keys(c, "sk_crime"))
    f = f.join(broadcast_if_small(d, known_rows=CALENDAR_ROWS), "sk_data", "left_semi")
    f = f.join(broadcast_if_small(g), "sk_geografia", "left_semi")
    f = f.join(broadcast_if_small(c), "sk_crime", "left_semi")
    return f.select("id_ocorrencia", "case_number", "data_hora_ocorrencia", "sk_crime", "sk_geografia", "qtd_prisao")


def daily_series(w: Warehouse) -> DataFrame:
    """Gap-free daily series - every calendar day, zero when nothing happened."""
    c = w.fct_ocorrencias.groupBy("sk_data").agg(*_counts())
    # one row per calendar key (+ the unknown -1): bounded by the calendar, safe to broadcast
    c = broadcast_if_small(c, known_rows=CALENDAR_ROWS + 1)
    return w.dim_data.select("sk_data", "data_completa").join(c, "sk_data", "left").select(
        "sk_data", "data_completa",
        F.coalesce("ocorrencias", F.lit(0).cast("bigint")).alias("ocorrencias"),
        F.coalesce("prisoes", F.lit(0).cast("bigint")).alias("prisoes"),
    )


def hour_profile(w: Warehouse) -> DataFrame:
    """Incidents by hour of day, independent of date (all 24 hours + unknown)."""
    c = broadcast_if_small(w.fct_ocorrencias.groupBy("sk_hora").agg(*_counts()), known_rows=25)  # hours + -1
    return w.dim_hora.select("sk_hora", "hora_formatada", "periodo_do_dia", "faixa_operacional").join(
        c, "sk_hora", "left").select(
        "sk_hora", "hora_formatada", "periodo_do_dia", "faixa_operacional",
        F.coalesce("ocorrencias", F.lit(0).cast("bigint")).alias("ocorrencias"),
        F.coalesce("prisoes", F.lit(0).cast("bigint")).alias("prisoes"),
    )


def flags_profile(w: Warehouse) -> DataFrame:
    """Junk dimension as a filter axis: incidents per arrest/domestic combination."""
    c = w.fct_ocorrencias.groupBy("sk_flags").agg(F.sum("qtd_ocorrencia").alias("ocorrencias"))
    c = broadcast_if_small(c, known_rows=5)  # 4 combinations + NULL
    return w.dim_flags.select("sk_flags", "descricao_combinada").join(c, "sk_flags", "left").select(
        "sk_flags", "descricao_combinada", F.coalesce("ocorrencias", F.lit(0).cast("bigint")).alias("ocorrencias"))


def monthly_series(w: Warehouse) -> DataFrame:
    """Shrunken month dimension with the monthly fact's sums, zero-filled."""
    c = w.fct_desempenho_mensal.groupBy("sk_mes").agg(
        F.sum("qtd_ocorrencias").alias("ocorrencias"), F.sum("qtd_prisoes").alias("prisoes"))
    c = broadcast_if_small(c, known_rows=CALENDAR_MONTHS + 1)  # months of the calendar + -1
    return w.dim_mes.select("sk_mes", "descricao_mes", "flag_ano_parcial").join(c, "sk_mes", "left").select(
        "sk_mes", "descricao_mes", "flag_ano_parcial",
        F.coalesce("ocorrencias", F.lit(0).cast("bigint")).alias("ocorrencias"),
        F.coalesce("prisoes", F.lit(0).cast("bigint")).alias("prisoes"),
    )


def yearly_trend(w: Warehouse) -> DataFrame:
    """Yearly trend without the partial year."""
    f = _fact_with(w, date_cols=["ano"], date_where=~F.col("flag_ano_parcial"))
    return ratio_measure(f, ["ano"], "qtd_prisao", "qtd_ocorrencia")


def ward_trend(w: Warehouse) -> DataFrame:
    """Ward analysis only from the first year with ward coverage."""
    f = _fact_with(w, date_cols=["ano"], geo_cols=["ward"], date_where=F.col("ano") >= K.WARD_COVERAGE_FROM,
                   fact_where=(F.col(YEAR) >= K.WARD_COVERAGE_FROM) & (F.col("sk_data") >= K.WARD_COVERAGE_FROM * 10000 + 101))
    return f.groupBy("ano", "ward").agg(*_counts())


def by_current_label(w: Warehouse) -> DataFrame:
    """Aggregate by code and current wording; count historical spellings merged."""
    f = _fact_with(w, crime_cols=["iucr", "description_atual", "description"])
    return f.groupBy("iucr", "description_atual").agg(
        F.sum("qtd_ocorrencia").alias("ocorrencias"),
        F.countDistinct("description").alias("grafias_historicas"),
    )


def district_then_now(w: Warehouse) -> DataFrame:
    """Incidents by historical district vs the beat's current district."""
    f = _fact_with(w, geo_cols=["district", "district_atual"])
    return f.groupBy("district", "district_atual").agg(F.sum("qtd_ocorrencia").alias("ocorrencias"))


def _by_axis(w: Warehouse, key: str, dim, columns: list[str], known_rows: int | None = None) -> DataFrame:
    """The fact summed to one dimension key, then to some of the dimension's attributes."""
    c = w.fct_ocorrencias.groupBy(key).agg(*_counts())
    d = broadcast_if_small(dim.select(key, *columns), known_rows=known_rows)
    return c.join(d, key).groupBy(*columns).agg(F.sum("ocorrencias").alias("ocorrencias"), F.sum("prisoes").alias("prisoes"))


def weekday_profile(w: Warehouse) -> DataFrame:
    """Incidents by weekday and weekend flag (H7)."""
    return _by_axis(w, "sk_data", w.dim_data, ["numero_dia_semana", "nome_dia_semana", "flag_fim_de_semana"], CALENDAR_ROWS)


def week_series(w: Warehouse) -> DataFrame:
    """Incidents by year and ISO week, with the day of the year the calendar gives (H6, H7)."""
    return _by_axis(w, "sk_data", w.dim_data, ["ano", "semana_do_ano", "dia_do_ano"], CALENDAR_ROWS)


def night_profile(w: Warehouse) -> DataFrame:
    """Incidents by night flag and period of the day."""
    return _by_axis(w, "sk_hora", w.dim_hora, ["flag_noturno", "periodo_do_dia"], 25)


def location_profile(w: Warehouse) -> DataFrame:
    """Incidents by location category and public-place flag."""
    return _by_axis(w, "sk_local", w.dim_local, ["categoria_local", "flag_local_publico"])


def month_start_series(w: Warehouse) -> DataFrame:
    """Incidents of the monthly fact by first day of the month (H9)."""
    c = w.fct_desempenho_mensal.groupBy("sk_mes").agg(F.sum("qtd_ocorrencias").alias("ocorrencias"))
    return c.join(broadcast_if_small(w.dim_mes.select("sk_mes", "primeiro_dia_mes"), known_rows=CALENDAR_MONTHS), "sk_mes").select("primeiro_dia_mes", "ocorrencias")


def _monthly(w: Warehouse, **options) -> DataFrame:
    return fct_desempenho_mensal(w.fct_ocorrencias, w.dim_data, w.dim_geografia, w.dim_crime, w.dim_mes, w.dim_distrito, w.dim_tipo_crime, **options)


def monthly_regrouped(w: Warehouse) -> DataFrame:
    """The monthly fact at a unique grain: rows of equal keys summed."""
    return _monthly(w, regroup=True)


def monthly_with_closed(w: Warehouse) -> DataFrame:
    """The monthly fact with closed districts under their own key."""
    return _monthly(w, include_closed=True)
