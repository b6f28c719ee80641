"""Independent DuckDB SQL for every registered query (the correctness oracle).

Plain SQL over the pre-registered driver views, deliberately formulated differently from
the Spark plans so that a shared mistake is unlikely: ``row_number`` windows instead of
``max_by``; brute-force correlated sub-queries for snapshot history instead of the window
replay; correlated scalar look-ups for the fact's keys (they fail loudly if a look-up ever
matched twice); window aggregates for current attributes and back-dating; explicit
DISTINCT sub-queries for profiling; integer arithmetic for rounded ratios. Fixed values
are read from ``constants`` so they are stated once.
"""

from __future__ import annotations

from . import constants as K
from ..functions.keys import surrogate_key_sql as sk
from ..sources.fixture import FIXTURE_RUNS, LINE_ORDER


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ts(d) -> str:
    return f"TIMESTAMP '{d:%Y-%m-%d %H:%M:%S}'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values) + ")"


def ratio_sql(p: str, n: str) -> str:
    """round(p / n * 100, 2) half-up, exact, via integers; NULL when n = 0. Presented as
    DOUBLE (the decimal value correctly rounded), like the registered Spark results."""
    return (f"CASE WHEN ({n}) = 0 THEN NULL ELSE CAST(CAST(((20000 * ({p}) + ({n})) // (2 * ({n}))) / 100.0 "
            f"AS DECIMAL(27,2)) AS DOUBLE) END")


BEGIN = _ts(K.BEGINNING_OF_TIME)
END = _ts(K.END_OF_TIME)

ADAPTER = """
with li as (
  select l_orderkey * 10 + l_linenumber as rid, l_orderkey, l_linenumber,
         l_partkey as pk, l_suppkey as sk, l_quantity as qty, l_returnflag as rf, l_linestatus as ls,
         count(*) over (partition by l_orderkey, l_linenumber order by @LINE_ORDER@ rows unbounded preceding) as rn
  from lineitem),
b as (
  select li.*, o_orderdate as od, year(o_orderdate) as oy, pk % 40 as code, pk % 24 as hh, sk % 25 as dist
  from li join orders on l_orderkey = o_orderkey)
select
  cast(rid * 100000 + rn as string) as id,
  'HX' || repeat('0', greatest(0, 7 - length(cast(l_orderkey as string)))) || cast(l_orderkey as string) as case_number,
  lpad(cast(month(od) as string), 2, '0') || '/' || lpad(cast(day(od) as string), 2, '0') || '/' || cast(oy + 12 as string)
    || ' ' || lpad(cast(case when hh % 12 = 0 then 12 else hh % 12 end as string), 2, '0')
    || ':' || lpad(cast(sk % 60 as string), 2, '0') || ':' || lpad(cast(rid % 60 as string), 2, '0')
    || case when hh < 12 then ' AM' else ' PM' end as date,
  '0' || lpad(cast(rid % 99 as string), 2, '0') || 'XX BLOCK ' as block,
  ' ' || lpad(cast(code as string), 4, '0') || case when code % 2 = 0 then 'a' else 'A' end as iucr,
  case code % 8 when 0 then 'THEFT' when 1 then 'BATTERY' when 2 then 'NARCOTICS'
    when 3 then case when oy < 1999 then 'CRIM SEXUAL ASSAULT' else 'CRIMINAL SEXUAL ASSAULT' end
    when 4 then 'WEAPONS VIOLATION' when 5 then 'non-criminal (subject specified)'
    when 6 then 'ROBBERY' else 'BURGLARY' end as primary_type,
  case when code % 3 = 0 and oy < 1999 then 'ARMED: KIND ' else 'ARMED - KIND ' end || cast(code as string) as description,
  case when l_linenumber = 7 then null else case sk % 8 when 0 then 'STREET' when 1 then 'RESIDENCE - YARD'
    when 2 then 'PARKING LOT' when 3 then 'BARBERSHOP' when 4 then 'CTA BUS' when 5 then 'SCHOOL YARD'
    when 6 then 'VEHICLE' else 'OTHER' end end as location_description,
  case when rf = 'R' then 'true' else 'false' end as arrest,
  case when ls = 'O' then 'True' else 'false' end as domestic,
  case when qty = 50 then null else lpad(cast(dist * 100 + sk % 4 + 11 as string), 4, '0') end as beat,
  case when l_linenumber = 5 and sk % 50 = 0 then null
       when dist in (13, 21, 23) and oy >= 2000 then '012' else lpad(cast(dist as string), 3, '0') end as district,
  case when oy = 1995 then null else cast(pk % 50 + 1 as string) end as ward,
  case when oy = 1995 then null else cast(pk % 77 + 1 as string) end as community_area,
  lpad(cast(code % 8 as string), 2, '0') as fbi_code,
  cast(null as string) as x_coordinate, cast(null as string) as y_coordinate,
  cast(oy + 12 as string) as year,
  '01/02/2014 03:04:05 PM' as updated_on,
  case when l_linenumber = 6 then null else '41.' || lpad(cast(l_orderkey * 7919 % 1000000000 as string), 9, '0') end as latitude,
  case when l_linenumber = 6 then null else '-87.' || lpad(cast(l_orderkey * 104729 % 1000000000 as string), 9, '0') end as longitude,
  cast(null as string) as location
from b
""".replace("@LINE_ORDER@", ", ".join(f"{c} NULLS FIRST" for c in LINE_ORDER))

_TS = "strptime({c}, '%m/%d/%Y %I:%M:%S %p')"


def _blank_null(expr: str) -> str:
    return f"CASE WHEN {expr} = '' THEN NULL ELSE {expr} END"


def _digits_int(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return f"CAST({_blank_null(d)} AS INTEGER)"


STG = f"""
SELECT CAST(id AS BIGINT) AS id_ocorrencia, {_blank_null('trim(case_number)')} AS case_number,
  ts AS data_hora_ocorrencia, CAST(ts AS DATE) AS data_ocorrencia, CAST(hour(ts) AS INTEGER) AS hora_ocorrencia,
  {_TS.format(c='updated_on')} AS data_atualizacao_fonte,
  upper(trim(iucr)) AS iucr, upper(trim(primary_type)) AS primary_type, upper(trim(description)) AS description,
  upper(trim(fbi_code)) AS fbi_code,
  {_digits_int('beat')} AS beat, {_digits_int('district')} AS district, {_digits_int('ward')} AS ward,
  {_digits_int('community_area')} AS community_area,
  {_blank_null('trim(upper(location_description))')} AS location_description, {_blank_null('trim(block)')} AS block,
  CAST({_blank_null('trim(latitude)')} AS DECIMAL(12,8)) AS latitude,
  CAST({_blank_null('trim(longitude)')} AS DECIMAL(12,8)) AS longitude,
  CASE WHEN arrest IS NULL THEN NULL ELSE upper(trim(arrest)) = 'TRUE' END AS flag_prisao,
  CASE WHEN domestic IS NULL THEN NULL ELSE upper(trim(domestic)) = 'TRUE' END AS flag_domestico
FROM (SELECT *, {_TS.format(c='date')} AS ts FROM crimes_raw WHERE id IS NOT NULL AND date IS NOT NULL)
"""

RUNS = "SELECT * FROM (VALUES " + ", ".join(
    f"({i + 1}, {_ts(r.as_of)}, {_q(r.crime_filter)}, {_q(r.geo_filter)})" for i, r in enumerate(FIXTURE_RUNS)
) + ") AS t(run, as_of, crime_filter, geo_filter)"


def _latest(key: str, attrs: list[str], where: str) -> str:
    cols = ", ".join([key] + attrs)
    return (f"SELECT {cols} FROM (SELECT {cols}, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY data_hora_ocorrencia DESC, id_ocorrencia DESC) AS rn FROM stg_crimes "
            f"WHERE {key} IS NOT NULL AND ({where})) WHERE rn = 1")


def _states(key: str, attrs: list[str], filt: str, extra: str = "") -> str:
    parts = []
    for i, r in enumerate(FIXTURE_RUNS):
        w = getattr(r, filt)
        if extra:
            w = f"{extra} AND ({w})"
        parts.append(f"SELECT {i + 1} AS run, {_ts(r.as_of)} AS as_of, * FROM ({_latest(key, attrs, w)})")
    return " UNION ALL ".join(parts)


def _history(states: str, key: str, attrs: list[str]) -> str:
    """Brute-force snapshot history: a version starts where the previous run lacks an
    equal row; it ends at the first later run lacking an equal row."""
    eq = lambda a, b: " AND ".join([f"{a}.{key} = {b}.{key}"] + [f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in attrs])
    cols = ", ".join(f"s.{c}" for c in [key] + attrs)
    return (f"SELECT {cols}, s.as_of AS dbt_valid_from, "
            f"(SELECT min(r2.as_of) FROM runs r2 WHERE r2.run > s.run AND NOT EXISTS "
            f"(SELECT 1 FROM {states} t WHERE t.run = r2.run AND {eq('t', 's')})) AS dbt_valid_to "
            f"FROM {states} s WHERE NOT EXISTS (SELECT 1 FROM {states} p WHERE p.run = s.run - 1 AND {eq('p', 's')})")


def _case_in(col: str, cats, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} IN {_in(v)} THEN {_q(lbl)}" for lbl, v in cats) + f" ELSE {_q(default)} END"


def _like_any(col: str, words) -> str:
    return "(" + " OR ".join(f"{col} LIKE {_q('%' + w + '%')}" for w in words) + ")"


def _case_like(col: str, cats, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {_like_any(col, w)} THEN {_q(lbl)}" for lbl, w in cats) + f" ELSE {_q(default)} END"


def _ranges(col: str, ranges) -> str:
    return "(" + " OR ".join(f"{col} BETWEEN {lo} AND {hi}" for lo, hi in ranges) + ")"


_MONTH_CASE = "[" + ", ".join(_q(m) for m in K.MONTH_NAMES) + "][month(data)]"
_DOW_CASE = "[" + ", ".join(_q(m) for m in K.WEEKDAY_NAMES) + "][isodow(data)]"

DIM_DATA = f"""
SELECT CAST(strftime(data, '%Y%m%d') AS INTEGER) AS sk_data, data AS data_completa,
  CAST(year(data) AS INTEGER) AS ano, CAST(quarter(data) AS INTEGER) AS trimestre,
  CAST(month(data) AS INTEGER) AS numero_mes, CAST(day(data) AS INTEGER) AS dia_do_mes,
  CAST(dayofyear(data) AS INTEGER) AS dia_do_ano, CAST(week(data) AS INTEGER) AS semana_do_ano,
  CAST(isodow(data) AS INTEGER) AS numero_dia_semana, strftime(data, '%Y-%m') AS ano_mes,
  {_q(K.QUARTER_PREFIX)} || CAST(quarter(data) AS VARCHAR) AS nome_trimestre,
  {_MONTH_CASE} AS nome_mes, {_DOW_CASE} AS nome_dia_semana,
  isodow(data) IN {_in(K.WEEKEND_ISO_DAYS)} AS flag_fim_de_semana,
  year(data) = {K.PARTIAL_YEAR} AS flag_ano_parcial
FROM (SELECT CAST(range AS DATE) AS data FROM range(DATE '{K.CALENDAR_START}', DATE '{K.CALENDAR_END}' + INTERVAL 1 DAY, INTERVAL 1 DAY))
"""

_PERIOD = "CASE " + " ".join(f"WHEN h BETWEEN {lo} AND {hi} THEN {_q(l)}" for lo, hi, l in K.DAY_PERIODS) + f" ELSE {_q(K.DAY_PERIOD_ELSE)} END"
_BAND = "CASE " + " ".join(f"WHEN {_ranges('h', r)} THEN {_q(l)}" for r, l in K.OPERATIONAL_BANDS) + f" ELSE {_q(K.OPERATIONAL_ELSE)} END"
NI = _q(K.NOT_INFORMED)
ND = _q(K.NOT_AVAILABLE)

DIM_HORA = f"""
SELECT h AS sk_hora, h AS hora_do_dia, lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS hora_formatada,
  {_PERIOD} AS periodo_do_dia, {_BAND} AS faixa_operacional, {_ranges('h', K.NIGHT_HOURS)} AS flag_noturno
FROM (SELECT CAST(range AS INTEGER) AS h FROM range(0, 24))
UNION ALL SELECT -1, -1, {NI}, {NI}, {NI}, false
"""

DIM_LOCAL = f"""
SELECT {sk('location_description')} AS sk_local, location_description AS descricao_local,
  {_case_like('location_description', K.LOCATION_CATEGORIES, K.LOCATION_CATEGORY_ELSE)} AS categoria_local,
  {_like_any('location_description', K.PUBLIC_PLACE_WORDS)} AS flag_local_publico
FROM stg_crimes WHERE location_description IS NOT NULL GROUP BY location_description
UNION ALL SELECT '-1', {NI}, {NI}, false
"""

_COMBINED = "CASE " + " ".join(
    f"WHEN prisao = {str(p).lower()} AND domestico = {str(d).lower()} THEN {_q(l)}" for p, d, l in K.COMBINED_FLAG_LABELS
) + " END"

DIM_FLAGS = f"""
SELECT {sk('prisao', 'domestico')} AS sk_flags, prisao AS flag_prisao, domestico AS flag_domestico,
  CASE WHEN prisao THEN {_q(K.ARREST_LABELS[0])} ELSE {_q(K.ARREST_LABELS[1])} END AS descricao_prisao,
  CASE WHEN domestico THEN {_q(K.DOMESTIC_LABELS[0])} ELSE {_q(K.DOMESTIC_LABELS[1])} END AS descricao_domestico,
  {_COMBINED} AS descricao_combinada
FROM (VALUES (true), (false)) p(prisao), (VALUES (true), (false)) d(domestico)
"""

DIM_CRIME = f"""
SELECT {sk('iucr', 'dbt_valid_from')} AS sk_crime, iucr, primary_type, description, fbi_code,
  max(primary_type) FILTER (WHERE dbt_valid_to IS NULL) OVER (PARTITION BY iucr) AS primary_type_atual,
  max(description) FILTER (WHERE dbt_valid_to IS NULL) OVER (PARTITION BY iucr) AS description_atual,
  {_case_in('primary_type', K.CRIME_CATEGORIES, K.CRIME_CATEGORY_ELSE)} AS categoria_analitica,
  CASE WHEN dbt_valid_from = min(dbt_valid_from) OVER () THEN {BEGIN} ELSE dbt_valid_from END AS valido_de,
  coalesce(dbt_valid_to, {END}) AS valido_ate,
  dbt_valid_to IS NULL AS flag_versao_atual
FROM snap_crime
UNION ALL SELECT '-1', {ND}, {NI}, {NI}, {ND}, {NI}, {NI}, {NI}, {BEGIN}, {END}, true
"""

DIM_GEOGRAFIA = f"""
SELECT {sk('h.beat', 'h.dbt_valid_from')} AS sk_geografia, h.beat, lpad(CAST(h.beat AS VARCHAR), 4, '0') AS beat_formatado,
  h.district, lpad(CAST(h.district AS VARCHAR), 3, '0') AS district_formatado,
  {_q(K.DISTRICT_PREFIX)} || CAST(h.district AS VARCHAR) AS nome_district,
  h.district_atual, a.ward, {_q(K.WARD_PREFIX)} || CAST(a.ward AS VARCHAR) AS nome_ward, a.community_area,
  h.district <> h.district_atual AS flag_distrito_reorganizado,
  CASE WHEN h.dbt_valid_from = h.first_run THEN {BEGIN} ELSE h.dbt_valid_from END AS valido_de,
  coalesce(h.dbt_valid_to, {END}) AS valido_ate,
  h.dbt_valid_to IS NULL AS flag_versao_atual
FROM (SELECT *, max(district) FILTER (WHERE dbt_valid_to IS NULL) OVER (PARTITION BY beat) AS district_atual,
             min(dbt_valid_from) OVER () AS first_run FROM snap_geografia) h
LEFT JOIN ({_latest('beat', ['ward', 'community_area'], 'ward IS NOT NULL AND community_area IS NOT NULL')}) a
  ON a.beat = h.beat
UNION ALL SELECT '-1', -1, {ND}, -1, {ND}, {NI}, -1, -1, {NI}, -1, false, {BEGIN}, {END}, true
"""

DIM_MES = """
SELECT CAST(ano * 100 + numero_mes AS INTEGER) AS sk_mes, min(ano_mes) AS ano_mes, ano, min(trimestre) AS trimestre,
  numero_mes, min(nome_mes) AS nome_mes, min(nome_trimestre) AS nome_trimestre,
  min(nome_mes) || '/' || CAST(ano AS VARCHAR) AS descricao_mes, make_date(ano, numero_mes, 1) AS primeiro_dia_mes,
  bool_and(flag_ano_parcial) AS flag_ano_parcial
FROM dim_data WHERE sk_data != -1 GROUP BY ano, numero_mes
"""

DIM_DISTRITO = f"""
SELECT {sk('district', 'valido_de')} AS sk_distrito, district, lpad(CAST(district AS VARCHAR), 3, '0') AS district_formatado,
  {_q(K.DISTRICT_PREFIX)} || CAST(district AS VARCHAR) AS nome_district,
  district IN {_in(K.DEACTIVATED_DISTRICTS)} AS flag_distrito_desativado, valido_de, valido_ate, flag_versao_atual
FROM (SELECT district, min(valido_de) AS valido_de, max(valido_ate) AS valido_ate,
             max(CAST(flag_versao_atual AS INTEGER)) = 1 AS flag_versao_atual
      FROM dim_geografia WHERE sk_geografia != '-1' AND district IS NOT NULL GROUP BY district)
UNION ALL SELECT '-1', -1, {ND}, {NI}, false, {BEGIN}, {END}, true
"""

INITCAP = ("array_to_string(list_transform(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), "
           "lambda w: upper(w[1]) || w[2:]), '')")

DIM_TIPO_CRIME = f"""
SELECT {sk('primary_type')} AS sk_tipo_crime, primary_type, {INITCAP.format(c='primary_type')} AS nome_tipo_crime,
  categoria_analitica, categoria_analitica = {_q(K.VIOLENT_CATEGORY)} AS flag_crime_violento
FROM (SELECT primary_type_atual AS primary_type, categoria_analitica FROM dim_crime
      WHERE sk_crime != '-1' AND primary_type_atual IS NOT NULL AND primary_type_atual != {NI}
      GROUP BY primary_type_atual, categoria_analitica)
UNION ALL SELECT '-1', {ND}, {NI}, {NI}, false
"""

FCT = """
SELECT o.id_ocorrencia AS sk_ocorrencia, o.id_ocorrencia, o.case_number,
  coalesce((SELECT d.sk_data FROM dim_data d WHERE d.data_completa = o.data_ocorrencia), -1) AS sk_data,
  coalesce((SELECT h.sk_hora FROM dim_hora h WHERE h.sk_hora = o.hora_ocorrencia), -1) AS sk_hora,
  coalesce((SELECT c.sk_crime FROM dim_crime c WHERE c.iucr = o.iucr
            AND c.valido_de <= o.data_hora_ocorrencia AND o.data_hora_ocorrencia < c.valido_ate), '-1') AS sk_crime,
  coalesce((SELECT g.sk_geografia FROM dim_geografia g WHERE g.beat = o.beat
            AND g.valido_de <= o.data_hora_ocorrencia AND o.data_hora_ocorrencia < g.valido_ate), '-1') AS sk_geografia,
  coalesce((SELECT l.sk_local FROM dim_local l WHERE l.descricao_local = o.location_description), '-1') AS sk_local,
  (SELECT x.sk_flags FROM dim_flags x WHERE x.flag_prisao = o.flag_prisao AND x.flag_domestico = o.flag_domestico)
    AS sk_flags,
  o.latitude, o.longitude, o.data_hora_ocorrencia,
  1 AS qtd_ocorrencia, CAST(coalesce(o.flag_prisao, false) AS INTEGER) AS qtd_prisao,
  CAST(coalesce(o.flag_domestico, false) AS INTEGER) AS qtd_domestico
FROM stg_crimes o
"""

FCT_P2 = """
SELECT coalesce(m.sk_mes, -1) AS sk_mes, coalesce(dt.sk_distrito, '-1') AS sk_distrito,
  coalesce(tc.sk_tipo_crime, '-1') AS sk_tipo_crime,
  a.qtd_ocorrencias, a.qtd_prisoes, a.qtd_domesticos, a.qtd_sem_prisao
FROM (
  SELECT k_mes, k_dist, k_tipo, CAST(sum(n) AS INTEGER) AS qtd_ocorrencias, CAST(sum(p) AS INTEGER) AS qtd_prisoes,
    CAST(sum(dm) AS INTEGER) AS qtd_domesticos, CAST(sum(n) - sum(p) AS INTEGER) AS qtd_sem_prisao
  FROM (SELECT cal.ano * 100 + cal.numero_mes AS k_mes, geo.district AS k_dist, cr.primary_type_atual AS k_tipo,
          f.qtd_ocorrencia AS n, f.qtd_prisao AS p, f.qtd_domestico AS dm
        FROM fct_ocorrencias f, dim_data cal, dim_geografia geo, dim_crime cr
        WHERE f.sk_data = cal.sk_data AND f.sk_geografia = geo.sk_geografia AND f.sk_crime = cr.sk_crime
          AND cal.sk_data <> -1)
  GROUP BY k_mes, k_dist, k_tipo) a
LEFT JOIN dim_mes m ON m.sk_mes = a.k_mes
LEFT JOIN (SELECT * FROM dim_distrito WHERE flag_versao_atual) dt ON dt.district = a.k_dist
LEFT JOIN dim_tipo_crime tc ON tc.primary_type = a.k_tipo
"""

CRIME_ATTRS = ["primary_type", "description", "fbi_code"]

CTES = [
    ("crimes_raw", ADAPTER),
    ("stg_crimes", STG),
    ("runs", RUNS),
    ("st_crime", _states("iucr", CRIME_ATTRS, "crime_filter")),
    ("st_geo", _states("beat", ["district"], "geo_filter", extra="district IS NOT NULL")),
    ("snap_crime", _history("st_crime", "iucr", CRIME_ATTRS)),
    ("snap_geografia", _history("st_geo", "beat", ["district"])),
    ("dim_data", DIM_DATA),
    ("dim_hora", DIM_HORA),
    ("dim_local", DIM_LOCAL),
    ("dim_flags", DIM_FLAGS),
    ("dim_crime", DIM_CRIME),
    ("dim_geografia", DIM_GEOGRAFIA),
    ("dim_mes", DIM_MES),
    ("dim_distrito", DIM_DISTRITO),
    ("dim_tipo_crime", DIM_TIPO_CRIME),
    ("fct_ocorrencias", FCT),
    ("fct_desempenho_mensal", FCT_P2),
]


def with_models(final: str) -> str:
    """``final`` preceded by every model as a CTE (DuckDB only evaluates those referenced)."""
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in CTES) + "\n" + final


# --- report / semantic-model queries ----------------------------------------------------

def _sum(c: str) -> str:
    return f"CAST(sum({c}) AS BIGINT)"


RATE = ratio_sql("sum(a)", "sum(n)")


def _p1_rows(year_from: int, year_to: int, district: int) -> str:
    return ("SELECT cal.ano, cal.numero_mes, cal.nome_mes, geo.nome_district, cr.categoria_analitica, "
            "cr.primary_type_atual AS tipo_crime, f.qtd_ocorrencia AS n, f.qtd_prisao AS a FROM fct_ocorrencias f, "
            f"(SELECT * FROM dim_data WHERE ano >= {year_from} AND ano <= {year_to}) cal, "
            f"(SELECT * FROM dim_geografia WHERE district = {district}) geo, dim_crime cr "
            "WHERE f.sk_data = cal.sk_data AND f.sk_geografia = geo.sk_geografia AND f.sk_crime = cr.sk_crime")


def rpt_p1(year_from=2009, year_to=2013, district=12) -> str:
    return (f"SELECT ano, numero_mes, nome_mes, nome_district, categoria_analitica, tipo_crime, "
            f"CAST(sum(n) AS BIGINT) AS ocorrencias, CAST(sum(a) AS BIGINT) AS prisoes, {RATE} AS taxa_prisao_pct "
            f"FROM ({_p1_rows(year_from, year_to, district)}) x GROUP BY 1, 2, 3, 4, 5, 6")


def rpt_p1_rollup(year_from=2009, year_to=2013, district=12) -> str:
    keys = "ano, nome_district, categoria_analitica"
    return (f"SELECT {keys}, CAST(grouping({keys}) AS INTEGER) AS nivel, CAST(sum(n) AS BIGINT) AS ocorrencias, "
            f"CAST(sum(a) AS BIGINT) AS prisoes, {RATE} AS taxa_prisao_pct "
            f"FROM ({_p1_rows(year_from, year_to, district)}) x GROUP BY ROLLUP ({keys}) HAVING count(*) > 0")


def _p2_rows(year_from: int, year_to: int, crime_type: str) -> str:
    return ("SELECT mo.ano, mo.numero_mes, mo.nome_mes, di.nome_district, ty.nome_tipo_crime, ty.categoria_analitica, "
            "f.qtd_ocorrencias AS n, f.qtd_prisoes AS a, f.qtd_domesticos AS dm FROM fct_desempenho_mensal f, "
            f"(SELECT * FROM dim_mes WHERE ano >= {year_from} AND ano <= {year_to}) mo, dim_distrito di, "
            f"(SELECT * FROM dim_tipo_crime WHERE primary_type = {_q(crime_type)}) ty "
            "WHERE f.sk_mes = mo.sk_mes AND f.sk_distrito = di.sk_distrito AND f.sk_tipo_crime = ty.sk_tipo_crime")


def rpt_p2(year_from=2009, year_to=2013, crime_type="THEFT") -> str:
    return ("SELECT ano, numero_mes, nome_mes, nome_district, nome_tipo_crime, categoria_analitica, "
            "CAST(sum(n) AS BIGINT) AS ocorrencias, CAST(sum(a) AS BIGINT) AS prisoes, "
            f"CAST(sum(dm) AS BIGINT) AS domesticos FROM ({_p2_rows(year_from, year_to, crime_type)}) x "
            "GROUP BY 1, 2, 3, 4, 5, 6")


def rpt_p2_rollup(year_from=2009, year_to=2013, crime_type="THEFT") -> str:
    keys = "ano, nome_district"
    return (f"SELECT {keys}, CAST(grouping({keys}) AS INTEGER) AS nivel, CAST(sum(n) AS BIGINT) AS ocorrencias, "
            "CAST(sum(a) AS BIGINT) AS prisoes, CAST(sum(dm) AS BIGINT) AS domesticos "
            f"FROM ({_p2_rows(year_from, year_to, crime_type)}) x GROUP BY ROLLUP ({keys}) HAVING count(*) > 0")


RPT_PICK_DISTRICT = "SELECT district, nome_district FROM dim_distrito WHERE flag_versao_atual"
RPT_PICK_TYPE = "SELECT primary_type, nome_tipo_crime FROM dim_tipo_crime WHERE sk_tipo_crime != '-1'"

RATIO_MEASURE = (
    "SELECT m.ano, dt.nome_district, " + _sum("f.qtd_prisoes") + " AS qtd_prisoes, " + _sum("f.qtd_ocorrencias")
    + " AS qtd_ocorrencias, " + ratio_sql("sum(f.qtd_prisoes)", "sum(f.qtd_ocorrencias)") + " AS taxa_prisao_pct "
    "FROM fct_desempenho_mensal f JOIN dim_mes m ON f.sk_mes = m.sk_mes "
    "JOIN dim_distrito dt ON f.sk_distrito = dt.sk_distrito GROUP BY m.ano, dt.nome_district"
)

DRILL_ACROSS = """
SELECT CAST(coalesce(p1.sk_mes, p2.sk_mes) AS INTEGER) AS sk_mes, coalesce(p1.district, p2.district) AS district,
  CAST(coalesce(p1.o, 0) AS BIGINT) AS ocorrencias_p1, CAST(coalesce(p1.p, 0) AS BIGINT) AS prisoes_p1,
  CAST(coalesce(p2.o, 0) AS BIGINT) AS ocorrencias_p2, CAST(coalesce(p2.p, 0) AS BIGINT) AS prisoes_p2
FROM (SELECT d.ano * 100 + d.numero_mes AS sk_mes, g.district, sum(f.qtd_ocorrencia) AS o, sum(f.qtd_prisao) AS p
      FROM fct_ocorrencias f JOIN dim_data d ON f.sk_data = d.sk_data JOIN dim_geografia g ON f.sk_geografia = g.sk_geografia
      GROUP BY 1, 2) p1
FULL OUTER JOIN (SELECT f.sk_mes, dt.district, sum(f.qtd_ocorrencias) AS o, sum(f.qtd_prisoes) AS p
      FROM fct_desempenho_mensal f JOIN dim_distrito dt ON f.sk_distrito = dt.sk_distrito GROUP BY 1, 2) p2
  ON p1.sk_mes = p2.sk_mes AND p1.district = p2.district
"""

_COUNTS = f"{_sum('f.qtd_ocorrencia')} AS ocorrencias, {_sum('f.qtd_prisao')} AS prisoes"


# Spark's ROLLUP emits no grand-total row over an empty input (a report over no data
# shows nothing); DuckDB emits one, so the oracle keeps only groups that have rows.
def _rollup(keys: str, join: str) -> str:
    return (f"SELECT {keys}, {_COUNTS}, CAST(grouping({keys}) AS INTEGER) AS nivel FROM fct_ocorrencias f {join} "
            f"GROUP BY ROLLUP ({keys}) HAVING count(*) > 0")


DRILL_CALENDAR = _rollup("d.ano, d.trimestre, d.numero_mes, d.dia_do_mes", "JOIN dim_data d ON f.sk_data = d.sk_data")
DRILL_GEO = _rollup("g.district, g.beat", "JOIN dim_geografia g ON f.sk_geografia = g.sk_geografia")
DRILL_PARALLEL = (f"SELECT g.ward, g.community_area, {_COUNTS}, CAST(grouping(g.ward, g.community_area) AS INTEGER) AS nivel "
                  "FROM fct_ocorrencias f JOIN dim_geografia g ON f.sk_geografia = g.sk_geografia "
                  "GROUP BY GROUPING SETS ((g.ward), (g.community_area))")


def drill_through(ano=2012, numero_mes=6, district=12, categoria_analitica="Crime violento") -> str:
    return ("SELECT f.id_ocorrencia, f.case_number, f.data_hora_ocorrencia, f.sk_crime, f.sk_geografia, f.qtd_prisao "
            "FROM fct_ocorrencias f "
            f"WHERE f.sk_data IN (SELECT sk_data FROM dim_data WHERE ano = {ano} AND numero_mes = {numero_mes}) "
            f"AND f.sk_geografia IN (SELECT sk_geografia FROM dim_geografia WHERE district = {district}) "
            f"AND f.sk_crime IN (SELECT sk_crime FROM dim_crime WHERE categoria_analitica = {_q(categoria_analitica)})")


def _zero_filled(dim: str, key: str, cols: str, fact: str, sums: dict[str, str]) -> str:
    inner = ", ".join(f"sum({src}) AS {out}" for out, src in sums.items())
    outs = ", ".join(f"CAST(coalesce(c.{out}, 0) AS BIGINT) AS {out}" for out in sums)
    return (f"SELECT {cols}, {outs} FROM {dim} x LEFT JOIN (SELECT {key}, {inner} FROM {fact} GROUP BY {key}) c "
            f"ON x.{key} = c.{key}")


DAILY_SERIES = _zero_filled("dim_data", "sk_data", "x.sk_data, x.data_completa", "fct_ocorrencias",
                            {"ocorrencias": "qtd_ocorrencia", "prisoes": "qtd_prisao"})
HOUR_PROFILE = _zero_filled("dim_hora", "sk_hora", "x.sk_hora, x.hora_formatada, x.periodo_do_dia, x.faixa_operacional",
                            "fct_ocorrencias", {"ocorrencias": "qtd_ocorrencia", "prisoes": "qtd_prisao"})
FLAGS_PROFILE = _zero_filled("dim_flags", "sk_flags", "x.sk_flags, x.descricao_combinada", "fct_ocorrencias",
                             {"ocorrencias": "qtd_ocorrencia"})
MONTHLY_SERIES = _zero_filled("dim_mes", "sk_mes", "x.sk_mes, x.descricao_mes, x.flag_ano_parcial",
                              "fct_desempenho_mensal", {"ocorrencias": "qtd_ocorrencias", "prisoes": "qtd_prisoes"})

YEARLY_TREND = (f"SELECT d.ano, {_sum('f.qtd_prisao')} AS qtd_prisao, {_sum('f.qtd_ocorrencia')} AS qtd_ocorrencia, "
                f"{ratio_sql('sum(f.qtd_prisao)', 'sum(f.qtd_ocorrencia)')} AS taxa_prisao_pct FROM fct_ocorrencias f JOIN dim_data d ON f.sk_data = d.sk_data "
                "WHERE NOT d.flag_ano_parcial GROUP BY d.ano")
WARD_TREND = (f"SELECT d.ano, g.ward, {_COUNTS} FROM fct_ocorrencias f JOIN dim_data d ON f.sk_data = d.sk_data "
              f"JOIN dim_geografia g ON f.sk_geografia = g.sk_geografia WHERE d.ano >= {K.WARD_COVERAGE_FROM} "
              "GROUP BY d.ano, g.ward")
BY_CURRENT_LABEL = (f"SELECT c.iucr, c.description_atual, {_sum('f.qtd_ocorrencia')} AS ocorrencias, "
                    "CAST(count(DISTINCT c.description) AS BIGINT) AS grafias_historicas "
                    "FROM fct_ocorrencias f JOIN dim_crime c ON f.sk_crime = c.sk_crime GROUP BY c.iucr, c.description_atual")
DISTRICT_THEN_NOW = (f"SELECT g.district, g.district_atual, {_sum('f.qtd_ocorrencia')} AS ocorrencias "
                     "FROM fct_ocorrencias f JOIN dim_geografia g ON f.sk_geografia = g.sk_geografia "
                     "GROUP BY g.district, g.district_atual")


# --- profiling (raw text) ----------------------------------------------------------------
# Formulated independently of the Spark jobs: explicit DISTINCT sub-queries instead of
# COUNT(DISTINCT), CASE sums instead of filtered counts, joins instead of IN.

def _ndistinct(col: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT {col} FROM crimes_raw WHERE {col} IS NOT NULL))"


def _nulls(col: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)"


_DIGITS = "regexp_full_match({c}, '[0-9]+')"
_CONTRA_ROWS = (f"SELECT district, beat, year FROM crimes_raw WHERE {_DIGITS.format(c='district')} "
                f"AND {_DIGITS.format(c='beat')} AND TRY_CAST(district AS BIGINT) <> "
                "floor(TRY_CAST(beat AS BIGINT) / 100)")
_PAIRS = ("SELECT district, left(lpad(beat, 4, '0'), 2) AS prefixo_beat, min(year) AS primeiro_ano, "
          f"max(year) AS ultimo_ano, CAST(sum(1) AS BIGINT) AS qtd FROM ({_CONTRA_ROWS}) GROUP BY 1, 2")
_CARD = {"tipos": "primary_type", "iucr": "iucr", "descricoes": "description", "fbi": "fbi_code",
         "locais": "location_description", "beats": "beat", "distritos": "district", "wards": "ward",
         "areas": "community_area"}
_PER_CODE = ("SELECT iucr, attr, count(*) AS n FROM (SELECT DISTINCT iucr, 'p' AS attr, primary_type AS v FROM crimes_raw "
             "UNION ALL SELECT DISTINCT iucr, 'd', description FROM crimes_raw UNION ALL "
             "SELECT DISTINCT iucr, 'f', fbi_code FROM crimes_raw) WHERE v IS NOT NULL GROUP BY iucr, attr")

PROFILING = {
    "prof_total": "SELECT count(*) AS total_registros FROM crimes_raw",
    "prof_by_year": "SELECT year, CAST(sum(1) AS BIGINT) AS qtd FROM crimes_raw GROUP BY ALL",
    "prof_cardinality": "SELECT " + ", ".join(f"{_ndistinct(c)} AS {a}" for a, c in _CARD.items()),
    "prof_nulls": (
        f"SELECT (SELECT count(*) FROM crimes_raw) - {_ndistinct('id')} AS ids_duplicados, "
        + ", ".join(f"{_nulls(c)} AS {a}" for a, c in [("sem_coord", "latitude"), ("sem_distrito", "district"),
                                                       ("sem_ward", "ward"), ("sem_area", "community_area"),
                                                       ("sem_local_desc", "location_description")])
        + " FROM crimes_raw"),
    "prof_ward_coverage": (
        f"SELECT year, sem_ward, total FROM (SELECT year, {_nulls('ward')} AS sem_ward, "
        "CAST(sum(1) AS BIGINT) AS total FROM crimes_raw GROUP BY year) y WHERE sem_ward > 0"),
    "prof_iucr_combos": (
        "SELECT count(*) AS iucr_com_mais_de_uma_combinacao FROM (SELECT iucr FROM (SELECT DISTINCT iucr, "
        "primary_type || '|' || description || '|' || fbi_code AS combo FROM crimes_raw) WHERE combo IS NOT NULL "
        "GROUP BY iucr HAVING count(*) > 1)"),
    "prof_iucr_varies": (
        "SELECT "
        "CAST(sum(CASE WHEN attr = 'p' AND n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS iucr_varia_primary_type, "
        "CAST(sum(CASE WHEN attr = 'd' AND n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS iucr_varia_description, "
        "CAST(sum(CASE WHEN attr = 'f' AND n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS iucr_varia_fbi_code "
        f"FROM ({_PER_CODE}) c"),
    "prof_description_drift": (
        "SELECT * FROM (SELECT r.iucr, r.primary_type, r.description, r.fbi_code, min(r.year) AS primeiro_ano, "
        "max(r.year) AS ultimo_ano, CAST(sum(1) AS BIGINT) AS qtd FROM crimes_raw r JOIN "
        "(SELECT iucr FROM (SELECT DISTINCT iucr, description FROM crimes_raw WHERE description IS NOT NULL) "
        "GROUP BY iucr HAVING count(*) > 1) d ON r.iucr = d.iucr GROUP BY 1, 2, 3, 4) g ORDER BY iucr NULLS LAST, primeiro_ano NULLS LAST, primary_type NULLS LAST, "
        "description NULLS LAST, fbi_code NULLS LAST LIMIT 30"),
    "prof_beat_inconsistent": f"SELECT count(*) AS beats_inconsistentes FROM ({_CONTRA_ROWS})",
    "prof_beat_pairs": f"SELECT * FROM ({_PAIRS}) ORDER BY qtd DESC, district, prefixo_beat LIMIT 20",
    "prof_coordinates": (
        "SELECT sem_coord, total, " + ratio_sql("sem_coord", "total") + " AS pct_sem_coord FROM "
        f"(SELECT {_nulls('latitude')} AS sem_coord, count(*) AS total FROM crimes_raw)"),
    "prof_beat_2012_share": (
        "SELECT qtd_desvios, qtd_fim_ano, " + ratio_sql("qtd_fim_ano", "qtd_desvios") + " AS pct_fim_ano FROM "
        "(SELECT CAST(coalesce(sum(qtd), 0) AS BIGINT) AS qtd_desvios, "
        "CAST(coalesce(sum(qtd) FILTER (WHERE ultimo_ano = '2012'), 0) AS BIGINT) AS qtd_fim_ano "
        f"FROM ({_PAIRS}))"),
}


# --- generic operators applied to the warehouse ---------------------------------------------

LATEST_PER_KEY = _latest("iucr", CRIME_ATTRS, "true")
ASOF_JOIN = ("SELECT o.id_ocorrencia, o.beat, o.data_hora_ocorrencia, coalesce(g.sk_geografia, '-1') AS sk_geografia, "
             "g.district FROM stg_crimes o LEFT JOIN dim_geografia g ON o.beat = g.beat "
             "AND o.data_hora_ocorrencia >= g.valido_de AND o.data_hora_ocorrencia < g.valido_ate")
SCD2_CURRENT = ("SELECT s.beat, s.district, s.dbt_valid_from, s.dbt_valid_to, c.district AS district_atual "
                "FROM snap_geografia s LEFT JOIN (SELECT * FROM snap_geografia WHERE dbt_valid_to IS NULL) c ON s.beat = c.beat")
SCD2_DIMENSION = (f"SELECT s.*, CASE WHEN s.dbt_valid_from = (SELECT min(dbt_valid_from) FROM snap_crime) THEN {BEGIN} "
                  f"ELSE s.dbt_valid_from END AS valido_de, coalesce(s.dbt_valid_to, {END}) AS valido_ate, "
                  "s.dbt_valid_to IS NULL AS flag_versao_atual FROM snap_crime s")
SCD2_FROM_EVENTS = (
    f"SELECT beat, district, data_hora_ocorrencia AS valido_de, coalesce(lead(data_hora_ocorrencia) OVER "
    f"(PARTITION BY beat ORDER BY data_hora_ocorrencia, id_ocorrencia), {END}) AS valido_ate FROM "
    "(SELECT beat, district, data_hora_ocorrencia, id_ocorrencia, lag(district) OVER "
    "(PARTITION BY beat ORDER BY data_hora_ocorrencia, id_ocorrencia) AS prev FROM stg_crimes "
    "WHERE beat IS NOT NULL AND district IS NOT NULL) WHERE prev IS NULL OR prev <> district")
INITCAP_WORDS = (f"SELECT primary_type, description, {INITCAP.format(c='primary_type')} AS nome_tipo, "
                 f"{INITCAP.format(c='description')} AS nome_descricao "
                 "FROM (SELECT DISTINCT primary_type, description FROM stg_crimes)")
SURROGATE_KEY = (f"SELECT id_ocorrencia, "
                 f"{sk('iucr', 'beat', 'flag_prisao', 'data_hora_ocorrencia', 'latitude')} AS sk FROM stg_crimes")
LANDING_CSV = "SELECT * FROM crimes_raw"


def _axis(dim: str, key: str, columns: str) -> str:
    return f"SELECT {columns}, {_COUNTS} FROM {dim} x, fct_ocorrencias f WHERE f.{key} = x.{key} GROUP BY {columns}"


WEEKDAY_PROFILE = _axis("dim_data", "sk_data", "numero_dia_semana, nome_dia_semana, flag_fim_de_semana")
WEEK_SERIES = _axis("dim_data", "sk_data", "ano, semana_do_ano, dia_do_ano")
NIGHT_PROFILE = _axis("dim_hora", "sk_hora", "flag_noturno, periodo_do_dia")
LOCATION_PROFILE = _axis("dim_local", "sk_local", "categoria_local, flag_local_publico")
MONTH_START_SERIES = (f"SELECT make_date(sk_mes // 100, sk_mes % 100, 1) AS primeiro_dia_mes, {_sum('qtd_ocorrencias')} AS ocorrencias "
                      "FROM fct_desempenho_mensal WHERE sk_mes IN (SELECT sk_mes FROM dim_mes) GROUP BY sk_mes")
_MEASURES = "qtd_ocorrencias", "qtd_prisoes", "qtd_domesticos", "qtd_sem_prisao"
MONTHLY_REGROUPED = ("SELECT sk_mes, sk_distrito, sk_tipo_crime, " + ", ".join(f"CAST(sum({m}) AS INTEGER) AS {m}" for m in _MEASURES)
                     + " FROM fct_desempenho_mensal GROUP BY ALL")
STG_LENIENT = "SELECT id_ocorrencia, CAST(data_hora_ocorrencia AS VARCHAR) AS data_hora_ocorrencia, hora_ocorrencia FROM stg_crimes"
UNIQUE_REGROUPED = f"SELECT CAST(count(*) AS BIGINT) AS linhas, CAST(count(DISTINCT (sk_mes, sk_distrito, sk_tipo_crime)) AS BIGINT) AS chaves FROM ({MONTHLY_REGROUPED}) m"

LANDING_QUARANTINE = """
SELECT CASE WHEN CAST(id AS BIGINT) % 101 = 3 THEN 'not in the landing layout' WHEN CAST(id AS BIGINT) % 103 = 4 THEN 'date is no timestamp'
    WHEN CAST(id AS BIGINT) % 107 = 5 THEN 'no date' ELSE 'staged' END AS reason, count(*) AS linhas
FROM crimes_raw GROUP BY 1"""
ANTI_JOIN = """
SELECT 'relationships_fct_ocorrencias_sk_geografia' AS test_name, 'fct_ocorrencias' AS model, 'sk_geografia' AS column_name,
  CAST(count(*) AS BIGINT) AS failures
FROM fct_ocorrencias WHERE sk_geografia IS NOT NULL AND sk_geografia NOT IN (SELECT sk_geografia FROM dim_geografia WHERE flag_versao_atual)"""
