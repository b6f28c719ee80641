"""Profiling jobs on the raw text table.

Each question is one aggregation (partial aggregation map-side, one small shuffle).
Several exact distinct counts in one ``agg`` are planned by Catalyst with a single
Expand; the columns are low-cardinality so the expanded partial aggregates stay small.
Casts guarded by a regex use ``try_cast`` so ANSI mode never raises if the optimizer
reorders the conjuncts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio_pct

DIGITS = r"^\d+$"


def _year_range_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: first / last year (text order, as in the source) and row count.

    Counted per (group, year) first - a hash aggregation with fixed-width buffers over the
    big input - so the text min/max (sort-based aggregation) only sees the few
    (group, year) rows that remain.
    """
    per_year = df.groupBy(*keys, "year").agg(F.count(F.lit(1)).alias("_n"))
    return per_year.groupBy(*keys).agg(
        F.min("year").alias("primeiro_ano"), F.max("year").alias("ultimo_ano"), F.sum("_n").alias("qtd"))


def prof_total(raw: DataFrame) -> DataFrame:
    """Total rows."""
    return raw.agg(F.count(F.lit(1)).alias("total_registros"))


def prof_by_year(raw: DataFrame) -> DataFrame:
    """R2: rows per year text."""
    return raw.groupBy("year").agg(F.count(F.lit(1)).alias("qtd")).orderBy("year")


# Result names of the distinct counts and the columns they count.
CARDINALITY = {
    "tipos": "primary_type", "iucr": "iucr", "descricoes": "description", "fbi": "fbi_code",
    "locais": "location_description", "beats": "beat", "distritos": "district", "wards": "ward",
    "areas": "community_area",
}


def prof_cardinality(raw: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct counts of nine columns.

    Exact by default: the distinct values of one column each, so no row is expanded, each scan reads its column alone, and a
    shuffle carries a column's distinct values once per task. ``approx=True`` uses HyperLogLog++ in one pass instead: fixed-size
    state, relative error ~``rsd``. ``cardinality_sketches`` are for totals that are kept up to date.
    """
    if approx:
        return raw.agg(*[F.approx_count_distinct(c, rsd).alias(a) for a, c in CARDINALITY.items()])
    values = None
    for a, c in CARDINALITY.items():
        own = raw.where(F.col(c).isNotNull()).select(F.lit(a).alias("a"), F.col(c).cast("string").alias("v")).distinct()
        values = own if values is None else values.union(own)
    return values.agg(*[F.count_if(F.col("a") == a).alias(a) for a in CARDINALITY])


def cardinality_sketches(rows: DataFrame, by: str, log2_size: int = 14) -> DataFrame:
    """One row per value of ``by`` with a mergeable sketch of each of the nine columns (NULLs do not count)."""
    return rows.groupBy(by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), log2_size).alias(a) for a, c in CARDINALITY.items()])


def merged_cardinality(sketches: DataFrame) -> DataFrame:
    """The nine distinct counts over all rows of ``cardinality_sketches``, without the rows they were taken from."""
    return sketches.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(a)), F.lit(0)).cast("long").alias(a) for a in CARDINALITY])


def prof_nulls(raw: DataFrame) -> DataFrame:
    """Duplicate ids and NULL counts of five columns."""
    return raw.agg(
        (F.count(F.lit(1)) - F.countDistinct("id")).alias("ids_duplicados"),
        F.count_if(F.col("latitude").isNull()).alias("sem_coord"),
        F.count_if(F.col("district").isNull()).alias("sem_distrito"),
        F.count_if(F.col("ward").isNull()).alias("sem_ward"),
        F.count_if(F.col("community_area").isNull()).alias("sem_area"),
        F.count_if(F.col("location_description").isNull()).alias("sem_local_desc"),
    )


def prof_ward_coverage(raw: DataFrame) -> DataFrame:
    """NULL wards per year, only years that have some."""
    return (
        raw.groupBy("year")
        .agg(F.count_if(F.col("ward").isNull()).alias("sem_ward"), F.count(F.lit(1)).alias("total"))
        .where(F.col("sem_ward") > 0)
        .orderBy("year")
    )


def prof_iucr_combos(raw: DataFrame) -> DataFrame:
    """Codes with more than one (type | text | class) combination (NULL-propagating
    concatenation, so a NULL part drops the combination, like SQL ``||``)."""
    combo = F.concat(F.col("primary_type"), F.lit("|"), F.col("description"), F.lit("|"), F.col("fbi_code"))
    per = raw.groupBy("iucr").agg(F.countDistinct(combo).alias("n")).where(F.col("n") > 1)
    return per.agg(F.count(F.lit(1)).alias("iucr_com_mais_de_uma_combinacao"))


def prof_iucr_varies(raw: DataFrame) -> DataFrame:
    """Which attribute varies within a code (functional-dependency check).

    The rows collapse to their distinct combinations before the shuffle, without being expanded once per attribute.
    """
    attrs = {"iucr_varia_primary_type": "primary_type", "iucr_varia_description": "description", "iucr_varia_fbi_code": "fbi_code"}
    # counted, as the optimizer would drop a mere distinct below the least and greatest and sort every row for them
    combos = raw.groupBy("iucr", *attrs.values()).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    # more than one value (NULL is none): the least and the greatest differ
    per = combos.groupBy("iucr").agg(*[(F.min(c) != F.max(c)).alias(a) for a, c in attrs.items()])
    return per.agg(*[F.count_if(F.col(a)).alias(a) for a in attrs])


def prof_description_drift(raw: DataFrame, top: int = 30) -> DataFrame:
    """Spellings per code with their year range - first ``top`` (the report limit).

    The raw rows are counted once per (spelling, year); which codes drift, and their spellings,
    both come from those few rows. Ties after (code, first year) are broken by the remaining
    keys so the cut is stable.
    """
    keys = ["iucr", "primary_type", "description", "fbi_code"]
    counted = raw.groupBy(*keys, "year").agg(F.count(F.lit(1)).alias("_n"))
    spellings = counted.groupBy(*keys).agg(F.min("year").alias("primeiro_ano"), F.max("year").alias("ultimo_ano"), F.sum("_n").alias("qtd"))
    # more than one description (NULL is none): the least and the greatest differ; few spellings a code
    differ = Window.partitionBy("iucr")
    drifting = spellings.withColumn("_lo", F.min("description").over(differ)).withColumn("_hi", F.max("description").over(differ)).where("iucr IS NOT NULL AND _lo <> _hi")
    return (
        drifting.select(*spellings.columns)
        .orderBy(F.col("iucr").asc_nulls_last(), F.col("primeiro_ano").asc_nulls_last(),
                 *[F.col(c).asc_nulls_last() for c in keys[1:]])
        .limit(top)
    )


def _beat_contradictions(raw: DataFrame) -> DataFrame:
    d, b = F.col("district"), F.col("beat")
    beat_prefix = F.expr("try_cast(beat AS INT) div 100")
    return raw.where(d.rlike(DIGITS) & b.rlike(DIGITS) & (d.try_cast("int") != beat_prefix))


def prof_beat_inconsistent(raw: DataFrame) -> DataFrame:
    """Rows whose beat prefix contradicts the district (hierarchy test)."""
    return _beat_contradictions(raw).agg(F.count(F.lit(1)).alias("beats_inconsistentes"))


def _beat_pairs(raw: DataFrame) -> DataFrame:
    pairs = _beat_contradictions(raw).select(
        "district", F.substring(F.lpad("beat", 4, "0"), 1, 2).alias("prefixo_beat"), "year")
    return _year_range_counts(pairs, ["district", "prefixo_beat"])


def prof_beat_pairs(raw: DataFrame, top: int = 20) -> DataFrame:
    """Contradicting district / beat-prefix pairs with year range, top ``top``."""
    return _beat_pairs(raw).orderBy(F.col("qtd").desc(), "district", "prefixo_beat").limit(top)


def prof_coordinates(raw: DataFrame) -> DataFrame:
    """Incidents without coordinates and their share (exact decimal)."""
    return raw.agg(
        F.count_if(F.col("latitude").isNull()).alias("sem_coord"), F.count(F.lit(1)).alias("total")
    ).select("sem_coord", "total", ratio_pct(F.col("sem_coord"), F.col("total")).alias("pct_sem_coord"))


def prof_beat_2012_share(raw: DataFrame, last_year: str = "2012") -> DataFrame:
    """Share of contradicting rows that belong to pairs ending in ``last_year``."""
    p = _beat_pairs(raw)
    return p.agg(
        F.coalesce(F.sum("qtd"), F.lit(0).cast("bigint")).alias("qtd_desvios"),
        F.coalesce(F.sum(F.when(F.col("ultimo_ano") == last_year, F.col("qtd")).otherwise(0)),
                   F.lit(0).cast("bigint")).alias("qtd_fim_ano"),
    ).select("qtd_desvios", "qtd_fim_ano", ratio_pct(F.col("qtd_fim_ano"), F.col("qtd_desvios")).alias("pct_fim_ano"))
