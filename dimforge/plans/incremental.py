"""M15 / M12 incrementally: a run costs what has changed, not what is stored.

A run takes raw rows that are new or corrected, and ids that are deleted. Staging and the transaction fact are
kept by incident year, each year's current version in a folder of its own (``sources.versions``):

* the id index (``sources.keyindex``) says in which year an id of the change set is stored already;
* the years of new, corrected and deleted rows are staged again from their stored rows and the change set;
* what snapshots and dimensions need of staging (latest row per code, beat, located beat; location texts) is kept as a
  small summary per year, recomputed for changed years only and merged over all years;
* after the snapshot runs, the validity of every surrogate key is compared with the run before: (key, time range) pairs
  whose key has moved give the further years whose facts change;
* the fact of the changed years is looked up again, and the rows that changed give signed deltas of the additive
  measures (old rows minus, new rows plus), which are merged into the stored monthly grain (month, geography version,
  crime version). Codes change their current type without any row changing, so the report grain
  (month, district, type) is summed from that stored grain at the end.

One commit (``sources.commits``) names all folders of a run. Readers see the last commit; an attempt that fails leaves
files that nothing names, and can be repeated with the same ``as_of``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..operators.latest import latest_per_key
from ..operators.scd2 import snapshot_merge
from ..sources.commits import CommitLog
from ..sources.history import SnapshotRun
from ..sources.keyindex import KeyIndex
from ..sources.landing import CORRUPT
from ..sources.tables import materialize
from ..sources.versions import PART, read_parts, replaced, write_parts
from . import constants as K
from . import dims, facts
from .staging import stage_crimes, staged_and_quarantined
from .warehouse import CRIME_CHECK, CRIME_KEY, GEO_CHECK, GEO_KEY, Warehouse, crime_state, geo_state

ID = "id_ocorrencia"
TS = "data_hora_ocorrencia"
ORDER = ", ".join(f"{c} {t}" for c, t in ((TS, "timestamp_ntz"), (ID, "bigint")))
STAGING = ("id_ocorrencia bigint, case_number string, data_hora_ocorrencia timestamp_ntz, data_ocorrencia date, hora_ocorrencia int, data_atualizacao_fonte timestamp_ntz, "
           "iucr string, primary_type string, description string, fbi_code string, beat int, district int, ward int, community_area int, location_description string, "
           "block string, latitude decimal(12,8), longitude decimal(12,8), flag_prisao boolean, flag_domestico boolean")
FACT = ("sk_ocorrencia bigint, id_ocorrencia bigint, case_number string, sk_data int, sk_hora int, sk_crime string, sk_geografia string, sk_local string, sk_flags string, "
        "latitude decimal(12,8), longitude decimal(12,8), data_hora_ocorrencia timestamp_ntz, qtd_ocorrencia int, qtd_prisao int, qtd_domestico int")
MEASURES = ("qtd_ocorrencia", "qtd_prisao", "qtd_domestico")
GRAIN = ("sk_data", "sk_geografia", "sk_crime")  # sk_data: the month's first day
MONTHS = "sk_data int, sk_geografia string, sk_crime string, qtd_ocorrencia bigint, qtd_prisao bigint, qtd_domestico bigint"
# Rows of a year that can be the latest of a code, of a beat, of a beat with ward and area; its location texts.
SUMMARIES = {
    "crime": f"iucr string, primary_type string, description string, fbi_code string, {ORDER}",
    "geo": f"beat int, district int, {ORDER}",
    "beat": f"beat int, ward int, community_area int, {ORDER}",
    "local": "location_description string",
}
SMALL_DIMS = ("dim_local", "dim_crime", "dim_geografia", "dim_distrito", "dim_tipo_crime")


def year_part(day: Column) -> Column:
    """The part of an incident: its year inside the calendar, else 0."""
    return F.when(day.between(F.lit(K.CALENDAR_START), F.lit(K.CALENDAR_END)), F.year(day)).otherwise(0)


def summaries(stg: DataFrame) -> dict[str, DataFrame]:
    """What ``crime_state``, ``geo_state``, ``beat_attributes`` and ``dim_local`` need of staging, by part: their inputs cut to one row per key."""
    order = [TS, ID]
    return {
        "crime": latest_per_key(stg, [PART, CRIME_KEY], [*CRIME_CHECK, *order], order),
        "geo": latest_per_key(stg, [PART, GEO_KEY], [*GEO_CHECK, *order], order, where="district IS NOT NULL"),
        "beat": latest_per_key(stg, [PART, GEO_KEY], ["ward", "community_area", *order], order, where="ward IS NOT NULL AND community_area IS NOT NULL"),
        "local": stg.where("location_description IS NOT NULL").select(PART, "location_description").distinct(),
    }


def moved_ranges(old: DataFrame | None, new: DataFrame, sk: str, key: str) -> DataFrame:
    """(key, lo, hi): the times at which a key's surrogate key by ``new`` differs from that by ``old``, as half-open ranges.

    A surrogate key that is only in one of them counts with its whole validity, one in both with the parts by which
    its start or end moved. One row per version of either at most."""
    def cut(d: DataFrame, p: str) -> DataFrame:
        return d.where(F.col(sk) != K.UNKNOWN_KEY).select(F.col(sk).alias("_sk"), F.col(key).alias(f"_{p}k"), F.col("valido_de").alias(f"_{p}f"), F.col("valido_ate").alias(f"_{p}t"))

    if old is None:
        return cut(new, "n").select(F.col("_nk").alias("key"), F.col("_nf").alias("lo"), F.col("_nt").alias("hi"))
    both = cut(old, "o").join(cut(new, "n"), "_sk", "full_outer")
    whole = F.struct(F.coalesce("_of", "_nf").alias("lo"), F.coalesce("_ot", "_nt").alias("hi"))
    one_sided = F.col("_of").isNull() | F.col("_nf").isNull()
    start = F.struct(F.least("_of", "_nf").alias("lo"), F.greatest("_of", "_nf").alias("hi"))
    end = F.struct(F.least("_ot", "_nt").alias("lo"), F.greatest("_ot", "_nt").alias("hi"))
    ranges = F.when(one_sided, F.array(whole)).otherwise(F.array(start, end))
    return both.select(F.coalesce("_ok", "_nk").alias("key"), F.explode(ranges).alias("_r")).select("key", "_r.lo", "_r.hi").where("lo < hi")


def signed_deltas(before: DataFrame, after: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums of the additive measures by key over the rows ``after`` minus those over the rows ``before``, where one is not zero.

    A row that moves to another key is a minus under the old and a plus under the new one."""
    signed = after.select(*keys, *[F.col(m).cast("bigint").alias(m) for m in measures]).unionByName(before.select(*keys, *[(-F.col(m)).cast("bigint").alias(m) for m in measures]))
    some = F.lit(False)
    for m in measures:
        some = some | (F.col(m) != 0)
    return signed.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]).where(some)


def merged_deltas(stored: DataFrame, delta: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A stored additive grain after signed deltas (M12, D1): sums by key, partially aggregated.

    The first measure counts rows; a key without rows leaves the grain."""
    both = stored.select(*keys, *measures).unionByName(delta.select(*keys, *measures))
    return both.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]).where(F.col(measures[0]) != 0)


def by_month(fact: DataFrame) -> DataFrame:
    """Fact rows with their month's first day as date key; rows outside the calendar have no month."""
    month = (F.floor(F.col("sk_data") / 100) * 100 + 1).cast("int").alias("sk_data")
    return fact.where(F.col("sk_data") != K.UNKNOWN_INT).select(PART, month, "sk_geografia", "sk_crime", *MEASURES)


class IncrementalWarehouse:
    """A warehouse below ``root`` that is brought up to date run by run."""

    def __init__(self, spark: SparkSession, root: str, id_buckets: int = 256):
        """``id_buckets`` counts for a new warehouse; about one per 100 MB of ids (16 bytes each) is a good size."""
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, self.root)
        last = self.log.last()
        self.number, self.state = last if last else (-1, {"id_buckets": id_buckets, "attempts": [], "manifests": {}, "dims": None, "as_of": None, "years": []})

    # --- reading ---------------------------------------------------------------------------------
    def _parts(self, name: str, schema: str, parts=None) -> DataFrame:
        return read_parts(self.spark, f"{self.root}/{name}", self.state["manifests"].get(name, {}), schema, parts)

    @property
    def changed_years(self) -> list[int]:
        """The parts whose fact the last run has written."""
        return self.state["years"]

    @property
    def staging(self) -> DataFrame:
        return self._parts("stg_crimes", STAGING)

    @property
    def fact(self) -> DataFrame:
        """fct_ocorrencias, with its year as ``part``."""
        return self._parts("fct_ocorrencias", FACT)

    @property
    def monthly(self) -> DataFrame:
        """fct_desempenho_mensal."""
        return self.model("fct_desempenho_mensal")

    def model(self, name: str) -> DataFrame | None:
        """A snapshot history, a dimension or the monthly fact as of the last run; None before the first."""
        return self.spark.read.parquet(f"{self.root}/{self.state['dims']}/{name}/run") if self.state["dims"] else None

    # --- one run ---------------------------------------------------------------------------------
    def run(self, raw: DataFrame, run: SnapshotRun, deletes: DataFrame | None = None, on_duplicate: str = "update", lenient: bool = False, **options) -> IncrementalWarehouse:
        """Applies ``raw`` (new and corrected rows) and ``deletes`` (column id_ocorrencia), takes the snapshot run and commits.

        An id that is stored already is corrected, or with ``on_duplicate='error'`` fails the run, as a unique index would; an id
        that comes twice in ``raw`` always does. An id in both is deleted. Ids that are not stored are deleted in vain. The filters of ``run`` are
        applied to the latest row per code and per beat of each year, so they may name the key and the checked columns. The same
        ``as_of`` again is a no-op, an older one an error. ``options``: ``include_closed`` and ``regroup`` of the monthly fact, ``backdate_per_key`` of the versions.
        """
        if on_duplicate not in ("update", "error"):
            raise ValueError("on_duplicate is 'update' or 'error'")
        if self.state["as_of"] == run.as_of.isoformat(sep=" "):
            return self
        if self.state["as_of"] and dt.datetime.fromisoformat(self.state["as_of"]) > run.as_of:
            raise ValueError(f"a run at {run.as_of} is older than the last run ({self.state['as_of']})")
        attempt, committed = f"run{self.number + 1}-{uuid.uuid4().hex[:8]}", self.state
        self.state = {**committed, "manifests": dict(committed["manifests"])}
        try:
            return self._run(raw, run, deletes, on_duplicate, lenient, attempt, options)
        except BaseException:
            self.state = committed
            raise

    def _run(self, raw: DataFrame, run: SnapshotRun, deletes: DataFrame | None, on_duplicate: str, lenient: bool, attempt: str, options: dict) -> IncrementalWarehouse:
        change = self._change_set(raw, deletes, on_duplicate, lenient, attempt)
        stale = self._restaged(change, attempt)
        w = self._models(run, attempt, options)
        years = sorted(stale | self._moved_years(w))
        self._refacted(w, change, years, attempt)
        self._write_small(w)
        self.state |= {"attempts": [*self.state["attempts"], attempt], "dims": f"dims/{attempt}", "as_of": run.as_of.isoformat(sep=" "), "years": years}
        if not self.log.commit(self.number + 1, self.state):
            raise RuntimeError(f"another run was committed to {self.root} meanwhile; open the warehouse again and repeat this one")
        self.number += 1
        return self

    def _change_set(self, raw: DataFrame, deletes: DataFrame | None, on_duplicate: str, lenient: bool, attempt: str) -> dict:
        """The staged rows of the change set, its ids with the year they are stored in, and the years it touches."""
        staged = stage_crimes(raw, lenient=lenient)
        if CORRUPT in raw.columns:  # read by read_landing_checked: what cannot be staged is kept with the reason
            staged, bad = staged_and_quarantined(raw)
            bad.write.parquet(f"{self.root}/quarantine/{attempt}")
        staged = materialize(self.spark, staged.withColumn(PART, year_part(F.col("data_ocorrencia")).cast("int")), "change-set")
        gone = (deletes if deletes is not None else self.spark.createDataFrame([], f"{ID} bigint")).select(F.col(ID).cast("bigint").alias("key")).where("key IS NOT NULL").distinct()
        gone = materialize(self.spark, gone, "change-deletes")
        ids = staged.where(F.col(ID).isNotNull()).groupBy(F.col(ID).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        keys = ids.join(gone.withColumn("gone", F.lit(True)), "key", "full_outer").select("key", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("gone", F.lit(False)).alias("gone"))
        keys = materialize(self.spark, keys, "change-keys")
        twice = keys.where("n > 1").count()
        if twice:
            raise ValueError(f"stg_crimes: {twice} duplicated value(s) of unique key ({ID}) in the change set")
        self.index = KeyIndex(self.spark, f"{self.root}/ids", self.state["id_buckets"])
        known = materialize(self.spark, self.index.found(keys.select("key"), self.state["attempts"]), "change-known")
        if on_duplicate == "error":
            again = known.join(keys.where("n > 0 AND NOT gone"), "key", "left_semi").count()
            if again:
                raise ValueError(f"stg_crimes: {again} value(s) of unique key ({ID}) are stored already")
        staged = staged.join(broadcast_if_small(gone), staged[ID] == gone["key"], "left_anti")
        entries = keys.where("gone").select("key", F.lit(None).cast("int").alias("part")).unionByName(staged.where(F.col(ID).isNotNull()).select(F.col(ID).alias("key"), PART))
        self.index.append(entries, attempt)
        years = {r[0] for r in known.select(PART).union(staged.select(PART)).distinct().collect()}  # at most the calendar's years
        return {"staged": staged, "known": known, "years": years}

    def _restaged(self, change: dict, attempt: str) -> set[int]:
        """Writes the touched years' staging and summaries."""
        years, manifests = change["years"], self.state["manifests"]
        kept = self._parts("stg_crimes", STAGING, years)
        stale = change["known"].select(F.col("key").alias("_stale"))
        kept = kept.join(broadcast_if_small(stale), kept[ID] == stale["_stale"], "left_anti")
        new = write_parts(kept.unionByName(change["staged"]), f"{self.root}/stg_crimes", attempt, years, [TS]) if years else {}
        manifests["stg_crimes"] = replaced(manifests.get("stg_crimes", {}), years, new)
        for name, df in summaries(self._parts("stg_crimes", STAGING, years)).items() if years else ():
            at = f"summary_{name}"
            new = write_parts(df, f"{self.root}/{at}", attempt, years)
            manifests[at] = replaced(manifests.get(at, {}), years, new)
        return years

    def _models(self, run: SnapshotRun, attempt: str, options: dict) -> Warehouse:
        """The snapshot runs and the dimensions, from the summaries of all years."""
        of = {name: self._parts(f"summary_{name}", schema) for name, schema in SUMMARIES.items()}
        w = Warehouse(self.spark, None, (), out_root=f"{self.root}/dims/{attempt}", preset={"stg_crimes": of["local"]}, **options)
        w.snap_crime = w._m("snap_crime", snapshot_merge(crime_state(of["crime"], run.crime_filter), CRIME_KEY, CRIME_CHECK, run.as_of, self.model("snap_crime")))
        w.snap_geografia = w._m("snap_geografia", snapshot_merge(geo_state(of["geo"], run.geo_filter), GEO_KEY, GEO_CHECK, run.as_of, self.model("snap_geografia")))
        w.dim_geografia = w._m("dim_geografia", dims.dim_geografia(w.snap_geografia, of["beat"], w.backdate_per_key))
        return w

    def _moved_years(self, w: Warehouse) -> set[int]:
        """Stored years with rows in a time range whose surrogate keys have moved; the ranges stay with the run."""
        self.moved = {key: materialize(self.spark, moved_ranges(self.model(name), getattr(w, name), sk, key), f"moved-{key}")
                      for name, sk, key in (("dim_crime", "sk_crime", CRIME_KEY), ("dim_geografia", "sk_geografia", GEO_KEY))}
        stored = sorted(int(p) for p in self.state["manifests"].get("stg_crimes", {}))
        out: set[int] = set()
        for ranges in self.moved.values():
            for r in ranges.select(F.year("lo").alias("lo"), F.year("hi").alias("hi")).distinct().collect():  # at most the pairs of run years
                out |= {p for p in stored if p == 0 or r.lo <= p <= r.hi}
        return out

    def _refacted(self, w: Warehouse, change: dict, years: list[int], attempt: str) -> None:
        """Writes the fact of ``years`` and merges the deltas of its changed rows into the monthly grain."""
        manifests = self.state["manifests"]
        if not years:
            return
        before, before_any = self._parts("fct_ocorrencias", FACT, years), bool(manifests.get("fct_ocorrencias"))
        stg = self._parts("stg_crimes", STAGING, years)
        fact = facts.fct_ocorrencias(stg, w.dim_data, w.dim_hora, w.dim_local, w.dim_flags, w.dim_crime, w.dim_geografia)
        fact = fact.withColumnRenamed(facts.YEAR, PART)
        new = write_parts(fact, f"{self.root}/fct_ocorrencias", attempt, years, cluster=facts.access_order(), lookup=[ID])
        manifests["fct_ocorrencias"] = replaced(manifests.get("fct_ocorrencias", {}), years, new)
        after = self._parts("fct_ocorrencias", FACT, years)
        if before_any:
            changed = change["staged"].where(F.col(ID).isNotNull()).select(F.col(ID).alias("key")).unionByName(change["known"].select("key"))
            for key, ranges in self.moved.items():
                r = ranges.select(F.col("key").alias("_k"), "lo", "hi")
                inside = (stg[key] == r["_k"]) & (stg[TS] >= r["lo"]) & (stg[TS] < r["hi"])
                changed = changed.unionByName(stg.join(broadcast_if_small(r), inside, "left_semi").select(F.col(ID).alias("key")))
            changed = materialize(self.spark, changed.distinct(), "changed-rows")
            # rows without an id (lenient staging) cannot be told from one another: all of them count as changed
            before, after = (f.join(broadcast_if_small(changed), f[ID] == changed["key"], "left_semi").unionByName(f.where(F.col(ID).isNull())) for f in (before, after))
        delta = materialize(self.spark, signed_deltas(by_month(before), by_month(after), (PART, *GRAIN), MEASURES), "deltas")
        touched = sorted(r[0] for r in delta.select(PART).distinct().collect())
        if touched:
            months = merged_deltas(self._parts("months", MONTHS, touched), delta, (PART, *GRAIN), MEASURES)
            manifests["months"] = replaced(manifests.get("months", {}), touched, write_parts(months, f"{self.root}/months", attempt, touched, ["sk_data"]))

    def _write_small(self, w: Warehouse) -> None:
        """The remaining dimensions, and the monthly report grain from the stored one."""
        w._m("fct_desempenho_mensal", facts.fct_desempenho_mensal(self._parts("months", MONTHS), w.dim_data, w.dim_geografia, w.dim_crime, w.dim_mes, w.dim_distrito,
                                                                  w.dim_tipo_crime, w.include_closed, w.regroup), sort_within=["sk_mes"])
        for name in SMALL_DIMS:
            getattr(w, name)
