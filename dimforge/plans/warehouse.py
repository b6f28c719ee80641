"""The warehouse build - staging -> snapshots -> dimensions -> facts.

Models are plain DataFrames passed along (no scheduler). With ``materialize=True`` every
model is written as Parquet below the shared checkpoint root and read back, which cuts
lineage (lost executors re-read files instead of recomputing upstream), gives the
broadcast size checks real row counts at the cost of reading a few small files, and
mirrors the original's table materialisation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import remember_row_count
from ..operators.latest import latest_per_key
from ..operators.scd2 import replay_indexed, run_states, snapshot_merge
from ..sources.fixture import FIXTURE_RUNS, crimes_raw
from ..sources.history import HistoryStore, SnapshotRun, run_snapshot
from ..sources.landing import CORRUPT
from ..sources.tables import assert_unique
from ..sources.tables import materialize as _materialize
from ..sources.tables import as_view, write_observed, write_table
from . import dims, facts
from .staging import stage_crimes, staged_and_quarantined

LATEST_ORDER = dims.LATEST_ORDER

# Natural key and checked columns of the two snapshots.
CRIME_KEY, CRIME_CHECK = "iucr", ["primary_type", "description", "fbi_code"]
GEO_KEY, GEO_CHECK = "beat", ["district"]


# Rows a snapshot's source state is taken from, besides a non-NULL key.
STATE_WHERE = {GEO_KEY: "district IS NOT NULL"}


def crime_state(stg: DataFrame, where: str = "true") -> DataFrame:
    """Current wording per code (snap_crime source): latest incident per IUCR."""
    return latest_per_key(stg, CRIME_KEY, CRIME_CHECK, LATEST_ORDER, where=f"({where})")


def geo_state(stg: DataFrame, where: str = "true") -> DataFrame:
    """Current district per beat (snap_geografia source): latest incident having one."""
    return latest_per_key(stg, GEO_KEY, GEO_CHECK, LATEST_ORDER, where=f"{STATE_WHERE[GEO_KEY]} AND ({where})")


def fold_snapshots(stg: DataFrame, runs, key: str, check: list[str], state_fn, filt) -> DataFrame:
    """Apply the runs one after another with ``snapshot_merge`` (what repeated runs do)."""
    hist = None
    for r in runs:
        hist = snapshot_merge(state_fn(stg, filt(r)), key, check, r.as_of, history=hist)
    return hist


def replay_snapshots(stg: DataFrame, runs, key: str, check: list[str], state_fn, filt) -> DataFrame:
    """All runs in one job - one scan of staging for all run states (``run_states``), then
    the window replay; same rows as ``fold_snapshots``."""
    where = STATE_WHERE.get(key)
    states = run_states(stg, [filt(r) for r in runs], key, check, LATEST_ORDER, where=where)
    return replay_indexed(states, [r.as_of for r in runs], key, check)


def _known(df: DataFrame, rows: int) -> DataFrame:
    remember_row_count(df, rows)
    return df


class Warehouse:
    """Lazily built models of one warehouse instance."""

    def __init__(
        self,
        spark: SparkSession,
        raw: DataFrame,
        runs: Sequence[SnapshotRun],
        history: str = "replay",
        materialize: bool = False,
        lenient: bool = False,
        backdate_per_key: bool = False,
        include_closed: bool = False,
        regroup: bool = False,
        unknown_day: bool = False,
        out_root: str | None = None,
        run_label: str | None = None,
        preset: dict[str, DataFrame] | None = None,
    ):
        """``runs`` are the snapshot runs to take (none if ``preset`` has both histories).
        ``include_closed``, ``regroup`` and ``unknown_day`` choose the documented intent over the original's
        behaviour (closed districts keep their key, unique monthly grain, a -1 day). ``preset`` supplies already built models by name (e.g. persisted snapshot
        histories instead of computing them from ``runs``); ``out_root`` writes every model
        to ``<out_root>/<model>/<run_label>`` (a new folder per run, never one that is being
        read) instead of scratch space."""
        self.spark = spark
        self.raw = raw
        self.runs = tuple(runs)
        self.history = history
        self.materialize = materialize or out_root is not None
        self.lenient = lenient
        self.backdate_per_key = backdate_per_key
        self.include_closed, self.regroup, self.unknown_day = include_closed, regroup, unknown_day
        self.out_root = out_root.rstrip("/") if out_root else None
        self.run_label = run_label or "run"
        for name, df in (preset or {}).items():
            self.__dict__["stg" if name == "stg_crimes" else name] = df  # seeds the cached property

    @classmethod
    def from_sf(cls, spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
        """The test data's warehouse, with the test data's snapshot runs unless others are given."""
        raw = crimes_raw(spark, sf_dir)
        if kw.get("materialize"):
            raw = _materialize(spark, raw, "crimes_raw")
        return cls(spark, raw, kw.pop("runs", FIXTURE_RUNS), **kw)

    def _m(self, name: str, df: DataFrame, sort_within=None, partition_by=None, cluster=None, lookup=(), is_dealt=False) -> DataFrame:
        if self.out_root is not None:
            path = f"{self.out_root}/{name}/{self.run_label}"
            return write_observed(self.spark, df, path, "overwrite", sort_within, partition_by, cluster, lookup, is_dealt)  # a retry replaces its folder
        return _materialize(self.spark, df, name, sort_within, partition_by, cluster, lookup, is_dealt) if self.materialize else df

    def _snapshots(self, key, check, state_fn, filt) -> DataFrame:
        f = replay_snapshots if self.history == "replay" else fold_snapshots
        return f(self.stg, self.runs, key, check, state_fn, filt)

    @cached_property
    def stg(self) -> DataFrame:
        return self._m("stg_crimes", stage_crimes(self.raw, lenient=self.lenient))

    @cached_property
    def snap_crime(self) -> DataFrame:
        return self._m("snap_crime", self._snapshots(CRIME_KEY, CRIME_CHECK, crime_state, lambda r: r.crime_filter))

    @cached_property
    def snap_geografia(self) -> DataFrame:
        return self._m("snap_geografia", self._snapshots(GEO_KEY, GEO_CHECK, geo_state, lambda r: r.geo_filter))

    # Generated dimensions: fixed size, nothing to cut; their exact sizes are recorded for
    # the broadcast checks instead of being counted.
    @cached_property
    def dim_data(self) -> DataFrame:
        return _known(dims.dim_data(self.spark, self.unknown_day), facts.CALENDAR_ROWS + self.unknown_day)

    @cached_property
    def dim_hora(self) -> DataFrame:
        return _known(dims.dim_hora(self.spark), 25)

    @cached_property
    def dim_flags(self) -> DataFrame:
        return _known(dims.dim_flags(self.spark), 4)

    @cached_property
    def dim_local(self) -> DataFrame:
        return self._m("dim_local", dims.dim_local(self.stg))

    @cached_property
    def dim_crime(self) -> DataFrame:
        return self._m("dim_crime", dims.dim_crime(self.snap_crime, self.backdate_per_key))

    @cached_property
    def dim_geografia(self) -> DataFrame:
        return self._m("dim_geografia", dims.dim_geografia(self.snap_geografia, self.stg, self.backdate_per_key))

    @cached_property
    def dim_mes(self) -> DataFrame:
        return _known(dims.dim_mes(self.dim_data), facts.CALENDAR_MONTHS)

    @cached_property
    def dim_distrito(self) -> DataFrame:
        return self._m("dim_distrito", dims.dim_distrito(self.dim_geografia))

    @cached_property
    def dim_tipo_crime(self) -> DataFrame:
        return self._m("dim_tipo_crime", dims.dim_tipo_crime(self.dim_crime))

    @cached_property
    def fct_ocorrencias(self) -> DataFrame:
        deal = self.materialize and facts.lookups_fit(self.dim_local, self.dim_crime, self.dim_geografia)
        return self._m(
            "fct_ocorrencias",
            facts.fct_ocorrencias(self.stg, self.dim_data, self.dim_hora, self.dim_local, self.dim_flags,
                                  self.dim_crime, self.dim_geografia, deal),
            is_dealt=deal,
            partition_by=facts.YEAR,  # date ranges open only their years' files
            cluster=facts.access_order(),  # dates, places and codes prune row groups inside a year
            lookup=["id_ocorrencia"],  # as do single ids
        )

    @cached_property
    def fct_desempenho_mensal(self) -> DataFrame:
        return self._m(
            "fct_desempenho_mensal",
            facts.fct_desempenho_mensal(self.fct_ocorrencias, self.dim_data, self.dim_geografia, self.dim_crime,
                                        self.dim_mes, self.dim_distrito, self.dim_tipo_crime,
                                        self.include_closed, self.regroup),
            sort_within=["sk_mes"],
        )

    def tables(self) -> dict[str, DataFrame]:
        names = ["stg_crimes", "snap_crime", "snap_geografia", "dim_data", "dim_hora", "dim_local", "dim_flags",
                 "dim_crime", "dim_geografia", "dim_mes", "dim_distrito", "dim_tipo_crime",
                 "fct_ocorrencias", "fct_desempenho_mensal"]
        return {n: getattr(self, "stg" if n == "stg_crimes" else n) for n in names}

    def create_views(self) -> list[str]:
        """Every model as a session view under its name, for Spark SQL; returns the names."""
        return [as_view(df, name) and name for name, df in self.tables().items()]

    # Models in dependency waves: everything inside a wave is independent.
    WAVES = (
        ("stg",),
        ("snap_crime", "snap_geografia", "dim_data", "dim_hora", "dim_flags"),
        ("dim_local", "dim_crime", "dim_geografia", "dim_mes"),
        ("dim_distrito", "dim_tipo_crime", "fct_ocorrencias"),
        ("fct_desempenho_mensal",),
    )

    def build(self, threads: int = 1, waves=None) -> dict[str, DataFrame]:
        """Build (and, when enabled, materialise) every model in dependency order.

        ``threads > 1`` submits the independent models of a wave as concurrent Spark jobs
        (the original ran independent models on 4 threads); Spark's scheduler shares the
        executors between them.
        """
        built = {}
        for wave in waves or self.WAVES:
            dfs = run_concurrently([lambda n=n: getattr(self, n) for n in wave], threads)
            built.update(zip(wave, dfs))
        return built


def run_concurrently(fns, threads: int = 4) -> list:
    """Run independent Spark actions from a small thread pool; results in input order."""
    if threads <= 1 or len(fns) <= 1:
        return [f() for f in fns]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(lambda f: f(), fns))


MODELS = ("stg_crimes", "dim_local", "dim_crime", "dim_geografia", "dim_distrito", "dim_tipo_crime",
          "fct_ocorrencias", "fct_desempenho_mensal")


def open_run(spark: SparkSession, root: str, as_of: dt.datetime | None = None) -> Warehouse:
    """Reopen a warehouse built by ``build_run`` (latest run unless ``as_of`` is given)."""
    root = root.rstrip("/")
    crime, geo = HistoryStore(spark, f"{root}/snap_crime"), HistoryStore(spark, f"{root}/snap_geografia")
    as_of = as_of or crime.last_as_of()
    if as_of is None:
        raise ValueError(f"no committed run below {root}")
    label = f"as_of={as_of:%Y%m%d%H%M%S}"
    preset = {name: spark.read.parquet(f"{root}/{name}/{label}") for name in MODELS}
    preset.update(snap_crime=crime.at_run(crime.run_at(as_of)), snap_geografia=geo.at_run(geo.run_at(as_of)))
    raw = spark.read.parquet(f"{root}/crimes_raw/{label}")
    return Warehouse(spark, raw, (), out_root=root, run_label=label, preset=preset)


# Unique keys enforced on write (the original's unique indexes).
UNIQUE_KEYS = {"stg_crimes": ["id_ocorrencia"], "dim_crime": ["sk_crime"], "dim_geografia": ["sk_geografia"],
               "fct_ocorrencias": ["id_ocorrencia"]}


def build_run(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    as_of: dt.datetime,
    lenient: bool = False,
    enforce_unique: bool = True,
    threads: int = 4,
    **options,
) -> Warehouse:
    """M15, production path: one incremental run of the whole warehouse.

    landing table + staging (full reload of the raw text) -> one snapshot run appended to
    each persisted history (``<root>/snap_crime``, ``<root>/snap_geografia``) -> dimensions
    and facts from
    the latest histories, each written to ``<root>/<model>/as_of=<as_of>``. Re-running the
    same ``as_of`` after a failure is safe: its folders are replaced and the snapshot runs
    are not repeated. ``enforce_unique`` fails the build on a duplicated unique key, as a
    unique index would. Independent models are built as concurrent jobs (``threads``).
    ``options`` go to ``Warehouse``. Lines of a table from ``landing.read_landing_checked`` that cannot be staged are written
    to ``<root>/quarantine/as_of=<as_of>`` with the reason.
    Run the data tests with ``plans.quality.run`` on the result.
    """
    label = f"as_of={as_of:%Y%m%d%H%M%S}"
    root = root.rstrip("/")
    raw_path = f"{root}/crimes_raw/{label}"  # the landing table (full reload per run)
    write_table(raw, raw_path)  # full reload; a retry replaces its folder
    raw = spark.read.parquet(raw_path)
    staged = stage_crimes(raw, lenient=lenient)
    if CORRUPT in raw.columns:
        staged, bad = staged_and_quarantined(raw)
        write_table(bad, f"{root}/quarantine/{label}")
    stg_path = f"{root}/stg_crimes/{label}"
    write_table(staged, stg_path)
    stg = spark.read.parquet(stg_path)
    if enforce_unique:
        assert_unique(stg, UNIQUE_KEYS["stg_crimes"], "stg_crimes")
    crime = run_snapshot(HistoryStore(spark, f"{root}/snap_crime"), crime_state(stg), CRIME_KEY, CRIME_CHECK, as_of)
    geo = run_snapshot(HistoryStore(spark, f"{root}/snap_geografia"), geo_state(stg), GEO_KEY, GEO_CHECK, as_of)
    w = Warehouse(spark, raw, (), lenient=lenient, **options, out_root=root, run_label=label,
                  preset={"stg_crimes": stg, "snap_crime": crime, "snap_geografia": geo})
    built = w.build(threads, waves=Warehouse.WAVES[2:])
    if enforce_unique:
        run_concurrently([lambda n=n: assert_unique(built[n], UNIQUE_KEYS[n], n)
                          for n in UNIQUE_KEYS if n in built], threads)
    return w
