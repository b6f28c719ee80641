"""Command line: the warehouse's run order as commands.

  python -m dimforge build   --raw <csv path/glob> --root <warehouse> [--as-of 'YYYY-MM-DD HH:MM:SS'] [--lenient]
                             [--regroup] [--include-closed] [--unknown-day] [--backdate-per-key]
  python -m dimforge update  --raw <csv path/glob> --root <incremental warehouse> [--deletes <csv with id_ocorrencia>]
                             [--error-on-duplicate] and the options of build
  python -m dimforge sql     --root <warehouse> "SELECT ... FROM fct_ocorrencias ..."
  python -m dimforge test    --root <warehouse>
  python -m dimforge profile --raw <csv path/glob>
  python -m dimforge report  --root <warehouse> {p1,p2,pick-district,pick-type} [--year-from --year-to
                             --district --crime-type] [--rollup] [--out <dir>]

``build`` stages the raw file, appends one snapshot run to each persisted history and
writes every model under ``<root>/<model>/as_of=<as_of>``; the other commands read the
latest run (``sql`` sees each model as a view). ``update`` keeps a warehouse of its own that costs what changes
(``plans.incremental``): new and corrected rows, deleted ids. With ``--lenient`` lines that cannot be staged go
to a quarantine table. Results are printed (or written as Parquet with ``--out``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    return SparkSession.builder.appName("dimforge").getOrCreate()


def _emit(df, out: str | None = None) -> None:
    """Writes the result, or prints all its rows, tab-separated, one partition at a time."""
    if out:
        df.write.mode("overwrite").parquet(out)
        return
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from .plans import profiling as P
    from .plans import quality as Q
    from .plans import reports as R
    from .plans.warehouse import build_run, open_run
    from .plans.incremental import IncrementalWarehouse
    from .sources.history import SnapshotRun
    from .sources.landing import read_landing, read_landing_checked

    ap = argparse.ArgumentParser(prog="dimforge", description="Incident warehouse on Spark.")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="land + stage the raw text, one snapshot run, all marts")
    b.add_argument("--raw", required=True)
    b.add_argument("--root", required=True)
    b.add_argument("--as-of", default=None)
    u = sub.add_parser("update", help="bring an incremental warehouse up to date with new, corrected and deleted rows")
    u.add_argument("--raw", required=True)
    u.add_argument("--root", required=True)
    u.add_argument("--as-of", default=None)
    u.add_argument("--deletes")
    u.add_argument("--error-on-duplicate", action="store_true")
    options = ("regroup", "include_closed", "unknown_day", "backdate_per_key")
    for x in (b, u):
        x.add_argument("--lenient", action="store_true")
        for o in options:
            x.add_argument("--" + o.replace("_", "-"), action="store_true")
    q = sub.add_parser("sql", help="a query over the latest run's models")
    q.add_argument("--root", required=True)
    q.add_argument("query")
    q.add_argument("--out")
    t = sub.add_parser("test", help="the 66 data tests on the latest run")
    t.add_argument("--root", required=True)
    t.add_argument("--out")
    p = sub.add_parser("profile", help="the 12 profiling questions on the raw text")
    p.add_argument("--raw", required=True)
    r = sub.add_parser("report", help="report datasets (P1, P2) and their pickers")
    r.add_argument("--root", required=True)
    r.add_argument("which", choices=["p1", "p2", "pick-district", "pick-type"])
    r.add_argument("--year-from", type=int, default=2020)
    r.add_argument("--year-to", type=int, default=2025)
    r.add_argument("--district", type=int, default=1)
    r.add_argument("--crime-type", default="THEFT")
    r.add_argument("--rollup", action="store_true")
    r.add_argument("--out")
    a = ap.parse_args(argv)
    spark = spark or _session()

    if a.cmd in ("build", "update"):
        as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else dt.datetime.now().replace(microsecond=0)
        raw, chosen = (read_landing_checked if a.lenient else read_landing)(spark, a.raw), {o: getattr(a, o) for o in options}
    if a.cmd == "build":
        w = build_run(spark, raw, a.root, as_of, lenient=a.lenient, **chosen)
        print(f"built run as_of={as_of}: {w.fct_ocorrencias.count()} incidents")
    elif a.cmd == "update":
        deletes = spark.read.schema("id_ocorrencia long").option("header", "true").csv(a.deletes) if a.deletes else None
        w = IncrementalWarehouse(spark, a.root).run(raw, SnapshotRun(as_of), deletes, "error" if a.error_on_duplicate else "update", a.lenient, **chosen)
        print(f"run {w.number} as_of={as_of}: {w.fact.count()} incidents, wrote years {w.changed_years}")
    elif a.cmd == "sql":
        open_run(spark, a.root).create_views()
        _emit(spark.sql(a.query), a.out)
    elif a.cmd == "test":
        res = Q.run(open_run(spark, a.root))
        _emit(res, a.out)
        if not a.out:
            failing = res.where("failures > 0").count()
            print(f"{len(Q.SUITE)} tests, {failing} failing")
    elif a.cmd == "profile":
        raw = read_landing(spark, a.raw)
        for name in ["prof_total", "prof_by_year", "prof_cardinality", "prof_nulls", "prof_ward_coverage",
                     "prof_iucr_combos", "prof_iucr_varies", "prof_description_drift", "prof_beat_inconsistent",
                     "prof_beat_pairs", "prof_coordinates", "prof_beat_2012_share"]:
            print(name)
            _emit(getattr(P, name)(raw))
    elif a.cmd == "report":
        w = open_run(spark, a.root)
        if a.which == "p1":
            f = R.report_p1_rollup if a.rollup else R.report_p1
            df = f(w, year_from=a.year_from, year_to=a.year_to, district=a.district)
        elif a.which == "p2":
            f = R.report_p2_rollup if a.rollup else R.report_p2
            df = f(w, year_from=a.year_from, year_to=a.year_to, crime_type=a.crime_type)
        elif a.which == "pick-district":
            df = R.pick_district(w)
        else:
            df = R.pick_type(w)
        _emit(df, a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
