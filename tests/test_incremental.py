"""Incremental runs: equal to a rebuild, whatever is new, corrected, moved or deleted; only what changed is written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, raw_rows, row
from dimforge.plans.incremental import GRAIN, MEASURES, IncrementalWarehouse, merged_deltas, moved_ranges, signed_deltas
from dimforge.plans.registry import incremental_fixture
from dimforge.plans.warehouse import Warehouse
from dimforge.sources.fixture import FIXTURE_RUNS
from dimforge.sources.history import SnapshotRun

T1, T2, T3 = (dt.datetime(y, 1, 1) for y in (2011, 2012, 2013))


def same(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_three_runs_equal_a_rebuild_and_write_only_their_years(spark, tmp_path):
    years, folders = [], []
    w = incremental_fixture(spark, SF001, str(tmp_path / "wh"), lambda w: (years.append(w.changed_years), folders.append(dict(w.state["manifests"]["fct_ocorrencias"]))))
    ref = Warehouse.from_sf(spark, SF001, materialize=True)
    for name in ("snap_crime", "snap_geografia", "dim_crime", "dim_geografia", "dim_local", "dim_distrito", "dim_tipo_crime"):
        same(getattr(ref, name), w.model(name))
    same(ref.fct_ocorrencias.drop("ano_fato"), w.fact.drop("part"))
    same(ref.fct_desempenho_mensal, w.monthly)
    assert years[0] == [2007, 2008, 2009, 2010]
    assert years[2] == [2013]  # no new row: beats that reopen in 2013 move that year's keys alone
    kept = [p for p in folders[0] if int(p) not in years[1]]
    assert kept and all(folders[2][p] == folders[0][p] for p in kept)  # the same files
    assert folders[2]["2011"] == folders[1]["2011"] != folders[2]["2013"]
    again = IncrementalWarehouse(spark, str(tmp_path / "wh"))
    assert again.run(ref.raw, FIXTURE_RUNS[2]).number == 2  # the same as_of: nothing happens
    with pytest.raises(ValueError, match="older"):
        again.run(ref.raw, FIXTURE_RUNS[0])


def state(w):
    return sorted(tuple(r) for r in w.fact.select("id_ocorrencia", "sk_data", "sk_crime", "sk_geografia", "sk_local", "qtd_prisao").collect())


def rebuilt(spark, raw, runs):
    ref = Warehouse(spark, raw, runs, history="merge")
    return ref, sorted(tuple(r) for r in ref.fct_ocorrencias.select("id_ocorrencia", "sk_data", "sk_crime", "sk_geografia", "sk_local", "qtd_prisao").collect())


def test_corrections_moves_deletes_and_undated_rows(spark, tmp_path):
    w = IncrementalWarehouse(spark, str(tmp_path / "wh"), id_buckets=4)
    first = [row(id=str(i), date=f"0{1 + i % 9}/15/20{10 + i % 3} 10:30:00 AM", iucr="0110" if i % 3 else "0420", beat="0421" if i % 2 else None) for i in range(1, 25)]
    first += [row(id="90", date="05/01/1999 01:00:00 PM")]
    w.run(raw_rows(spark, first), SnapshotRun(T1))
    assert w.changed_years == [0, 2010, 2011, 2012]
    second = [row(id="1", date="01/20/2010 10:30:00 AM", arrest="false"),   # moves from 2011 to 2010
              row(id="2", date="03/15/1998 10:30:00 AM"),                     # leaves the calendar
              row(id="90", date="05/01/2010 01:00:00 PM", location_description="ALLEY"),
              row(id="50", date="07/01/2012 01:00:00 AM", iucr="0999", beat="0733", district="007")]
    deletes = spark.createDataFrame([(3,), (4,), (777,), (None,)], "id_ocorrencia long")
    w.run(raw_rows(spark, second), SnapshotRun(T2), deletes)
    now = {r["id"]: r for r in first + second if r["id"] not in ("3", "4")}
    ref, rows = rebuilt(spark, raw_rows(spark, list(now.values())), [SnapshotRun(T2)])
    assert [r[0] for r in state(w)] == [r[0] for r in rows]
    assert [(r[0], r[1], r[5]) for r in state(w)] == [(r[0], r[1], r[5]) for r in rows]
    total = w.monthly.agg(*[F.sum(c) for c in ("qtd_ocorrencias", "qtd_prisoes", "qtd_sem_prisao")]).first()
    in_calendar = [r for r in rows if r[1] != -1]
    assert tuple(total) == (len(in_calendar), sum(r[5] for r in in_calendar), len(in_calendar) - sum(r[5] for r in in_calendar))
    before = dict(w.state["manifests"]["stg_crimes"])
    w.run(raw_rows(spark, []), SnapshotRun(T3), spark.createDataFrame([(i,) for i in range(1, 100)], "id_ocorrencia long"))  # all of them
    assert w.fact.count() == 0 and w.monthly.count() == 0 and w.staging.count() == 0 and before
    w.run(raw_rows(spark, [row(id="1")]), SnapshotRun(dt.datetime(2014, 1, 1)), on_duplicate="error")  # a deleted id is free again
    assert w.fact.count() == 1 and w.monthly.count() == 1


def test_duplicates_across_runs_and_inside_one(spark, tmp_path):
    w = IncrementalWarehouse(spark, str(tmp_path / "wh"), id_buckets=4)
    w.run(raw_rows(spark, [row(id=str(i)) for i in range(20)]), SnapshotRun(T1))
    with pytest.raises(ValueError, match="1 value.* stored already"):
        w.run(raw_rows(spark, [row(id="7"), row(id="70")]), SnapshotRun(T2), on_duplicate="error")
    with pytest.raises(ValueError, match="1 duplicated value"):
        w.run(raw_rows(spark, [row(id="71"), row(id="71")]), SnapshotRun(T2))
    # what the failed runs have appended to the index does not count
    w.run(raw_rows(spark, [row(id="70"), row(id="71")]), SnapshotRun(T2), on_duplicate="error")
    assert w.fact.count() == 22 and IncrementalWarehouse(spark, str(tmp_path / "wh")).fact.count() == 22


def test_two_writers_from_one_commit(spark, tmp_path):
    a = IncrementalWarehouse(spark, str(tmp_path / "wh"), id_buckets=4)
    a.run(raw_rows(spark, [row(id="1")]), SnapshotRun(T1))
    b = IncrementalWarehouse(spark, str(tmp_path / "wh"))
    a.run(raw_rows(spark, [row(id="2")]), SnapshotRun(T2))
    with pytest.raises(RuntimeError, match="another run"):
        b.run(raw_rows(spark, [row(id="3")]), SnapshotRun(T3))
    c = IncrementalWarehouse(spark, str(tmp_path / "wh")).run(raw_rows(spark, [row(id="3")]), SnapshotRun(T3))
    assert [r[0] for r in state(c)] == [1, 2, 3]


def test_empty_first_run(spark, tmp_path):
    w = IncrementalWarehouse(spark, str(tmp_path / "wh"), id_buckets=2).run(raw_rows(spark, []), SnapshotRun(T1))
    assert w.fact.count() == 0 and w.monthly.count() == 0 and w.changed_years == []


def test_index_is_read_without_a_shuffle(spark, tmp_path):
    from dimforge.sources.keyindex import KeyIndex

    index = KeyIndex(spark, str(tmp_path / "ids"), 4)
    index.append(spark.range(1000).select(F.col("id").alias("key"), F.lit(2010).alias("part")), "a")
    index.append(spark.range(500, 520).select(F.col("id").alias("key"), F.lit(None).cast("int").alias("part")), "b")
    index.append(spark.range(5).select(F.col("id").alias("key"), F.lit(1).alias("part")), "failed")
    new = spark.range(490, 1010).select(F.col("id").alias("key"))
    found = index.found(new, ["a", "b"])
    assert sorted(r.key for r in found.collect()) == [*range(490, 500), *range(520, 1000)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("FileScan")
    assert "Bucketed: true" in plan and "Exchange" not in plan[plan.rindex("ShuffledHashJoin"):scan]


def test_signed_deltas_against_recomputation(spark):
    import random

    r = random.Random(9)
    old = {i: (r.randrange(3), f"g{r.randrange(4)}", "c", 1, r.randrange(2), 0) for i in range(200)}
    new = {i: (v if r.random() < 0.5 else (r.randrange(3), f"g{r.randrange(4)}", None, 1, r.randrange(2), 1)) for i, v in old.items() if r.random() < 0.8} | {i: (1, "new", "c", 1, 1, 1) for i in range(300, 320)}
    changed = {i for i in old.keys() | new.keys() if old.get(i) != new.get(i)}
    schema = "sk_data int, sk_geografia string, sk_crime string, qtd_ocorrencia bigint, qtd_prisao bigint, qtd_domestico bigint"
    frame = lambda rows: spark.createDataFrame([*rows], schema)
    stored = merged_deltas(frame([]), frame(old.values()), GRAIN, MEASURES)
    delta = signed_deltas(frame(v for i, v in old.items() if i in changed), frame(v for i, v in new.items() if i in changed), GRAIN, MEASURES)
    assert delta.where("qtd_ocorrencia < 0").count() > 0
    same(merged_deltas(stored, delta, GRAIN, MEASURES), merged_deltas(frame([]), frame(new.values()), GRAIN, MEASURES))


def test_moved_ranges(spark):
    t = lambda y: dt.datetime(y, 1, 1)
    schema = "sk string, k string, valido_de timestamp_ntz, valido_ate timestamp_ntz"
    old = spark.createDataFrame([("a1", "a", t(1900), t(9000)), ("b1", "b", t(1900), t(9000)), ("c1", "c", t(2005), t(9000)), ("-1", "-", t(1900), t(9000))], schema)
    new = spark.createDataFrame([("a1", "a", t(1900), t(2012)), ("a2", "a", t(2012), t(9000)), ("b1", "b", t(1900), t(9000)), ("c1", "c", t(1900), t(9000)), ("d1", "d", t(2012), t(9000))], schema)
    got = {tuple(r) for r in moved_ranges(old, new, "sk", "k").collect()}
    assert got == {("a", t(2012), t(9000)), ("c", t(1900), t(2005)), ("d", t(2012), t(9000))}
