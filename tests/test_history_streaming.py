import datetime as dt

from pyspark.sql import functions as F

from conftest import SF0001, SF001
from dimforge.plans.warehouse import GEO_CHECK, GEO_KEY, SnapshotRun, Warehouse, geo_state
from dimforge.sources.fixture import FIXTURE_RUNS
from dimforge.sources.fixture import crimes_raw
from dimforge.sources.history import HistoryStore, run_snapshot
from dimforge.sources.landing import write_landing
from dimforge.streaming.incremental import stream_snapshots, stream_staging


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_persisted_runs_equal_replay(spark, tmp_path):
    w = Warehouse.from_sf(spark, SF001)
    store = HistoryStore(spark, str(tmp_path / "snap_geografia"))
    assert store.latest() is None
    for r in FIXTURE_RUNS:
        hist = run_snapshot(store, geo_state(w.stg, r.geo_filter), GEO_KEY, GEO_CHECK, r.as_of)
    assert store.last_run() == 2
    assert _same(hist, w.snap_geografia)
    # a re-submitted run number is a no-op; older runs stay readable
    assert store.append(hist, 1) is False
    assert store.at_run(0).count() == 100


def test_streaming_staging_and_snapshots(spark, tmp_path):
    raw = crimes_raw(spark, SF0001).cache()
    landing, staged = str(tmp_path / "landing"), str(tmp_path / "staged")
    early = raw.where(F.col("year").cast("int") <= 2010)
    write_landing(early, landing + "/part1")
    q = stream_staging(spark, landing + "/*", staged, str(tmp_path / "ck_stage"))
    q.awaitTermination()
    n1 = spark.read.parquet(staged).count()
    assert n1 == early.count()

    store = HistoryStore(spark, str(tmp_path / "hist"))
    schema = spark.read.parquet(staged).schema
    stream = spark.readStream.schema(schema).parquet(staged)
    t1 = dt.datetime(2011, 1, 1)
    q = stream_snapshots(stream, store, GEO_KEY, GEO_CHECK, "data_hora_ocorrencia", "id_ocorrencia",
                         str(tmp_path / "ck_snap"), where="district IS NOT NULL", clock=lambda: t1)
    q.awaitTermination()

    write_landing(raw.where(F.col("year").cast("int") > 2010), landing + "/part2")
    stream_staging(spark, landing + "/*", staged, str(tmp_path / "ck_stage")).awaitTermination()
    assert spark.read.parquet(staged).count() == raw.count()
    t2 = dt.datetime(2013, 1, 1)
    q = stream_snapshots(stream, store, GEO_KEY, GEO_CHECK, "data_hora_ocorrencia", "id_ocorrencia",
                         str(tmp_path / "ck_snap"), where="district IS NOT NULL", clock=lambda: t2)
    q.awaitTermination()

    # same history as two batch runs over the same cut
    stg = Warehouse(spark, raw, ()).stg
    want = Warehouse(spark, raw, runs=[SnapshotRun(t1, "true", "year(data_hora_ocorrencia) <= 2010"),
                                       SnapshotRun(t2, "true", "true")]).snap_geografia
    assert stg.count() == raw.count()
    assert _same(store.latest(), want)


def test_incremental_runs_equal_replayed_build(spark, tmp_path):
    from dimforge.plans.warehouse import build_run

    raw = crimes_raw(spark, SF001)
    early = raw.where(F.col("year").cast("int") <= 2010)
    root = str(tmp_path / "wh")
    build_run(spark, early, root, FIXTURE_RUNS[0].as_of)
    w = build_run(spark, raw, root, FIXTURE_RUNS[2].as_of)
    runs = [SnapshotRun(FIXTURE_RUNS[0].as_of, "year(data_hora_ocorrencia) <= 2010", "year(data_hora_ocorrencia) <= 2010"),
            SnapshotRun(FIXTURE_RUNS[2].as_of, "true", "true")]
    ref = Warehouse(spark, raw, runs=runs)
    for name in ("snap_crime", "snap_geografia", "dim_crime", "dim_geografia", "fct_ocorrencias", "fct_desempenho_mensal"):
        assert _same(getattr(ref, name), getattr(w, name)), name


def test_unlogged_partial_run_is_invisible_and_replaced(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "h"))
    h0 = spark.createDataFrame([(1, "a")], "k int, v string")
    assert store.append(h0, 0)
    # a crashed attempt of run 1: partition written, never logged
    spark.createDataFrame([(9, "junk")], "k int, v string").withColumn("snapshot_run", F.lit(1)) \
        .write.mode("append").partitionBy("snapshot_run").parquet(store.root)
    assert store.last_run() == 0 and [tuple(r) for r in store.latest().collect()] == [(1, "a")]
    h1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert store.append(h1, 1)
    assert sorted(tuple(r) for r in store.latest().collect()) == [(1, "a"), (2, "b")]
    assert [tuple(r) for r in store.at_run(0).collect()] == [(1, "a")]


def test_build_run_retry_is_idempotent(spark, tmp_path):
    from dimforge.plans.warehouse import build_run

    raw = crimes_raw(spark, SF0001)
    root = str(tmp_path / "wh")
    t = FIXTURE_RUNS[2].as_of
    a = build_run(spark, raw, root, t)
    n = a.fct_ocorrencias.count()
    b = build_run(spark, raw, root, t)  # retry of the same run
    assert HistoryStore(spark, root + "/snap_geografia").last_run() == 0
    assert b.fct_ocorrencias.count() == n and _same(a.snap_crime, b.snap_crime)
    import pytest
    with pytest.raises(ValueError):
        build_run(spark, raw, root, FIXTURE_RUNS[0].as_of)


def test_command_line_round_trip(spark, tmp_path, capsys):
    from dimforge.__main__ import main

    landing = str(tmp_path / "landing")
    write_landing(crimes_raw(spark, SF0001), landing)
    root = str(tmp_path / "wh")
    assert main(["build", "--raw", landing, "--root", root, "--as-of", "2013-01-01 00:00:00"], spark) == 0
    assert main(["test", "--root", root, "--out", str(tmp_path / "tests")], spark) == 0
    res = spark.read.parquet(str(tmp_path / "tests"))
    assert res.count() == 66
    assert main(["report", "--root", root, "p1", "--year-from", "2009", "--year-to", "2013", "--district", "1",
                 "--rollup", "--out", str(tmp_path / "p1")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "p1")).where("nivel = 7").count() == 1  # grand total
    assert main(["report", "--root", root, "pick-district", "--out", str(tmp_path / "pick")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "pick")).where("district = -1").count() == 1
    assert main(["profile", "--raw", landing], spark) == 0
    out = capsys.readouterr().out
    assert "built run" in out and "prof_beat_2012_share" in out and "total_registros" in out


def test_replayed_batches_old_stores_and_damaged_logs(spark, tmp_path):
    import os

    import pytest

    from dimforge.streaming.incremental import stream_snapshots

    store = HistoryStore(spark, str(tmp_path / "h"))
    start = spark.createDataFrame([(1, 11)], "beat int, district int")
    for n in range(3):  # an old store with batch runs of its own
        run_snapshot(store, start, GEO_KEY, GEO_CHECK, dt.datetime(2010, 1, 1 + n))
    staged = str(tmp_path / "staged")
    rows = "beat int, district int, t timestamp_ntz, id long"
    spark.createDataFrame([(1, 12, dt.datetime(2011, 1, 1), 1), (2, 20, dt.datetime(2011, 1, 1), 2)], rows).write.parquet(staged)

    def run(as_of):
        src = spark.readStream.schema(rows).parquet(staged)
        stream_snapshots(src, store, GEO_KEY, GEO_CHECK, "t", "id", str(tmp_path / "ckpt"), clock=lambda: as_of).awaitTermination()

    run(dt.datetime(2011, 2, 1))
    assert store.last_run() == 3  # batch 0 of a new stream is not run 0 of the store
    assert {(r.beat, r.district) for r in store.latest().where("dbt_valid_to IS NULL").collect()} == {(1, 12), (2, 20)}
    commits = tmp_path / "ckpt" / "commits"
    for name in ("0", ".0.crc"):
        if (commits / name).exists():
            os.remove(commits / name)  # the history was committed, the stream was not: batch 0 is replayed
    run(dt.datetime(2011, 3, 1))
    assert store.last_run() == 3
    spark.createDataFrame([(3, 30, dt.datetime(2012, 1, 1), 3)], rows).write.mode("append").parquet(staged)
    run(dt.datetime(2012, 2, 1))
    assert store.last_run() == 4 and store.latest().where("beat = 3").count() == 1

    os.makedirs(tmp_path / "empty" / "_runs")
    with pytest.raises(Exception):
        HistoryStore(spark, str(tmp_path / "empty")).last_run()
    assert HistoryStore(spark, str(tmp_path / "none")).last_run() is None
