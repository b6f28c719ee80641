"""The commit log: one writer wins a number, nothing committed is lost, few files are opened."""

import datetime as dt
import os
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest

from conftest import ROOT
from dimforge.plans.warehouse import GEO_CHECK, GEO_KEY
from dimforge.sources.commits import CommitLog
from dimforge.sources.history import HistoryStore, run_snapshot


def test_one_of_many_writers_gets_a_number(spark, tmp_path):
    logs = [CommitLog(spark, str(tmp_path / "t")) for _ in range(8)]
    for n in range(5):
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda k: logs[k].commit(n, {"writer": k}), range(8)))
        assert sum(won) == 1 and logs[0].at(n) == {"writer": won.index(True)}
    assert [n for n, _ in logs[0].all()] == [*range(5)]
    assert not [f for f in os.listdir(tmp_path / "t" / "_commits") if f.startswith(".") and not f.endswith(".crc")]


def test_few_files_are_opened(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"), compact_every=8)
    assert log.last() is None and log.all() == []
    for n in range(30):
        assert log.commit(n, {"n": n})
    fresh = CommitLog(spark, str(tmp_path / "t"), compact_every=8)
    assert fresh.last() == (29, {"n": 29}) and fresh.opened == 1
    assert [e["n"] for _, e in fresh.all()] == [*range(30)] and fresh.opened <= 1 + 1 + 8


def test_unfinished_files_are_no_commits(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    log.commit(0, {"n": 0})
    (tmp_path / "t" / "_commits" / "1.json").write_text("")  # its writer died
    assert log.last() == (0, {"n": 0}) and log.next_number() == 2
    assert not log.commit(1, {"n": 1}) and log.commit(2, {"n": 2})
    assert [n for n, _ in log.all()] == [0, 2]


def test_concurrent_snapshot_runs_keep_both_histories_or_fail_clearly(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path / "h"))
    frame = lambda rows: spark.createDataFrame(rows, "beat int, district int")
    run_snapshot(store, frame([(1, 1), (2, 2)]), GEO_KEY, GEO_CHECK, dt.datetime(2010, 1, 1))
    states = {dt.datetime(2011, 1, 1): [(1, 5), (2, 2)], dt.datetime(2012, 1, 1): [(1, 5), (2, 6)]}

    def run(as_of):
        try:
            run_snapshot(HistoryStore(spark, store.root), frame(states[as_of]), GEO_KEY, GEO_CHECK, as_of)
            return None
        except ValueError as e:
            return str(e)

    with ThreadPoolExecutor(2) as pool:
        errors = list(pool.map(run, states))
    runs = [e["as_of"] for _, e in store.log.all()]
    open_rows = {(r.beat, r.district) for r in store.latest().where("dbt_valid_to IS NULL").collect()}
    assert open_rows == {(1, 5), (2, 6)} and errors[1] is None
    if errors[0] is None:
        assert runs == ["2010-01-01 00:00:00", "2011-01-01 00:00:00", "2012-01-01 00:00:00"] and store.latest().count() == 4
    else:  # the later run was first
        assert "older than the last run" in errors[0] and len(runs) == 2


def test_a_writer_that_comes_second_merges_again(spark, tmp_path, monkeypatch):
    store = HistoryStore(spark, str(tmp_path / "h"))
    frame = lambda rows: spark.createDataFrame(rows, "beat int, district int")
    run_snapshot(store, frame([(1, 1)]), GEO_KEY, GEO_CHECK, dt.datetime(2010, 1, 1))
    append, done = HistoryStore.append, []

    def second(self, history, run, *a, **kw):
        if not done:  # another writer commits between this one's reading and its commit
            done.append(run)
            run_snapshot(HistoryStore(spark, store.root), frame([(1, 2)]), GEO_KEY, GEO_CHECK, dt.datetime(2011, 1, 1))
        return append(self, history, run, *a, **kw)

    monkeypatch.setattr(HistoryStore, "append", second)
    got = run_snapshot(store, frame([(1, 3)]), GEO_KEY, GEO_CHECK, dt.datetime(2012, 1, 1))
    assert sorted(r.district for r in got.collect()) == [1, 2, 3] and store.last_run() == 2


PLAIN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from dimforge.session import checkpoint_root
from dimforge.sources.tables import materialize
assert spark.conf.get("spark.checkpoint.dir", None) is None
root = checkpoint_root(spark)
assert checkpoint_root(spark) == root and spark.range(3).checkpoint().count() == 3
assert materialize(spark, spark.range(5), "t").count() == 5
import __spark_entry__ as entry
if entry.llm:
    assert entry.queries()["op13_minimum_bin_slack"](spark, "/root/testdata/sf0.001").count() > 0
print("ran in", root)
"""


def test_plain_spark_without_a_checkpoint_setting_or_path(tmp_path):
    """A local Spark whose configuration names no folder, started elsewhere, with workers that do not know the package."""
    conf = tmp_path / "conf"
    conf.mkdir()
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_CONF_DIR")} | {"SPARK_CONF_DIR": str(conf)}
    done = subprocess.run([sys.executable, "-c", PLAIN.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "ran in" in done.stdout, done.stderr[-3000:]


def test_a_cluster_without_the_setting_is_refused(spark, monkeypatch):
    from dimforge import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        applicationId, master = "app-x", "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="shared, reliable folder"):
        session.checkpoint_root(Session())
