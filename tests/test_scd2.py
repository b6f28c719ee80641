import datetime as dt
import random

from dimforge.operators.joins import asof_join
from dimforge.operators.latest import latest_per_key
from dimforge.operators.scd2 import scd2_from_events, scd2_validity, snapshot_merge, snapshot_replay, with_current
from dimforge.plans import constants as K

T1, T2, T3 = dt.datetime(2011, 1, 1), dt.datetime(2012, 6, 1), dt.datetime(2013, 1, 1)
SCHEMA = "k int, a string, b int"


def _key(t):
    return tuple((v is None, v if v is not None else 0) for v in t)


def _sorted(rows):
    return sorted(rows, key=_key)


def _rows(df):
    return _sorted(tuple(r) for r in df.collect())


def test_merge_change_delete_reopen(spark):
    s1 = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, "z", 3)], SCHEMA)
    s2 = spark.createDataFrame([(1, "x", 1), (2, "y", 5), (4, "w", 4)], SCHEMA)   # 2 changes, 3 deleted, 4 new
    s3 = spark.createDataFrame([(1, "x", 1), (2, "y", 5), (3, "z", 3), (4, "w", 4)], SCHEMA)  # 3 returns
    h = snapshot_merge(s1, "k", ["a", "b"], T1)
    h = snapshot_merge(s2, "k", ["a", "b"], T2, history=h)
    h = snapshot_merge(s3, "k", ["a", "b"], T3, history=h)
    assert _rows(h) == _sorted([
        (1, "x", 1, T1, None),
        (2, "y", None, T1, T2),
        (2, "y", 5, T2, None),
        (3, "z", 3, T1, T2),
        (3, "z", 3, T3, None),
        (4, "w", 4, T2, None),
    ])


def test_merge_null_safe_unchanged(spark):
    s = spark.createDataFrame([(1, None, None)], SCHEMA)
    h = snapshot_merge(s, "k", ["a", "b"], T1)
    h = snapshot_merge(s, "k", ["a", "b"], T2, history=h)
    assert _rows(h) == [(1, None, None, T1, None)]


def test_replay_equals_folded_merges(spark):
    rnd = random.Random(7)
    runs = [dt.datetime(2010 + i, 1, 1) for i in range(6)]
    states = []
    for _ in runs:
        rows = [(k, rnd.choice(["p", "q", None]), rnd.choice([1, 2, None]))
                for k in range(40) if rnd.random() < 0.8]
        states.append(spark.createDataFrame(rows, SCHEMA))
    h = None
    for t, s in zip(runs, states):
        h = snapshot_merge(s, "k", ["a", "b"], t, history=h)
    replay = snapshot_replay(list(zip(runs, states)), "k", ["a", "b"])
    assert _rows(replay) == _rows(h)
    # versions of a key never overlap and at most one is open
    v = sorted(_rows(replay), key=lambda r: (r[0], r[3]))
    for (k1, _, _, f1, t1), (k2, _, _, f2, _) in zip(v, v[1:]):
        if k1 == k2:
            assert t1 is not None and f1 < t1 <= f2


def test_validity_backdates_global_first_run_only(spark):
    h = spark.createDataFrame(
        [(1, "x", 1, T1, T2), (1, "y", 1, T2, None), (2, "z", 2, T2, None)],
        "k int, a string, b int, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    g = {(r.k, r.dbt_valid_from): r for r in scd2_validity(h, K.BEGINNING_OF_TIME, K.END_OF_TIME).collect()}
    first, second = g[(1, T1)], g[(1, T2)]
    assert first.valido_de == K.BEGINNING_OF_TIME and first.valido_ate == T2 and not first.flag_versao_atual
    assert second.valido_de == T2 and second.valido_ate == K.END_OF_TIME and second.flag_versao_atual
    # key first seen in a later run keeps its real start (as coded) ...
    assert g[(2, T2)].valido_de == T2
    # ... unless back-dating per key is requested
    pk = {r.k: r for r in scd2_validity(h, K.BEGINNING_OF_TIME, K.END_OF_TIME, per_key=True, key="k")
          .where("dbt_valid_to IS NULL").collect()}
    assert pk[2].valido_de == K.BEGINNING_OF_TIME and pk[1].valido_de == T2


def test_with_current_hard_deleted_key_is_null(spark):
    h = spark.createDataFrame(
        [(1, "x", T1, T2), (1, "y", T2, None), (2, "z", T1, T2)],
        "k int, a string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    got = {(r.k, r.a): r.a_atual for r in with_current(h, "k", {"a": "a_atual"}).collect()}
    assert got == {(1, "x"): "y", (1, "y"): "y", (2, "z"): None}


def test_asof_boundaries_and_gap(spark):
    dim = spark.createDataFrame(
        [("a", 1, K.BEGINNING_OF_TIME, T2), ("b", 1, T2, T3), ("c", 1, dt.datetime(2014, 1, 1), K.END_OF_TIME)],
        "sk string, key int, valido_de timestamp_ntz, valido_ate timestamp_ntz")
    facts = spark.createDataFrame(
        [(10, 1, T2), (11, 1, T3), (12, 1, dt.datetime(2012, 5, 31, 23, 59, 59)), (13, None, T2), (14, 9, T2)],
        "id int, key int, ts timestamp_ntz")
    want = {10: "b", 11: "-1", 12: "a", 13: "-1", 14: "-1"}
    for max_rows in (1_000_000, 0):  # broadcast path and shuffled path (NULL keys split off)
        j = asof_join(facts, dim, "key", "key", "ts", {"sk": "sk"}, unknown={"sk": "-1"}, max_rows=max_rows)
        assert {r.id: r.sk for r in j.collect()} == want


def test_latest_per_key_ties_and_hot_key(spark):
    rows = [(1, "old", dt.datetime(2020, 1, 1), 5), (1, "tie_low", dt.datetime(2021, 1, 1), 6),
            (1, "tie_high", dt.datetime(2021, 1, 1), 7), (None, "nokey", dt.datetime(2030, 1, 1), 1)]
    # a hot key holding most rows
    rows += [(2, f"v{i}", dt.datetime(2000, 1, 1) + dt.timedelta(days=i), 100 + i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v string, ts timestamp_ntz, id int").repartition(16)
    got = {r.k: r.v for r in latest_per_key(df, "k", ["v"], ["ts", "id"]).collect()}
    assert got == {1: "tie_high", 2: "v2999"}


def test_scd2_from_events_matches_brute_force(spark):
    rnd = random.Random(3)
    rows, i = [], 0
    for beat in (1, 2, 3):
        t = dt.datetime(2010, 1, 1)
        d = 10
        for _ in range(400):
            t += dt.timedelta(hours=rnd.choice([1, 5, 30, 24 * 20]))
            if rnd.random() < 0.03:
                d = rnd.choice([10, 11, 12])
            i += 1
            rows.append((beat, d, t, i))
    df = spark.createDataFrame(rows, "beat int, district int, ts timestamp_ntz, id int")
    got = sorted(tuple(r) for r in scd2_from_events(df, "beat", "district", "ts", "id", K.END_OF_TIME).collect())
    want = []
    for beat in (1, 2, 3):
        ev = sorted((t, i, d) for b, d, t, i in rows if b == beat)
        starts = [(t, d) for n, (t, i, d) in enumerate(ev) if n == 0 or ev[n - 1][2] != d]
        for n, (t, d) in enumerate(starts):
            want.append((beat, d, t, starts[n + 1][0] if n + 1 < len(starts) else K.END_OF_TIME))
    assert got == sorted(want)


def test_events_with_nulls_ignored(spark):
    df = spark.createDataFrame([(1, None, T1, 1), (None, 5, T1, 2), (1, 5, T2, 3)],
                               "beat int, district int, ts timestamp_ntz, id int")
    got = [tuple(r) for r in scd2_from_events(df, "beat", "district", "ts", "id", K.END_OF_TIME).collect()]
    assert got == [(1, 5, T2, K.END_OF_TIME)]


def test_run_states_one_pass_equals_per_run_latest(spark):
    from dimforge.operators.scd2 import run_states

    rnd = random.Random(11)
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice(["a", "b", None]), dt.datetime(2010, 1, 1) + dt.timedelta(days=i),
             i, rnd.choice([10, 20, None])) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v string, ts timestamp_ntz, id int, g int")
    filters = ["ts < timestamp_ntz'2010-06-01 00:00:00'", "g < 15", "true"]  # g NULL -> not in run 1
    got = _rows(run_states(df, filters, "k", ["v"], ["ts", "id"]))
    want = []
    for i, f in enumerate(filters):
        for r in latest_per_key(df, "k", ["v"], ["ts", "id"], where=f).collect():
            want.append((i, r.k, r.v))
    assert got == _sorted(want)


def test_versions_of_a_hot_key_that_alternates_with_every_event(spark):
    """One key holds a third of the events and changes with each of them, in one day and across days."""
    import datetime as dt

    from pyspark.sql import functions as F

    from dimforge.operators.scd2 import scd2_from_events

    t0 = dt.datetime(2010, 1, 1)
    data = [(7, i % 2, t0 + dt.timedelta(minutes=7 * i), i) for i in range(600)]
    data += [(i % 50, i // 400, t0 + dt.timedelta(minutes=11 * i), 10_000 + i) for i in range(1200) if i % 50 != 7]
    data += [(9, None, t0, 1), (None, 1, t0, 2), (3, 1, None, 3)]
    got = scd2_from_events(spark.createDataFrame(data, "k int, a int, t timestamp_ntz, id long"), "k", "a", "t", "id", dt.datetime(9999, 12, 31))
    want = []
    for k in range(50):
        own = sorted((t, i, a) for x, a, t, i in data if x == k and a is not None and t is not None)
        starts = [(t, a) for n, (t, _, a) in enumerate(own) if not n or own[n - 1][2] != a]
        want += [(k, a, t, starts[n + 1][0] if n + 1 < len(starts) else dt.datetime(9999, 12, 31)) for n, (t, a) in enumerate(starts)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    widest = spark.createDataFrame(data, "k int, a int, t timestamp_ntz, id long").groupBy("k", F.date_trunc("hour", "t")).count().agg(F.max("count")).first()[0]
    assert widest < 0.05 * len(data)  # what one window sorts at most


def test_run_states_do_not_multiply_rows(spark):
    from dimforge.operators.scd2 import run_states

    df = spark.range(3000).selectExpr("id % 3 AS k", "id AS t", "id AS a")
    filters = [f"t < {100 * i}" for i in range(1, 31)]
    states = run_states(df, filters, "k", ["a"], ["t"])
    got = {(r["_run"], r.k): r.a for r in states.collect()}
    assert got == {(n, k): max(t for t in range(100 * (n + 1)) if t % 3 == k) for n in range(30) for k in range(3)}
