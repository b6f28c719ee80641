"""One key holding a third of all rows (plus a NULL-key block) through the joins, on the
broadcast path and on the shuffled path (forced with max_rows=0); results must agree."""

import datetime as dt

from pyspark.sql import functions as F

from dimforge.operators.joins import asof_join, lookup_join
from dimforge.session import cluster_conf

T0, T1 = dt.datetime(2000, 1, 1), dt.datetime(2010, 1, 1)


def test_hot_and_null_keys_both_paths(spark):
    n = 30000
    facts = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7))                     # hot key: a third of the rows
        .when(F.col("id") % 10 == 1, F.lit(None).cast("long"))      # NULL keys
        .otherwise(F.col("id") % 50).alias("k"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_interval(hours=F.col("id").cast("int"))).alias("ts"),
    )
    dim = spark.range(50).select(
        F.col("id").alias("k"), F.lit("2000-01-01").cast("timestamp_ntz").alias("valido_de"),
        F.lit("2002-01-01").cast("timestamp_ntz").alias("valido_ate"), F.concat(F.lit("v"), F.col("id")).alias("sk"))
    out = {}
    for max_rows in (1_000_000, 0):
        a = asof_join(facts, dim, "k", "k", "ts", {"sk": "sk_asof"}, unknown={"sk_asof": "-1"}, max_rows=max_rows)
        b = lookup_join(a, dim, [("k", "k")], {"sk": "sk_eq"}, unknown={"sk_eq": "-1"}, max_rows=max_rows)
        out[max_rows] = sorted(tuple(r) for r in b.select("id", "sk_asof", "sk_eq").collect())
    assert out[0] == out[1_000_000]
    rows = out[0]
    assert len(rows) == n
    def key(i):
        return 7 if i % 3 == 0 else (None if i % 10 == 1 else i % 50)

    assert sum(1 for r in rows if r[2] == "v7") == sum(1 for i in range(n) if key(i) == 7) >= n // 3
    assert sum(1 for r in rows if r[2] == "-1") == sum(1 for i in range(n) if key(i) is None)
    # as-of: only incidents inside the validity window match
    assert sum(1 for r in rows if r[1] != "-1") == sum(
        1 for i in range(n) if key(i) is not None and T0 + dt.timedelta(hours=i) < dt.datetime(2002, 1, 1))


def test_cluster_conf_scales_shuffle_partitions():
    small = cluster_conf(10 << 30, 64)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert int(big["spark.sql.shuffle.partitions"]) == 50_000
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_asof_by_carried_versions_hot_key_with_many_versions(spark):
    """A key with a third of the events and 10,000 versions: equal to the broadcast path, and no task gets the key."""
    n, versions = 60_000, 10_000
    start = F.lit(T0).cast("timestamp_ntz")
    after = lambda minutes: start + F.make_interval(mins=minutes.cast("int"))
    facts = spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.when(F.col("id") % 101 != 5, after(F.col("id") * 37 % 500_000 - 1000)).alias("ts"), F.lit("clash").alias("_v"), F.lit("x").alias("_at"))
    facts = facts.unionByName(facts.where("id < 50"))  # repeated rows
    hot = spark.range(versions).select(F.lit("hot").alias("k"), F.col("id").alias("v"), after(F.col("id") * 45).alias("f"), after(F.col("id") * 45 + F.when(F.col("id") % 10 == 4, 20).otherwise(45)).alias("t"))
    some = spark.range(39).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"), after(F.col("id") * 500).alias("f"), F.lit(dt.datetime(9999, 12, 31)).cast("timestamp_ntz").alias("t"))
    empty = spark.range(5).select(F.lit("k3").alias("k"), (F.col("id") + 100).alias("v"), after(F.lit(1500)).alias("f"), after(F.lit(1500)).alias("t"))  # valid at no time
    dim = hot.unionByName(some).unionByName(empty).unionByName(spark.range(1).select(F.lit(None).cast("string").alias("k"), F.lit(7).cast("long").alias("v"), start.alias("f"), start.alias("t")))

    def run(**kw):
        return asof_join(facts, dim, "k", "k", "ts", {"v": "version"}, "f", "t", unknown={"version": -1}, **kw)

    want = sorted(tuple(r) for r in run(known_rows=versions).select("id", "version").collect())
    for bucket in ("hour", "day", "year"):
        assert sorted(tuple(r) for r in run(max_rows=0, bucket=bucket).select("id", "version").collect()) == want
    assert len(want) == n + 50 and len({v for _, v in want}) > 7000
    plan = run(max_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    sizes = facts.where("k = 'hot' AND ts IS NOT NULL").groupBy(F.date_trunc("hour", "ts")).count().agg(F.max("count")).first()[0]
    assert sizes < 20  # rows of a (key, bucket), the unit that a task gets whole


def test_broadcast_check_looks_at_rows_and_bytes(spark, tmp_path):
    from dimforge.operators.joins import DEFAULT_BROADCAST_MAX_BYTES, fits_broadcast, remember_row_count

    wide = spark.range(2000).select("id", F.repeat(F.md5(F.col("id").cast("string")), 2000).alias("text"))
    assert fits_broadcast(wide, known_rows=2000)
    path = str(tmp_path / "wide")
    spark.range(400).select("id", *[F.rand(i).alias(f"c{i}") for i in range(3)]).write.parquet(path)
    narrow = spark.read.parquet(path)
    remember_row_count(narrow, 400)
    assert fits_broadcast(narrow) and not fits_broadcast(narrow, max_rows=399)
    import dimforge.operators.joins as joins

    joins.DEFAULT_BROADCAST_MAX_BYTES, kept = 1000, DEFAULT_BROADCAST_MAX_BYTES
    try:
        assert not fits_broadcast(narrow)  # few rows, many bytes
    finally:
        joins.DEFAULT_BROADCAST_MAX_BYTES = kept
