"""Files clustered by date, place and code; Bloom filters on ids. What a scan reads is taken from its own metrics."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF001
from dimforge.functions.zorder import date_rank, hex_rank, z_value
from dimforge.plans import facts
from dimforge.plans import reports as R
from dimforge.plans.warehouse import Warehouse
from dimforge.sources.tables import clustered, lookup_options


def rows_read(df) -> tuple[int, int]:
    """(rows of the result, rows that the Parquet scan gave after pruning row groups)"""
    n = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan
    leaves = plan.collectLeaves()
    return n, max(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()) if "Scan" in leaves.apply(i).nodeName())


def test_z_order_and_bloom_filters_prune_row_groups(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.col("id"), (F.lit(20100000) + (1 + F.col("id") % 12) * 100 + 1 + F.col("id") % 28).cast("int").alias("sk_data"),
        F.md5((F.col("id") % 97).cast("string")).alias("sk_geografia"), F.when(F.col("id") % 500 == 3, "-1").otherwise(F.md5((F.col("id") % 89).cast("string"))).alias("sk_crime"),
        (F.xxhash64("id") % 1_000_000_007).alias("id_ocorrencia"), (F.lit(2010) + F.col("id") % 2).cast("int").alias("ano"))
    path = str(tmp_path / "f")
    (clustered(rows, "ano", facts.access_order()).write.options(**lookup_options(["id_ocorrencia"])).option("parquet.block.size", 64 << 10)
     .option("parquet.block.row.check.min", 100).option("parquet.page.row.count.limit", 1000).partitionBy("ano").parquet(path))
    groups = sum(pq.ParquetFile(f).num_row_groups for f in glob.glob(path + "/*/*.parquet"))
    assert groups > 30
    back = spark.read.parquet(path)
    assert back.count() == 200_000
    year = back.where("ano = 2010")
    for cond in (F.col("sk_geografia") == F.md5(F.lit("8")), F.col("sk_crime") == F.md5(F.lit("5")), F.col("sk_data").between(20100301, 20100331)):
        key = [r[0] for r in rows.where(cond).select("id").collect()]
        literal = cond if "sk_data" in str(cond) else F.col("sk_geografia" if "geografia" in str(cond) else "sk_crime") == rows.where(cond).select("sk_geografia" if "geografia" in str(cond) else "sk_crime").first()[0]
        n, read = rows_read(year.where(literal))
        assert key and 0 < n <= read < 50_000  # under half of the year's 100,000 rows
    one = rows.where("id = 4444").first().id_ocorrencia
    n, read = rows_read(back.where(F.col("id_ocorrencia") == one))
    assert n >= 1 and read < 20_000


def test_z_value_and_ranks(spark):
    got = spark.createDataFrame([(20100101, "00ab"), (20101231, "ffcd"), (-1, "-1"), (20100615, None)], "d int, k string").select(date_rank(F.col("d")), hex_rank(F.col("k"))).collect()
    assert [tuple(r) for r in got] == [(0, 0), (255, 255), (0, 0), (got[3][0], 0)] and 100 < got[3][0] < 140
    z = spark.range(1).select(z_value([F.lit(0b10), F.lit(0b01), F.lit(0b11)], 2)).first()[0]
    assert z == 0b101_011


def test_reports_that_use_the_access_paths(spark):
    w = Warehouse.from_sf(spark, SF001, materialize=True)
    some = [r[0] for r in w.stg.select("id_ocorrencia").limit(3).collect()]
    assert sorted(r[0] for r in R.incidents_by_id(w, some).select("id_ocorrencia").collect()) == sorted(some)
    plan = R.drill_through(w, **R.THROUGH_CELL, push_keys=True)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "In(sk_geografia" in pushed and "In(sk_crime" in pushed
