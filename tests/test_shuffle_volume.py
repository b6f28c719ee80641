"""What crosses the shuffles of a warehouse build, and how models are stored."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF001
from dimforge.functions.zorder import hex_rank
from dimforge.plans import facts
from dimforge.plans.warehouse import Warehouse
from dimforge.sources.tables import materialize

KEYS = ("sk_crime", "sk_geografia", "sk_local", "sk_flags")


def nodes(plan):
    """All nodes of an executed plan, with those of finished stages."""
    name = plan.nodeName()
    inner = plan.executedPlan() if name.startswith("Adaptive") else plan.plan() if "QueryStage" in name else None
    if inner is not None:
        yield from nodes(inner)
        return
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def shuffled(df):
    """(columns, records written) of each shuffle that ran for ``df``"""
    return [([a.split("#")[0] for a in n.output().mkString(",").split(",")], n.metrics().apply("shuffleRecordsWritten").value())
            for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"]


def test_dealt_fact_has_the_same_rows_and_shuffles_no_text_keys(spark):
    w = Warehouse.from_sf(spark, SF001, materialize=True)
    odd = w.stg.limit(3).withColumn("iucr", F.lit("none")).withColumn("beat", F.lit(None).cast("int")).withColumn("data_hora_ocorrencia", F.lit(None).cast("timestamp_ntz"))
    stg = w.stg.unionByName(w.stg.limit(5)).unionByName(odd.withColumn("data_ocorrencia", F.lit(None).cast("date")))
    dims = (w.dim_data, w.dim_hora, w.dim_local, w.dim_flags, w.dim_crime, w.dim_geografia)
    assert facts.lookups_fit(w.dim_local, w.dim_crime, w.dim_geografia)
    plain, dealt = facts.fct_ocorrencias(stg, *dims), facts.fct_ocorrencias(stg, *dims, True)
    assert dealt.schema == plain.schema and plain.count() == stg.count()
    assert plain.exceptAll(dealt).count() == 0 and dealt.exceptAll(plain).count() == 0
    dealt.collect()
    rows = [cols for cols, n in shuffled(dealt) if n >= stg.count()]
    assert len(rows) == 1 and "id_ocorrencia" in rows[0] and not set(rows[0]) & set(KEYS)


def test_fact_that_is_written_is_dealt_before_its_text_keys(spark):
    w = Warehouse.from_sf(spark, SF001, materialize=True)
    given = {}
    write = w._m
    w._m = lambda name, df, **kw: given.update({name: (df, kw)}) or write(name, df, **kw)
    assert w.fct_ocorrencias.count() == w.stg.count()
    df, kw = given["fct_ocorrencias"]
    assert kw["is_dealt"] and "RebalancePartitions" in df._jdf.queryExecution().optimizedPlan().toString()


def test_large_dimensions_leave_the_fact_to_be_dealt_last(spark, monkeypatch):
    monkeypatch.setattr(facts, "lookups_fit", lambda *dims: False)
    w = Warehouse.from_sf(spark, SF001, materialize=True)
    assert w.fct_ocorrencias.count() == w.stg.count()


def test_models_are_stored_compressed(spark):
    back = materialize(spark, spark.range(1000).select("id", F.col("id").cast("string").alias("t")), "stored")
    file = pq.ParquetFile(back.inputFiles()[0].removeprefix("file:"))
    assert {file.metadata.row_group(0).column(i).compression for i in range(2)} == {"ZSTD"}
    assert back.where("t = cast(id as string)").count() == 1000


def test_rank_of_a_hexadecimal_key(spark):
    keys = ["00ab", "ffcd", "-1", "", "a", "1g", "g1", "7f", "A0ff", "é0", "0 ", None]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(hex_rank(F.col("k"))).collect()
    assert [r[0] for r in got] == [0, 255, 0, 0, 0, 0, 0, 127, 0, 0, 0, 0]
