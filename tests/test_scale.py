"""Work that grows no faster than the input: shuffles, sorts and files of the warehouse's large steps."""

from __future__ import annotations

import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from conftest import raw_rows, row
from dimforge.functions.text import digits_to_int
from dimforge.plans import profiling as P
from dimforge.plans import registry
from dimforge.sources import fixture

LINES = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
         "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def lines_and_orders(spark):
    day = dt.datetime(1996, 5, 1)
    line = lambda order, number, part: (order, number, part, 3, 1.0, 2.0, 0.0, 0.0, "R", "O", day)
    rows = [line(1, 1, 7), line(1, 1, 5), line(1, 2, 5), line(2, 1, 9), line(2, 1, 9), line(None, 1, 5), line(4, None, 5), line(5, 1, 5)]
    orders = spark.createDataFrame([(1, day), (2, day), (2, day), (4, day), (None, day)], "o_orderkey long, o_orderdate timestamp_ntz")
    return spark.createDataFrame(rows, LINES), orders


@pytest.mark.parametrize("small", [True, False])
def test_lines_are_dealt_by_order_key_once(spark, tmp_path, monkeypatch, small):
    lineitem, orders = lines_and_orders(spark)
    if not small:
        lineitem.write.parquet(f"{tmp_path}/lineitem")
        lineitem = spark.read.parquet(f"{tmp_path}/lineitem")
        monkeypatch.setattr(fixture, "SORTED_BYTES", fixture.size_bound(lineitem) // 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = fixture.crimes_raw_from_tpch(lineitem, orders)
        dealt = re.findall(r"Exchange hashpartitioning\((l_\w+)#[^)]*?, (\d+)\)", plan_of(raw))
        got = sorted((r.id or "", r.iucr) for r in raw.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [key for key, _ in dealt] == ["l_orderkey"]
    assert int(dealt[0][1]) == 8 if small else int(dealt[0][1]) > 8  # more partitions than the session's for a large table
    # order 1: lines numbered by part key; order 2: equal lines, each for both orders of its key; order 4: no line number, no id
    assert got == sorted([("1100001", " 0005A"), ("1100002", " 0007A"), ("1200001", " 0005A"), ("", " 0005A"), *[("2100001", " 0009A"), ("2100002", " 0009A")] * 2])


def test_varying_attributes_without_expanding_rows(spark):
    raw = raw_rows(spark, [row(id="1"), row(id="2", description="X"), row(id="3", iucr="2", fbi_code=None), row(id="4", iucr="2"),
                           row(id="5", iucr=None, primary_type="A"), row(id="6", iucr=None, primary_type="B")])
    found = P.prof_iucr_varies(raw)
    assert found.collect() == [(1, 1, 0)]
    plan = plan_of(found)
    assert "Expand" not in plan
    assert re.search(r"HashAggregate\(keys=\[iucr#\d+, primary_type#\d+, description#\d+, fbi_code#\d+\], functions=\[partial_count", plan)  # rows collapse first


def test_damaged_landing_is_compressed(spark, tmp_path, monkeypatch):
    raw = raw_rows(spark, [row(id=str(i)) for i in range(1, 2001)])
    monkeypatch.setattr(registry, "wh", lambda *a: type("W", (), {"raw": raw}))
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    got = dict(tuple(r) for r in registry.QUERIES["landing_quarantine"](spark, "none").collect())
    cut, bad, none = (sum(ok(i) for i in range(1, 2001)) for ok in (lambda i: i % 101 == 3, lambda i: i % 101 != 3 and i % 103 == 4, lambda i: i % 101 != 3 and i % 103 != 4 and i % 107 == 5))
    assert got == {"not in the landing layout": cut, "date is no timestamp": bad, "no date": none, "staged": 2000 - cut - bad - none}
    files = glob.glob(f"{tmp_path}/landing-damaged/part-*")
    assert files and all(f.endswith(".gz") for f in files)


def test_id_buckets_grow_with_the_raw_table(spark, tmp_path, monkeypatch):
    raw = raw_rows(spark, [row(id=str(i), year="2009") for i in range(1, 40)])
    raw.write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    monkeypatch.setattr(registry, "wh", lambda *a: type("W", (), {"raw": raw}))
    monkeypatch.setattr(registry, "ID_BUCKET_BYTES", registry.size_bound(raw) // 11)
    asked = []
    monkeypatch.setattr(registry, "IncrementalWarehouse", lambda spark, root, id_buckets: asked.append(id_buckets) or type("I", (), {"run": lambda self, *a: self})())
    registry.incremental_fixture(spark, "none", f"{tmp_path}/w")
    assert asked[0] in (11, 12)


def test_digits_of_plain_and_mixed_text(spark):
    rows = [("004", 4), ("12.0", 120), ("x", None), ("", None), (" ", None), (" 7 ", 7), ("-5", 5), ("٣", None), ("0", 0), (None, None), ("2147483647", 2147483647)]
    got = spark.createDataFrame(rows, "t string, n int").select(digits_to_int(F.col("t")).alias("got"), "n", "t").collect()
    assert [(r.t, r.got) for r in got] == rows
