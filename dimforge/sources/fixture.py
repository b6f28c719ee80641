"""Test-data adapter: derive a raw incident table (22 text columns) from the driver's
TPC-H-like ``lineitem`` and ``orders`` tables, so the warehouse runs on the given data
at every scale factor.

The rules (which code, beat, district, spelling a row gets) are fixed values of the
fixture; the same rules are written as DuckDB SQL in ``dimforge.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import size_bound
from .history import SnapshotRun
from .landing import LANDING_COLUMNS


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table; timestamps always come back as wall clock (TIMESTAMP_NTZ).

    The files store zone-less timestamps. A session with NTZ inference switched off reads
    them as UTC instants; those are turned back into the stored wall clock so no session
    time zone can shift a date.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    tz = spark.conf.get("spark.sql.session.timeZone")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            df = df.withColumn(f.name, F.to_utc_timestamp(F.col(f.name), tz).cast("timestamp_ntz"))
    return df


def _s(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(_s(c), n, "0")


#: Three snapshot runs over the test data - change, hard delete (beats 24xx leave in run 2) and
#: reopening (they return in run 3), with incidents on both sides of each cut.
FIXTURE_RUNS = (
    SnapshotRun(dt.datetime(2011, 1, 1), "year(data_hora_ocorrencia) <= 2010", "year(data_hora_ocorrencia) <= 2010"),
    SnapshotRun(dt.datetime(2012, 6, 1), "true", "beat < 2400"),
    SnapshotRun(dt.datetime(2013, 1, 1), "true", "true"),
)

# Lines of one (l_orderkey, l_linenumber) are told apart by their number in this order.
LINE_ORDER = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
              "l_linestatus", "l_shipdate")


SORTED_BYTES = 16 << 20  # of the files' size in one sorted partition: some ten times as much in memory
MOST_PARTITIONS = 50_000


def _by_order(lineitem: DataFrame) -> DataFrame:
    """Lines dealt by order key, into so many partitions that each is sorted in memory whatever the table's size."""
    size, session = size_bound(lineitem), int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(-(-size // SORTED_BYTES), MOST_PARTITIONS)
    unknown = size > 1 << 50  # rows that do not come from files
    return lineitem.repartition("l_orderkey") if unknown or n <= session else lineitem.repartition(n, "l_orderkey")


def crimes_raw_from_tpch(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Build ``crimes_raw``; one incident per lineitem row.

    The incident id is made of order key, line number and the row's number among those that
    share both (a handful; rows equal in every column are interchangeable). Lines are dealt by order
    key once: that one shuffle and sort serves the numbering and the join with orders.
    """
    same_line = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*[F.asc_nulls_first(c) for c in LINE_ORDER])
    li = _by_order(lineitem.where("l_orderkey IS NOT NULL").select("l_orderkey", "l_linenumber", *LINE_ORDER)).select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"), F.col("l_quantity").alias("qty"),
        "l_returnflag", "l_linestatus", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rid"), F.row_number().over(same_line).alias("rn"),
    )
    b = li.join(orders.select("o_orderkey", "o_orderdate"), li.l_orderkey == orders.o_orderkey).select(
        "*",
        F.col("o_orderdate").alias("od"),
        F.year("o_orderdate").alias("oy"),
        (F.col("pk") % 40).alias("code"),
        (F.col("pk") % 24).alias("hh"),
        (F.col("sk") % 25).alias("dist"),
    )
    rid, sk, pk, code, hh, oy, dist = (F.col(c) for c in ("rid", "sk", "pk", "code", "hh", "oy", "dist"))
    line = F.col("l_linenumber")

    hour12 = F.when(hh % 12 == 0, F.lit(12)).otherwise(hh % 12)
    date_txt = F.concat(
        _pad(F.month("od"), 2), F.lit("/"), _pad(F.dayofmonth("od"), 2), F.lit("/"), _s(oy + 12),
        F.lit(" "), _pad(hour12, 2), F.lit(":"), _pad(sk % 60, 2), F.lit(":"), _pad(rid % 60, 2),
        F.when(hh < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
    )
    # Primary type per code % 8 (old spelling for code 3 before order year 1999)
    primary_type = (
        F.when(code % 8 == 0, "THEFT")
        .when(code % 8 == 1, "BATTERY")
        .when(code % 8 == 2, "NARCOTICS")
        .when(code % 8 == 3, F.when(oy < 1999, "CRIM SEXUAL ASSAULT").otherwise("CRIMINAL SEXUAL ASSAULT"))
        .when(code % 8 == 4, "WEAPONS VIOLATION")
        .when(code % 8 == 5, "non-criminal (subject specified)")
        .when(code % 8 == 6, "ROBBERY")
        .otherwise("BURGLARY")
    )
    description = F.concat(
        F.when((code % 3 == 0) & (oy < 1999), F.lit("ARMED: KIND ")).otherwise(F.lit("ARMED - KIND ")), _s(code)
    )
    # Location text per supplier key % 8; line 7 has no location
    location = F.when(line == 7, F.lit(None).cast("string")).otherwise(
        F.when(sk % 8 == 0, "STREET")
        .when(sk % 8 == 1, "RESIDENCE - YARD")
        .when(sk % 8 == 2, "PARKING LOT")
        .when(sk % 8 == 3, "BARBERSHOP")
        .when(sk % 8 == 4, "CTA BUS")
        .when(sk % 8 == 5, "SCHOOL YARD")
        .when(sk % 8 == 6, "VEHICLE")
        .otherwise("OTHER")
    )
    null_s = F.lit(None).cast("string")
    district = (
        F.when((line == 5) & (sk % 50 == 0), null_s)
        .when(dist.isin(13, 21, 23) & (oy >= 2000), F.lit("012"))
        .otherwise(_pad(dist, 3))
    )
    out = b.select(
        _s(rid * 100000 + F.col("rn")).alias("id"),
        F.concat(F.lit("HX"), F.when(F.col("l_orderkey") < 10_000_000, _pad(F.col("l_orderkey"), 7)).otherwise(_s(F.col("l_orderkey")))).alias("case_number"),
        date_txt.alias("date"),
        F.concat(F.lit("0"), _pad(rid % 99, 2), F.lit("XX BLOCK ")).alias("block"),
        F.concat(F.lit(" "), _pad(code, 4), F.when(code % 2 == 0, F.lit("a")).otherwise(F.lit("A"))).alias("iucr"),
        primary_type.alias("primary_type"),
        description.alias("description"),
        location.alias("location_description"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("arrest"),
        F.when(F.col("l_linestatus") == "O", "True").otherwise("false").alias("domestic"),
        F.when(F.col("qty") == 50, null_s).otherwise(_pad(dist * 100 + sk % 4 + 11, 4)).alias("beat"),
        district.alias("district"),
        F.when(oy == 1995, null_s).otherwise(_s(pk % 50 + 1)).alias("ward"),
        F.when(oy == 1995, null_s).otherwise(_s(pk % 77 + 1)).alias("community_area"),
        _pad(code % 8, 2).alias("fbi_code"),
        null_s.alias("x_coordinate"),
        null_s.alias("y_coordinate"),
        _s(oy + 12).alias("year"),
        F.lit("01/02/2014 03:04:05 PM").alias("updated_on"),
        F.when(line == 6, null_s)
        .otherwise(F.concat(F.lit("41."), _pad(F.col("l_orderkey") * 7919 % 1000000000, 9)))
        .alias("latitude"),
        F.when(line == 6, null_s)
        .otherwise(F.concat(F.lit("-87."), _pad(F.col("l_orderkey") * 104729 % 1000000000, 9)))
        .alias("longitude"),
        null_s.alias("location"),
    )
    return out.select(*LANDING_COLUMNS)


def crimes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incident table for a driver scale-factor folder."""
    return crimes_raw_from_tpch(load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders"))
