import datetime as dt
from decimal import Decimal

import pytest

from conftest import raw_rows, row
from dimforge.plans.staging import STAGING_COLUMNS, stage_crimes


def _stage(spark, rows, **kw):
    return {r.id_ocorrencia: r for r in stage_crimes(raw_rows(spark, rows), **kw).collect()}


def test_schema_and_basic_cast(spark):
    df = stage_crimes(raw_rows(spark, [row()]))
    assert df.columns == STAGING_COLUMNS
    types = dict(df.dtypes)
    assert types["id_ocorrencia"] == "bigint"
    assert types["data_hora_ocorrencia"] == "timestamp_ntz"
    assert types["data_ocorrencia"] == "date"
    assert types["latitude"] == "decimal(12,8)"
    r = df.collect()[0]
    assert r.data_hora_ocorrencia == dt.datetime(2010, 1, 15, 10, 30)
    assert r.latitude == Decimal("41.12345679")  # half-up rounding to 8 places


def test_drops_null_id_or_date_only(spark):
    out = _stage(spark, [row(id=None), row(id="2", date=None), row(id="3", beat=None, district=None, ward=None)])
    assert list(out) == [3]
    assert out[3].beat is None and out[3].district is None


def test_leading_zeros_and_digit_cleaning(spark):
    out = _stage(spark, [row(id="1"), row(id="2", ward="12.0"), row(id="3", ward="x"), row(id="4", ward="  ")])
    assert (out[1].district, out[1].beat) == (4, 421)
    assert out[2].ward == 120
    assert out[3].ward is None and out[4].ward is None


def test_twelve_hour_clock(spark):
    out = _stage(spark, [row(id="1", date="03/04/2021 12:00:00 AM"), row(id="2", date="03/04/2021 12:00:00 PM"),
                         row(id="3", date="03/04/2021 11:59:59 PM")])
    assert out[1].hora_ocorrencia == 0 and out[2].hora_ocorrencia == 12 and out[3].hora_ocorrencia == 23
    assert out[1].data_ocorrencia == dt.date(2021, 3, 4)


def test_unpadded_fields_parse_like_sql(spark):
    out = _stage(spark, [row(id="1", date="3/4/2021 1:02:03 PM"), row(id="2", date="03/04/2021 01:02:03 PM")])
    assert out[1].data_hora_ocorrencia == out[2].data_hora_ocorrencia == dt.datetime(2021, 3, 4, 13, 2, 3)


def test_flags_are_three_valued(spark):
    out = _stage(spark, [row(id="1", arrest="True"), row(id="2", arrest=" TRUE "), row(id="3", arrest=None),
                         row(id="4", arrest="no")])
    assert [out[i].flag_prisao for i in (1, 2, 3, 4)] == [True, True, None, False]


def test_text_cleaning(spark):
    out = _stage(spark, [row(id="1", iucr=" 031a ", location_description=" parking lot ", case_number="  ",
                             block=" 0XX BLOCK ")])
    r = out[1]
    assert r.iucr == "031A" and r.location_description == "PARKING LOT"
    assert r.case_number is None and r.block == "0XX BLOCK"


def test_bad_timestamp_strict_raises_lenient_nulls(spark):
    bad = [row(id="1", date="31/31/2020 99:00:00 XM")]
    with pytest.raises(Exception):
        stage_crimes(raw_rows(spark, bad)).collect()
    r = stage_crimes(raw_rows(spark, bad), lenient=True).collect()[0]
    assert r.data_hora_ocorrencia is None


def test_landing_csv_keeps_text(spark, tmp_path):
    from dimforge.sources.landing import read_landing

    p = tmp_path / "raw.csv"
    header = "ID,Case Number,Date,Block,IUCR,Primary Type,Description,Location Description,Arrest,Domestic,Beat," \
             "District,Ward,Community Area,FBI Code,X Coordinate,Y Coordinate,Year,Updated On,Latitude,Longitude,Location"
    line = '7,HX1,01/15/2010 10:30:00 AM," 001XX BLOCK ",0110,THEFT,"A, B",STREET,true,false,0421,004,,"",06,,,2010,' \
           '01/02/2014 03:04:05 PM,41.1,-87.5,"(41.1, -87.5)"'
    p.write_text(header + "\n" + line + "\n")
    r = read_landing(spark, str(p)).collect()[0]
    assert r.district == "004" and r.beat == "0421"
    assert r.block == " 001XX BLOCK " and r.description == "A, B"
    assert r.ward is None and r.community_area is None  # quoted empty -> NULL as well
    assert r.location == "(41.1, -87.5)"


def test_assert_unique_like_a_unique_index(spark):
    from dimforge.sources.tables import assert_unique

    ok = spark.createDataFrame([(1,), (2,), (None,), (None,)], "id int")
    assert_unique(ok, ["id"])
    with pytest.raises(ValueError, match="1 duplicated"):
        assert_unique(spark.createDataFrame([(1,), (1,), (2,)], "id int"), ["id"], "t")


def test_write_table_layout_round_trip(spark, tmp_path):
    from pyspark.sql import functions as F

    from dimforge.sources.tables import as_view, read_table, write_table

    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("ano"), (F.col("id") * 7 % 100).alias("k"))
    path = str(tmp_path / "t")
    write_table(df, path, partition_by=["ano"], sort_within=["k"], cluster_by=["ano"])
    back = read_table(spark, path)
    assert sorted(back.columns) == ["ano", "id", "k"]
    assert back.exceptAll(df.select(*back.columns)).count() == 0 and back.count() == 1000
    # full reload: overwrite replaces the previous contents
    write_table(df.where("id < 10"), path, mode="overwrite", partition_by=["ano"])
    assert read_table(spark, path).count() == 10
    assert as_view(read_table(spark, path), "t_view").sparkSession.table("t_view").count() == 10


def test_lenient_timestamps_equal_strict_ones_in_any_zone(spark):
    from pyspark.sql import functions as F

    from dimforge.functions.time import parse_us_timestamp

    good = ["03/10/2013 02:30:00 AM", "3/10/2013 2:30:00 AM", "11/03/2013 01:30:00 AM", "12/31/1999 12:00:00 AM", "01/01/2001 12:59:59 PM", "02/29/2012 11:59:59 PM", "7/4/2020 9:05:06 pm"]
    bad = ["02/30/2012 01:00:00 AM", "13/01/2012 01:00:00 AM", "01/01/2012 13:00:00 AM", "01/01/2012 00:10:00 AM", "01/01/2012 01:60:00 AM", "01/01/2012 01:00:60 AM", "garbage", "", None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("America/Chicago", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", z)
            df = spark.createDataFrame([(t,) for t in good], "t string")
            both = df.select(parse_us_timestamp(F.col("t")).alias("a"), parse_us_timestamp(F.col("t"), lenient=True).alias("b")).collect()
            assert all(r.a == r.b and r.a is not None for r in both)
            none = spark.createDataFrame([(t,) for t in bad], "t string").select(parse_us_timestamp(F.col("t"), lenient=True).alias("b")).collect()
            assert all(r.b is None for r in none)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_lenient_losses_are_counted(spark):
    from dimforge.plans.staging import lenient_losses

    df = raw_rows(spark, [row(id="1"), row(id="x2"), row(id="3", date="13/45/2010 10:00:00 AM"), row(id="4", latitude="north", updated_on="soon"), row(id=None, date="junk")])
    assert lenient_losses(df).first().asDict() == {"date": 1, "updated_on": 1, "id": 1, "latitude": 1, "longitude": 0}
    assert stage_crimes(df, lenient=True).count() == 4
