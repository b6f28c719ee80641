"""Hand-written edge rows through the whole build (FIXTURES section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import raw_rows, row
from dimforge.plans import quality as Q
from dimforge.plans.warehouse import SnapshotRun, Warehouse

RUNS = (
    SnapshotRun(dt.datetime(2011, 1, 1), "year(data_hora_ocorrencia) <= 2010", "year(data_hora_ocorrencia) <= 2010"),
    SnapshotRun(dt.datetime(2012, 6, 1), "true", "true"),
)


@pytest.fixture(scope="module")
def w(spark):
    rows = [
        # code C1 changes type (and category) between the runs
        row(id="1", iucr="C1", primary_type="THEFT", date="05/01/2010 10:00:00 AM"),
        row(id="2", iucr="C1", primary_type="BATTERY", date="01/01/2012 10:00:00 AM"),
        # incident exactly at the start of the new version -> new version
        row(id="3", iucr="C1", primary_type="BATTERY", date="06/01/2012 12:00:00 AM"),
        # code first seen after the first run: not back-dated (S3), older incident -> '-1'
        row(id="4", iucr="NEW1", primary_type="ROBBERY", date="03/01/2011 10:00:00 AM"),
        row(id="5", iucr="NEW1", primary_type="ROBBERY", date="07/01/2012 10:00:00 AM"),
        # date before the calendar: sk_data -1, kept in P1, missing from P2
        row(id="6", iucr="C1", primary_type="BATTERY", date="02/02/1999 01:00:00 PM"),
        # NULL beat and NULL location -> unknown members, row kept
        row(id="7", beat=None, location_description=None, iucr="C1", primary_type="BATTERY",
            date="08/01/2012 10:00:00 AM"),
        # NULL district but known beat: the beat's version from other rows is used
        row(id="8", district=None, iucr="C1", primary_type="BATTERY", date="09/01/2012 10:00:00 AM"),
        # NULL arrest flag -> sk_flags NULL (S2), measure 0
        row(id="9", arrest=None, iucr="C1", primary_type="BATTERY", date="10/01/2012 10:00:00 AM"),
    ]
    return Warehouse(spark, raw_rows(spark, rows), runs=RUNS)


def _fact(w):
    return {r.id_ocorrencia: r for r in w.fct_ocorrencias.collect()}


def test_keys_of_edge_incidents(w):
    f = _fact(w)
    crime = {(r.iucr, r.primary_type): r for r in w.dim_crime.collect()}
    c1_old, c1_new = crime[("C1", "THEFT")], crime[("C1", "BATTERY")]
    assert c1_old.valido_de == dt.datetime(1900, 1, 1) and c1_old.valido_ate == dt.datetime(2012, 6, 1)
    assert f[1].sk_crime == c1_old.sk_crime and f[2].sk_crime == c1_old.sk_crime
    assert f[3].sk_crime == c1_new.sk_crime
    new1 = crime[("NEW1", "ROBBERY")]
    assert new1.valido_de == dt.datetime(2012, 6, 1)
    assert f[4].sk_crime == "-1" and f[5].sk_crime == new1.sk_crime
    assert f[6].sk_data == -1
    assert f[7].sk_geografia == "-1" and f[7].sk_local == "-1"
    assert f[8].sk_geografia != "-1"
    assert f[9].sk_flags is None and f[9].qtd_prisao == 0
    assert len(f) == 9


def test_category_follows_historical_type_and_duplicates_type_key(w):
    cats = {r.primary_type: r.categoria_analitica for r in w.dim_crime.where("iucr = 'C1'").collect()}
    assert cats == {"THEFT": "Crime patrimonial", "BATTERY": "Crime violento"}
    t = w.dim_tipo_crime.where("primary_type = 'BATTERY'").collect()
    assert len(t) == 2 and len({r.sk_tipo_crime for r in t}) == 1   # S7
    res = {r.test_name: r.failures for r in Q.run(w, ("unique",)).collect()}
    assert res["unique_dim_tipo_crime_sk_tipo_crime"] == 1


def test_monthly_fact_drops_undated_and_fans_out_duplicate_type(w):
    p2 = w.fct_desempenho_mensal
    # the 1999 incident has no calendar day and is missing; BATTERY rows fan out x2
    n_battery_dated = 6  # ids 2, 3, 7, 8, 9 (current type) + id 1 (code C1's current type)
    total = p2.agg(F.sum("qtd_ocorrencias")).first()[0]
    assert total == 2 * n_battery_dated + 2  # + NEW1 incidents (ROBBERY) once each
