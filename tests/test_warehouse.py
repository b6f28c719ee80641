"""Properties of the whole build on the driver's sf0.01 tables (FIXTURES section 6)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from dimforge.plans import quality as Q
from dimforge.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def w(spark):
    return Warehouse.from_sf(spark, SF001, materialize=True)


def test_no_incident_is_lost(w):
    n = w.stg.count()
    assert n == 60000  # one incident per lineitem row
    assert w.fct_ocorrencias.count() == n
    assert w.fct_ocorrencias.select("id_ocorrencia").distinct().count() == n


def test_snapshot_history_sizes(w):
    assert w.snap_crime.count() == 57
    assert w.snap_geografia.count() == 116
    assert w.snap_geografia.where("dbt_valid_to IS NULL").count() == 100


def test_replay_equals_folded_runs(spark, w):
    fold = Warehouse.from_sf(spark, SF001, history="merge")
    for name in ("snap_crime", "snap_geografia"):
        a = getattr(w, name)
        b = getattr(fold, name).select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_unknown_geography_rows(w):
    f = w.fct_ocorrencias.where(F.col("sk_geografia") == "-1")
    null_beat = w.stg.where(F.col("beat").isNull()).count()
    assert null_beat == w.raw.where("beat IS NULL").count() > 0
    # run 2 closes the 24xx beats, run 3 reopens them
    gap = w.stg.where("beat >= 2400 AND data_hora_ocorrencia >= '2012-06-01' AND data_hora_ocorrencia < '2013-01-01'").count()
    assert gap > 0 and f.count() == null_beat + gap


def test_no_runs_are_invented(spark):
    """Beats of 2400 and more keep their geography unless the caller's runs close them."""
    import datetime as dt

    from conftest import raw_rows, row

    from dimforge.plans.warehouse import SnapshotRun, Warehouse

    rows = [row(id=str(i), beat=b, date="07/01/2012 10:00:00 AM") for i, b in enumerate(["2411", "2433", "0421", "9999"], 1)]
    w = Warehouse(spark, raw_rows(spark, rows), [SnapshotRun(dt.datetime(2013, 1, 1))])
    assert w.fct_ocorrencias.where("sk_geografia = '-1'").count() == 0


def test_monthly_fact_sums_equal_transaction_fact(w):
    p1 = w.fct_ocorrencias.where("sk_data <> -1").agg(F.sum("qtd_ocorrencia"), F.sum("qtd_prisao"),
                                                       F.sum("qtd_domestico")).first()
    p2 = w.fct_desempenho_mensal.agg(F.sum("qtd_ocorrencias"), F.sum("qtd_prisoes"), F.sum("qtd_domesticos")).first()
    assert tuple(p1) == tuple(p2)


def test_data_test_suite(w):
    res = {r.test_name: r.failures for r in Q.run(w).collect()}
    assert len(res) == 66
    failing = {k: v for k, v in res.items() if v}
    # Closed districts collapse into the unknown district key, repeating (month, '-1', type)
    assert failing == {"unique_combination_fct_desempenho_mensal_sk_mes_sk_distrito_sk_tipo_crime": 520}


def test_documented_intent_options(spark, w):
    from dimforge.plans import dims, facts

    cal = dims.dim_data(spark, unknown_member=True)
    assert cal.where("sk_data = -1").count() == 1 and cal.count() == 9497
    args = (w.fct_ocorrencias, w.dim_data, w.dim_geografia, w.dim_crime, w.dim_mes, w.dim_distrito, w.dim_tipo_crime)
    regrouped = facts.fct_desempenho_mensal(*args, regroup=True)
    keys = ["sk_mes", "sk_distrito", "sk_tipo_crime"]
    assert regrouped.groupBy(*keys).count().where("count > 1").count() == 0
    closed = facts.fct_desempenho_mensal(*args, include_closed=True)
    # closed districts 13, 21, 23 keep their own key: far fewer rows fall into '-1'
    base = w.fct_desempenho_mensal
    assert closed.where("sk_distrito = '-1'").count() < base.where("sk_distrito = '-1'").count()
    for df in (regrouped, closed):
        assert df.agg(F.sum("qtd_ocorrencias")).first()[0] == base.agg(F.sum("qtd_ocorrencias")).first()[0]


def test_drill_through_several_cells(spark, w):
    from dimforge.plans import reports as R

    a = R.drill_through(w, 2012, 6, 12, "Crime violento")
    b = R.drill_through(w, 2010, 3, 5, "Crime patrimonial")
    cells = spark.createDataFrame([(2012, 6, 12, "Crime violento"), (2010, 3, 5, "Crime patrimonial")],
                                  "ano int, numero_mes int, district int, categoria_analitica string")
    both = R.drill_through_cells(w, cells)
    assert a.count() > 0 and b.count() > 0
    assert both.exceptAll(a.unionByName(b)).count() == 0 and a.unionByName(b).exceptAll(both).count() == 0
    assert R.drill_through_cells(w, cells.limit(0)).count() == 0


def test_reports_read_only_the_years_asked_for(w):
    from dimforge.plans import reports as R

    plan = R.report_p1(w, year_from=2010, year_to=2011, district=12)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_fato" in plan and "(ano_fato" in plan
    assert w.fct_ocorrencias.select("ano_fato").distinct().count() == w.stg.selectExpr("year(data_ocorrencia)").distinct().count()


def test_planning_reports_starts_no_job(spark, w):
    from dimforge.plans import reports as R

    w.build()
    group = "planning"
    spark.sparkContext.setJobGroup(group, group)
    R.report_p1(w, **R.P1_DEFAULTS)
    R.report_p2(w, **R.P2_DEFAULTS)
    R.drill_through(w)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
