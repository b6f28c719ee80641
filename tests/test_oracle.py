"""Every registered query vs its DuckDB oracle on the smallest driver tables
(scripts/check_oracle.py does the same at sf0.01). DIMFORGE_QUICK_ORACLE=1 runs a
representative subset only."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF0001

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as E  # noqa: E402
from dimforge.plans import registry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

DEFAULT = ["stg_crimes", "snap_geografia", "snapshot_replay", "dim_crime", "dim_geografia", "fct_ocorrencias",
           "fct_desempenho_mensal", "rpt_p1", "rpt_p1_rollup", "drill_across", "prof_description_drift",
           "dq_report", "scd2_from_events", "landing_csv"]
KEYS = DEFAULT if os.environ.get("DIMFORGE_QUICK_ORACLE") else list(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(registry.QUERIES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_results_are_client_neutral(spark, con):
    """No registered result (either side) carries a DECIMAL, DATE or TIMESTAMP column, and
    every result converts to pandas (the 9999-12-31 sentinel is text)."""
    for key, q in registry.QUERIES.items():
        df = q(spark, SF0001)
        assert not any(t.startswith(("decimal", "timestamp", "date")) for _, t in df.dtypes), key
        types = [str(r[1]) for r in con.execute(f"DESCRIBE {E.oracle_sql()[key]}").fetchall()]
        assert not any(t.startswith(("DECIMAL", "TIMESTAMP", "DATE")) for t in types), key
    E.queries()["dim_crime"](spark, SF0001).toPandas()


SPARK_TO_DUCKDB = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                   "boolean": "BOOLEAN"}


def test_column_types_correspond(spark, con):
    for key, q in registry.QUERIES.items():
        spark_types = dict(q(spark, SF0001).dtypes)
        duck_types = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {E.oracle_sql()[key]}").fetchall()}
        for col, t in spark_types.items():
            assert SPARK_TO_DUCKDB.get(t, t) == duck_types.get(col), (key, col, t, duck_types.get(col))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "taxa_prisao_pct" in df.columns
