"""The generated dimensions (calendar, hours, flags, months) against their DuckDB
definitions, every column of every row. They run on fixed input, so they are checked here
rather than registered as queries."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT

sys.path.insert(0, os.path.join(ROOT, "scripts"))

from check_oracle import digest  # noqa: E402
from dimforge.plans import dims  # noqa: E402
from dimforge.plans import oracle as O  # noqa: E402


def _duck(sql_body: str, *deps: tuple[str, str]):
    con = duckdb.connect()
    ctes = ",\n".join(f"{n} AS ({b})" for n, b in deps)
    cur = con.execute(f"WITH {ctes}, q AS ({sql_body}) SELECT * FROM q" if deps else sql_body)
    return [d[0] for d in cur.description], cur.fetchall()


@pytest.mark.parametrize("name", ["dim_data", "dim_hora", "dim_flags", "dim_mes"])
def test_generated_dimension_matches_sql(spark, name):
    if name == "dim_mes":
        df = dims.dim_mes(dims.dim_data(spark))
        cols, rows = _duck(O.DIM_MES, ("dim_data", O.DIM_DATA))
    else:
        df = getattr(dims, name)(spark)
        cols, rows = _duck({"dim_data": O.DIM_DATA, "dim_hora": O.DIM_HORA, "dim_flags": O.DIM_FLAGS}[name])
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(rows)
    assert digest(df.columns, got)[0] == digest(cols, rows)[0]
