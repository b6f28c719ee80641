"""The warehouse's 66 data tests (4 on the source, 6 on staging, 56 on the marts) and
their oracle SQL, generated from one list of test definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.quality import DataTest, run_suite
from .warehouse import Warehouse


def _nn(model, *cols):
    return [DataTest("not_null", model, (c,)) for c in cols]


def _key(model, col):
    return [DataTest("not_null", model, (col,)), DataTest("unique", model, (col,))]


def _fk(model, col, parent, field=None):
    return [DataTest("not_null", model, (col,)), DataTest("relationships", model, (col,), parent, field or col)]


def _av(model, col, values):
    return [DataTest("not_null", model, (col,)), DataTest("accepted_values", model, (col,), values=tuple(values))]


SUITE: list[DataTest] = [
    # source
    *_key("crimes_raw", "id"), *_nn("crimes_raw", "date", "iucr"),
    # staging
    *_key("stg_crimes", "id_ocorrencia"),
    *_nn("stg_crimes", "data_hora_ocorrencia", "iucr", "flag_prisao", "flag_domestico"),
    # transaction fact
    *_key("fct_ocorrencias", "sk_ocorrencia"), *_key("fct_ocorrencias", "id_ocorrencia"),
    *_fk("fct_ocorrencias", "sk_data", "dim_data"), *_fk("fct_ocorrencias", "sk_hora", "dim_hora"),
    *_fk("fct_ocorrencias", "sk_crime", "dim_crime"), *_fk("fct_ocorrencias", "sk_geografia", "dim_geografia"),
    *_fk("fct_ocorrencias", "sk_local", "dim_local"), *_fk("fct_ocorrencias", "sk_flags", "dim_flags"),
    *_av("fct_ocorrencias", "qtd_ocorrencia", [1]), *_av("fct_ocorrencias", "qtd_prisao", [0, 1]),
    *_av("fct_ocorrencias", "qtd_domestico", [0, 1]),
    # dimensions
    *_key("dim_data", "sk_data"), *_key("dim_hora", "sk_hora"),
    *_key("dim_crime", "sk_crime"), *_nn("dim_crime", "iucr", "valido_de", "valido_ate"),
    *_key("dim_geografia", "sk_geografia"), *_nn("dim_geografia", "beat", "valido_de", "valido_ate"),
    *_key("dim_local", "sk_local"), *_key("dim_flags", "sk_flags"),
    # monthly fact
    *_fk("fct_desempenho_mensal", "sk_mes", "dim_mes"), *_fk("fct_desempenho_mensal", "sk_distrito", "dim_distrito"),
    *_fk("fct_desempenho_mensal", "sk_tipo_crime", "dim_tipo_crime"),
    *_nn("fct_desempenho_mensal", "qtd_ocorrencias", "qtd_prisoes", "qtd_domesticos"),
    DataTest("unique_combination", "fct_desempenho_mensal", ("sk_mes", "sk_distrito", "sk_tipo_crime")),
    # shrunken dimensions
    *_key("dim_mes", "sk_mes"), *_key("dim_distrito", "sk_distrito"), *_key("dim_tipo_crime", "sk_tipo_crime"),
]


def suite_tables(w: Warehouse) -> dict[str, DataFrame]:
    t = w.tables()
    t["crimes_raw"] = w.raw
    return t


def run(w: Warehouse, kinds: tuple[str, ...] | None = None) -> DataFrame:
    tests = [t for t in SUITE if kinds is None or t.kind in kinds]
    return run_suite(suite_tables(w), tests)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def test_sql(t: DataTest) -> str:
    """One test as DuckDB SQL returning (test_name, model, column_name, failures)."""
    c = t.columns[0]
    if t.kind == "not_null":
        f = f"(SELECT count(*) FROM {t.model} WHERE {c} IS NULL)"
    elif t.kind == "unique":
        f = f"(SELECT count(*) FROM (SELECT {c} FROM {t.model} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
    elif t.kind == "unique_combination":
        cols = ", ".join(t.columns)
        f = f"(SELECT count(*) FROM (SELECT {cols} FROM {t.model} GROUP BY {cols} HAVING count(*) > 1))"
    elif t.kind == "relationships":
        f = (f"(SELECT count(*) FROM {t.model} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {t.parent} pa WHERE pa.{t.parent_field} = ch.{c}))")
    elif t.kind == "accepted_values":
        vals = ", ".join(str(v) for v in t.values)
        f = f"(SELECT count(DISTINCT {c}) FROM {t.model} WHERE {c} NOT IN ({vals}))"
    else:
        raise ValueError(t.kind)
    return (f"SELECT {_q(t.name)} AS test_name, {_q(t.model)} AS model, {_q(t.column_name)} AS column_name, "
            f"CAST({f} AS BIGINT) AS failures")


def suite_sql(kinds: tuple[str, ...] | None = None) -> str:
    tests = [t for t in SUITE if kinds is None or t.kind in kinds]
    return "SELECT * FROM (" + "\nUNION ALL ".join(test_sql(t) for t in tests) + ")"
