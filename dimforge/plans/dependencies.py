"""R7 / R9 without being told where to look: which attributes determine which, and how often not.

An attribute set X determines A in as far as rows that agree on X agree on A. The error share of X -> A is the part of
the rows that would have to go for it to hold: all but the most frequent value of A in every class of X. Sets are searched by size.
A dependency within the error bound ends the search above it: larger sets for the same A, and sets with a member
that the others already determine, say nothing new.

The rows are grouped once by all attributes. Every candidate of a size is then a refinement of those combinations: all
of them are counted in one job, by (candidate, X, A) and then by (candidate, X), partially aggregated, so no class
of rows meets in one task. The driver gets one row per candidate.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

RESULT = "determinant string, dependent string, linhas long, violacoes long, taxa_erro double"


def _values(cols: Sequence[str]) -> Column:
    """Several values as one text; lengths keep them apart. NULL if one of them is."""
    return F.concat(*[F.concat(F.length(F.col(f"`{c}`")), F.lit(":"), F.col(f"`{c}`")) for c in cols])


def _counted(combos: DataFrame, candidates: list[tuple[tuple[str, ...], str]]) -> DataFrame:
    """linhas and violacoes of every candidate (by its number); rows with a NULL in X or A do not count."""
    cells = F.array(*[F.struct(F.lit(i).alias("c"), _values(x).alias("x"), F.col(f"`{a}`").alias("a")) for i, (x, a) in enumerate(candidates)])
    each = combos.select(F.explode(cells).alias("_e"), "_n").select("_e.c", "_e.x", "_e.a", "_n").where("x IS NOT NULL AND a IS NOT NULL")
    pairs = each.groupBy("c", "x", "a").agg(F.sum("_n").alias("n"))
    classes = pairs.groupBy("c", "x").agg(F.sum("n").alias("rows"), F.max("n").alias("kept"))
    return classes.groupBy("c").agg(F.sum("rows").alias("rows"), F.sum(F.col("rows") - F.col("kept")).alias("bad"))


def dependencies(rows: DataFrame, attributes: Sequence[str], max_size: int = 2, max_error: float = 0.05) -> DataFrame:
    """The minimal dependencies of up to ``max_size`` attributes on the left whose error share is at most ``max_error``.

    Attributes are compared as text, NULLs are left out, an attribute without two values on a candidate's rows is determined by
    everything (that is what the rows say); a candidate without rows is no dependency. No rows give no dependencies.
    """
    spark = rows.sparkSession
    combos = rows.select(*[F.col(f"`{a}`").cast("string").alias(a) for a in attributes]).groupBy(*[f"`{a}`" for a in attributes]).agg(F.count(F.lit(1)).alias("_n"))
    combos = materialize(spark, combos, "combinations")
    found: list[tuple[tuple[str, ...], str, int, int]] = []
    for size in range(1, max_size + 1):
        holds = lambda x, a: any(a == d and set(y) <= set(x) for y, d, _, _ in found)
        candidates = [(x, a) for x in combinations(attributes, size) for a in attributes
                      if a not in x and not holds(x, a) and not any(holds(tuple(c for c in x if c != b), b) for b in x)]
        if not candidates:
            break
        counts = {r.c: r for r in _counted(combos, candidates).collect()}
        found += [(x, a, counts[i]["rows"], counts[i].bad) for i, (x, a) in enumerate(candidates) if i in counts and counts[i].bad <= max_error * counts[i]["rows"]]
    return spark.createDataFrame([("+".join(x), a, n, bad, bad / n) for x, a, n, bad in found], RESULT)


def dependencies_sql(table: str, attributes: Sequence[str], max_error: float = 0.05) -> str:
    """The same for up to two attributes on the left as SQL: every candidate by a query of its own, then the minimal ones."""
    def one(x: tuple[str, ...], a: str) -> str:
        keys, known = ", ".join(x), " AND ".join(f"{c} IS NOT NULL" for c in (*x, a))
        return (f"SELECT {list(x)} AS lhs, '{a}' AS dependent, sum(n) AS linhas, sum(n) - sum(most) AS violacoes FROM (SELECT sum(k) AS n, max(k) AS most FROM "
                f"(SELECT {keys}, {a}, count(*) AS k FROM {table} WHERE {known} GROUP BY {keys}, {a}) GROUP BY {keys})")

    every = " UNION ALL ".join(one(x, a) for size in (1, 2) for x in combinations(attributes, size) for a in attributes if a not in x)
    return f"""
SELECT array_to_string(lhs, '+') AS determinant, dependent, CAST(linhas AS BIGINT) AS linhas, CAST(violacoes AS BIGINT) AS violacoes, violacoes / linhas AS taxa_erro
FROM (SELECT * FROM every_dependency WHERE linhas > 0 AND violacoes <= {max_error!r} * linhas) d
WHERE len(lhs) = 1 OR NOT EXISTS (
  SELECT 1 FROM every_dependency s WHERE len(s.lhs) = 1 AND s.linhas > 0 AND s.violacoes <= {max_error!r} * s.linhas
    AND ((s.dependent = d.dependent AND list_contains(d.lhs, s.lhs[1])) OR (list_contains(d.lhs, s.lhs[1]) AND list_contains(d.lhs, s.dependent))))""".replace(
        "every_dependency", "(" + every + ")")
