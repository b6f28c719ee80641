"""Dependency discovery against counting by hand, and sketches against exact counts."""

import itertools
import random

from pyspark.sql import functions as F

from conftest import SF001
from dimforge.plans.dependencies import dependencies
from dimforge.plans.profiling import CARDINALITY, cardinality_sketches, merged_cardinality, prof_cardinality
from dimforge.sources.fixture import crimes_raw


def brute(rows, names, max_size, max_error):
    found = []
    for size in range(1, max_size + 1):
        new = []
        for x in itertools.combinations(range(len(names)), size):
            for a in range(len(names)):
                if a in x or any(d == a and set(y) <= set(x) for y, d, *_ in found) or any(d in x and set(y) <= set(x) - {d} for y, d, *_ in found):
                    continue
                classes: dict = {}
                for r in rows:
                    if all(r[c] is not None for c in (*x, a)):
                        classes.setdefault(tuple(r[c] for c in x), []).append(r[a])
                n = sum(map(len, classes.values()))
                bad = sum(len(v) - max(v.count(k) for k in set(v)) for v in classes.values())
                if n and bad <= max_error * n:
                    new.append((x, a, n, bad))
        found += new
    return {("+".join(names[c] for c in x), names[a], n, bad) for x, a, n, bad in found}


def test_random_tables_against_brute_force(spark):
    names = ["a", "b:", "c d", "e", "id"]
    for seed in range(4):
        r = random.Random(seed)
        rows = []
        for _ in range(300):
            a, b = r.choice(["1", "11", "111", None]), r.choice(["1:", "11", ":1"])
            rows.append((a, b, (a or "") + b if r.random() > 0.03 else "odd", r.choice("xyz") if r.random() > 0.1 else None, r.choice(["k", None])))
        for error in (0.0, 0.05, 0.2):
            got = dependencies(spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names)), names, 3, error).collect()
            assert {(x.determinant, x.dependent, x.linhas, x.violacoes) for x in got} == brute(rows, names, 3, error)
    assert dependencies(spark.createDataFrame([], "a string, b string"), ["a", "b"]).count() == 0


def test_the_known_dependencies_are_found(spark):
    raw = crimes_raw(spark, SF001)
    got = {(r.determinant, r.dependent): r.taxa_erro for r in dependencies(raw, ["iucr", "primary_type", "fbi_code", "beat", "district", "arrest"]).collect()}
    assert 0 < got["beat", "district"] < 0.05  # beats whose district changed
    assert ("iucr", "fbi_code") in got and ("arrest", "district") not in got


def test_sketches_merge_without_the_rows(spark):
    raw = crimes_raw(spark, SF001)
    sketches = cardinality_sketches(raw, "year")
    assert merged_cardinality(sketches).first().asDict() == prof_cardinality(raw).first().asDict()  # small counts are exact
    plan = prof_cardinality(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    many = spark.range(300_000).select(*[(F.col("id") % (20_000 * (k + 1))).cast("string").alias(c) for k, c in enumerate(dict.fromkeys(CARDINALITY.values()))], (F.col("id") % 5).alias("year"))
    estimate, exact = merged_cardinality(cardinality_sketches(many, "year")).first(), prof_cardinality(many).first()
    assert all(abs(estimate[a] - exact[a]) <= 0.03 * exact[a] for a in CARDINALITY)
    nothing = merged_cardinality(cardinality_sketches(raw.where("false"), "year")).first()
    assert set(nothing.asDict().values()) == {0}
