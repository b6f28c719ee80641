"""Ball k-means codes against plain k-means in Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimforge.llm import queries, vector_codes

SF0001 = "/root/testdata/sf0.001"

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """(id, label) -> (codes, error) as a sorted list, and the entries."""
    kept = [(i, v, y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    whole = [(i, [math.floor(x * 4096) for x in v] + [0] * (width - len(v)), y) for i, v, y in kept]
    w = width // parts
    seeds: dict = {}
    for i, v, _ in sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        seeds.setdefault(i, v)
    seeds = list(seeds.values())[:entries]
    books = [[s[p * w:(p + 1) * w] for s in seeds] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * w:(p + 1) * w], e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds if whole else 0):
        for p in range(parts):
            groups: dict = {}
            for _, v, _ in whole:
                groups.setdefault(nearest(v, p)[1], []).append(v[p * w:(p + 1) * w])
            for k, g in groups.items():
                books[p][k] = [sum(c) // len(g) for c in zip(*g)]
    out = []
    for i, v, y in whole:
        got = [nearest(v, p) for p in range(parts)]
        out.append((i, y, tuple(k for _, k in got), sum(d for d, _ in got)))
    return out, books


def order(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def spark_rows(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("id", "block", "codes", "error", "label_error", "v", "vectors")}).repartition(5)
    coded, book = vector_codes.encode(df, **options)
    return [(r.vec_id, r.label, tuple(r.codes), r.error) for r in coded.collect()], book.tolist(), coded


def test_random_vectors_with_ties_repeats_and_bad_rows(spark):
    r = random.Random(3)
    rows = [(i, [r.choice((-0.5, 0.0, 0.25, 1.0)) + r.choice((0, r.random())) for _ in range(16)], r.choice((0, 1, None))) for i in range(300)]
    rows += [rows[7], rows[7], (None, rows[3][1], 1), (None, rows[4][1], None), (900, None, 1), (901, [1.0, None], 0), (902, [float("nan")] * 16, 0), (903, [float("-inf")] * 16, 0),
             (904, [0.5] * 3, 2), (905, [], 2), (5, [-1.0] * 16, 0)]
    got, book, coded = spark_rows(spark, rows, block=37)
    expected, books = brute(rows)
    assert sorted(got, key=order) == sorted(expected, key=order)
    assert book == books
    sums: dict = {}
    for _, y, _, e in expected:
        sums[y] = sums.get(y, 0) + e
    assert {r.label: r.label_error for r in vector_codes.with_label_error(coded).collect()} == sums


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(None, [0.1] * 8, None)], [(4, [0.3, -0.2], 1), (2, [0.1, 0.1], 1)], [(1, [1e-320, 3.0] * 8, 0)] * 5])
def test_small_tables(spark, rows):
    got, book, _ = spark_rows(spark, rows)
    expected, books = brute(rows)
    assert sorted(got, key=order) == sorted(expected, key=order)
    assert book == books


def test_components_beyond_16_bits_and_beyond_the_limit(spark):
    rows = [(i, [i * 900.0, -i * 7.5] * 8, i % 2) for i in range(60)]
    got, book, _ = spark_rows(spark, rows, rounds=2, entries=4)
    expected, books = brute(rows, entries=4, rounds=2)
    assert sorted(got, key=order) == sorted(expected, key=order) and book == books
    with pytest.raises(Exception, match="must stay below"):
        spark_rows(spark, [(1, [1e9] * 8, 0)])


def test_assignment_skips_stable_parts_and_compares_rings_only(monkeypatch):
    r = np.random.default_rng(5)
    centres = r.integers(-9000, 9000, (16, 8))
    x = centres[r.integers(0, 16, 4000)] + r.integers(-300, 300, (4000, 8))
    compared = []
    square = np.square
    monkeypatch.setattr(np, "square", lambda a: (compared.append(len(a)), square(a))[1])
    start, _ = vector_codes.assign(x, centres, np.zeros(len(x), int))
    compared.clear()
    best, dist = vector_codes.assign(x, centres + r.integers(-50, 50, (16, 8)), start)
    assert sum(compared) < 1.3 * len(x)  # a full comparison takes 16 of them
    monkeypatch.undo()
    book = centres
    best, dist = vector_codes.assign(x, book, np.full(len(x), 3))
    full = np.square(x[:, None] - book[None]).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (dist == full.min(axis=1)).all()


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    expected, books = brute(rows)
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    sums: dict = {}
    for _, y, _, e in expected:
        sums[y] = sums.get(y, 0) + e
    got = sorted(tuple(r) for r in queries.op11_ball_kmeans(spark, SF0001).collect())
    assert got == sorted((i, "".join(f"{k:02x}" for k in codes), e, sums[y], sha) for i, y, codes, e in expected)
