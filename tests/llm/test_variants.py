"""Spelling variants against a plain search over all pairs."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from edge import DOCS, frame, repeated, words

from dimforge.llm import queries, variants

SF0001 = "/root/testdata/sf0.001"

def near(a: str, b: str) -> bool:
    """One edit by definition: some deletion of the longer gives the other, or one place differs."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_counts(docs, dropped_every=199) -> Counter:
    out: Counter = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % dropped_every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                out[w] += 1
    return out


def brute(n: dict[str, int]) -> set[tuple]:
    """Words share a half with their neighbours: pairs come from those, and are judged by definition."""
    close: dict[str, set] = {w: set() for w in n}
    halves: dict[tuple, set] = {}
    for w in n:
        for h in {len(w) // 2, (len(w) - 1) // 2}:
            halves.setdefault((h, w[:h], 0), set()).add(w)
            halves.setdefault((h, w[len(w) - h:], 1), set()).add(w)
    for group in halves.values():
        for a, b in itertools.combinations(group, 2):
            if near(a, b):
                close[a].add(b)
                close[b].add(a)
    form = {}
    for w, c in close.items():
        best = min(c, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    root = {}
    for w in n:
        x = w
        while form[x]:
            x = form[x]
        root[w] = x
    return {(w, form[w], root[w], n[w], len(close[w]), n[form[w]] if form[w] else None) for w in n}


def collected(df) -> list[tuple]:
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def same(got: list[tuple], expected: set[tuple]):
    assert len(got) == len(set(got)) and set(got) == expected


def vocabulary(size: int, seed: int, letters: str = "aeéiqÿ÷") -> dict[str, int]:
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(5, 8))): r.choice((5, 6, 30, 200, 2000, 20000)) for _ in range(size)}


def test_one_edit():
    r = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(r.choice("ab") for _ in range(r.randint(0, 6))) for _ in "ab")
        assert variants.one_edit(a, b) == near(a, b)


@pytest.mark.parametrize("limits", [{}, {"shard_words": 40, "shard_asked": 60}, {"shard_words": 3, "shard_asked": 1000, "step": 6}, {"groups": ("a", "e"), "step": 1, "shard_words": 7}])
def test_random_words_with_small_and_split_shards(spark, limits):
    n = vocabulary(500, 2)
    same(collected(variants.variants(spark.createDataFrame([*n.items()], "word string, n long").repartition(7), **limits)), brute(n))


def test_one_leaf_holds_a_third_of_the_words(spark):
    r = random.Random(4)
    hot = {"".join(r.sample("abcdeabc", 8)) for _ in range(600)}  # one vector
    n = {w: r.choice((5, 100)) for w in hot} | vocabulary(300, 5) | {w[:4] + "x" + w[4:]: 7 for w in list(hot)[:100]}
    same(collected(variants.variants(spark.createDataFrame([*n.items()], "word string, n long"), shard_words=50, shard_asked=200)), brute(n))


def test_long_chains_find_their_root(spark):
    n = {"abcdef" + "g" * k: 5 ** (k + 1) for k in range(18)}
    got = collected(variants.variants(spark.createDataFrame([*n.items()], "word string, n long")))
    same(got, brute(n))
    assert {r[2] for r in got} == {"abcdef" + "g" * 17}


def test_edge_rows_and_dropped_letters(spark):
    data = repeated() + [(i, "Naïveté naïveté ÉCOLIER ÷×÷×÷×÷ colouring" + " colorings" * 6, "en", None, 1) for i in range(700, 1500)] + [(9, "q" * 30_000 + " " + "q" * 30_001, None, None, None)] * 6
    data += [(2, "wonderful1wonderful_wonderfuł wonderful", "en", "s", 1)] * 3 + [(2000, words(3000, 8, 50) + " colouring" * 50, "en", "s", 1)]
    expected = {w: c for w, c in brute_counts([r[:2] for r in data]).items() if c >= 5}
    assert any(w in expected for w in ("olorings", "coorings", "colrings", "coloings", "colorngs", "colorigs", "colorins", "coloring"))  # a letter was dropped
    same(collected(variants.spelling_variants(frame(spark, data).repartition(4))), brute(expected))


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "", "en", "s", 0), (2, "12 34 ab", None, None, None)]])
def test_without_words(spark, rows):
    assert variants.spelling_variants(spark.createDataFrame(rows, DOCS)).collect() == []


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    same(collected(queries.op12_frequency_vector_trie(spark, SF0001)), brute({w: c for w, c in brute_counts(docs).items() if c >= 5}))
