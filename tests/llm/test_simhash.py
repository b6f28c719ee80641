import numpy as np
import xxhash
from edge import frame, repeated, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from dimforge.llm import simhash
from dimforge.llm.components import connected_components


def brute_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def classes(fps, radius=2):
    """Component of each of the fingerprints, by all pairs."""
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_documents_match_brute_force(spark):
    data = rows()
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, data)).collect()}
    fps = [brute_fingerprint(d[1]) for d in data]
    label = classes(fps)
    for d, fp, x in zip(data, fps, label):
        assert got[d[0]].fingerprint == f"{fp:016x}"
        assert got[d[0]].component_id == min(e[0] for e, y in zip(data, label) if x == y)
    assert got[102].component_id == got[103].component_id == got[104].component_id == 102  # no words: fingerprint 0


def test_repeats_and_null_ids(spark):
    docs = frame(spark, repeated())
    assert simhash.near_duplicates(docs).count() == len(repeated())
    kept = simhash.representatives(docs).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert sorted(ids) == sorted([*set(ids), 12]) and sum(r.doc_id is None for r in kept) == 3
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def spread(n, seed, bits):
    r = np.random.default_rng(seed)
    base = int(r.integers(0, 1 << 62))
    return sorted({base ^ int(sum(1 << int(b) for b in r.choice(bits, r.integers(0, 5), replace=False))) for _ in range(n)})


def test_dense_groups_are_split_without_losing_links(spark):
    fps = spread(400, 1, 24) + spread(60, 2, 64)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for tree in (8, 512):
        links = [(r.u % (1 << 64), r.v % (1 << 64)) for r in simhash.fingerprint_links(df, 2, tree).collect()]
        assert all(a in fps and b in fps for a, b in links)
        at, label = {f: i for i, f in enumerate(fps)}, list(range(len(fps)))
        for a, b in links:
            old, new = sorted((label[at[a]], label[at[b]]), reverse=True)
            label = [new if x == old else x for x in label]
        want = classes(fps)
        assert len(set(zip(label, want))) == len(set(label)) == len(set(want))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=40, unique=True), st.integers(0, 8))
def test_tree_search_finds_all_pairs(values, radius):
    fp = np.array(values + [v ^ 5 for v in values if v ^ 5 not in values], np.uint64)
    group = np.zeros(len(fp), np.int64)
    q, n = simhash.bk_search(fp, *simhash.bk_forest(fp, group), radius)
    want = {(i, j) for i in range(len(fp)) for j in range(len(fp)) if i != j and (int(fp[i]) ^ int(fp[j])).bit_count() <= radius}
    assert set(zip(q.tolist(), n.tolist())) == want


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows_that_share_an_id_but_not_a_text_lose_no_document(spark):
    from edge import words

    a, b, c, d = (words(60, k) for k in (901, 902, 903, 904))
    data = [(3, a, "en", "s", 1), (7, a, "en", "s", 1), (7, b, "en", "s", 1), (9, c, "en", "s", 1), (9, d, "en", "s", 1), (9, d, "en", "s", 1), (None, a, None, None, None)]
    kept = sorted(((r.doc_id, r.text) for r in simhash.representatives(frame(spark, data)).collect()), key=str)
    assert kept == sorted([(3, a), (7, b), (9, c), (9, d), (None, a)], key=str)
