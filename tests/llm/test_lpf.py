import hashlib

import numpy as np
import pytest
from edge import frame, repeated, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimforge.llm import lpf


def brute(documents, length):
    """Removed runs of documents in order, by a set of all earlier windows."""
    seen, out = set(), []
    for b in documents:
        gone = np.zeros(len(b) + 2, np.int64)
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                gone[p + 1:p + 1 + length] = 1
            seen.add(b[p:p + length])
        edge = np.diff(gone)
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())))
    return out


def check(spark, data, length=100, gram=32, hot=lpf.HOT, parts=None):
    docs = frame(spark, data)
    got = {r.doc_id: r for r in lpf.dedup(docs.repartition(parts) if parts else docs, length=length, gram=gram, hot=hot).collect()}
    texts = [(d[1] or "").encode() for d in sorted(data)]
    for d, text, runs in zip(sorted(data), texts, brute(texts, length)):
        r = got[d[0]]
        assert r.n_bytes == len(text) and [tuple(s) for s in r.spans] == runs, d[0]
        assert bytes(r.kept) == b"".join(text[a:b] for a, b in zip([0, *[x[1] for x in runs]], [*[x[0] for x in runs], len(text)]))


def test_edge_rows(spark):
    check(spark, rows())


def passages(seed):
    r = np.random.default_rng(seed)
    parts = ["".join(r.choice(list("abc"), int(r.integers(90, 260)))) for _ in range(8)]
    return [(i, "".join(parts[int(k)] + "xyz"[i % 3] * int(r.integers(0, 3)) for k in r.integers(0, 8, int(r.integers(1, 6)))), None, None, None) for i in range(60)]


@pytest.mark.parametrize("hot", [3, 4096])
def test_shared_passages_on_the_sorted_and_the_joined_path(spark, hot):
    check(spark, passages(3), hot=hot)


def test_a_gram_common_overall_but_rare_in_each_batch_is_not_sorted_in_one_task(spark, monkeypatch):
    r = np.random.default_rng(8)
    line = "".join(r.choice(list("defg"), 70))
    data = [(i, "".join(r.choice(list("abc"), 60)) + line + "".join(r.choice(list("abc"), 40)) + line * (i % 4), None, None, None) for i in range(48)]
    seen = []
    kept = lpf.materialized

    def watched(df, name):
        out = kept(df, name)
        if name == "lpf-marked":
            seen.append(out.groupBy("gram").count().agg(F.max("count")).first()[0] or 0)
        return out

    monkeypatch.setattr(lpf, "materialized", watched)
    check(spark, data, hot=1_000_000, parts=24)  # all sorted
    check(spark, data, hot=12, parts=24)  # halves, and the windows of common halves
    assert seen[0] >= 12 > seen[1]


def test_halves_hold_each_window_once():
    text = bytes(range(256))
    for at, first, last in ((100, 40, 100), (100, 32, 60), (100, 90, 100), (80, 12, 80)):
        got = lpf.halves(text, at, first, last, 100, 32)
        assert sorted(s for _, lo, hi in got for s in range(lo, hi + 1)) == list(range(first, last + 1))


def test_repeated_rows_null_ids_and_nothing(spark):
    data = repeated()
    got = lpf.dedup(frame(spark, data)).collect()
    assert len(got) == len(data)
    twice = [r for r in got if r.doc_id == 10]
    assert len(twice) == 3 and all(r.spans == [] for r in twice)  # repeats of one row are no copies of each other
    assert [r for r in got if r.doc_id == 100][0].spans  # a later document is
    assert lpf.dedup(frame(spark, [])).count() == 0


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(lpf, "_BYTES_AT_ONCE", 700)
    r = np.random.default_rng(5)
    text = bytes(r.integers(97, 100, 5000, dtype=np.uint8))
    got = {(a.item(), f.item(), x.item()) for p in lpf.anchors([text, text[37:]]) for a, f, x, d in zip(p.at, p.first, p.last, p.doc) if d == 0}
    monkeypatch.setattr(lpf, "_BYTES_AT_ONCE", 1 << 20)
    whole = {(a.item(), f.item(), x.item()) for p in lpf.anchors([text]) for a, f, x in zip(p.at, p.first, p.last)}
    assert {a for a, _, _ in got} == {a for a, _, _ in whole}
    covered = sorted(s for _, f, x in got for s in range(f, x + 1))
    assert covered == list(range(len(text) - lpf.LENGTH + 1))  # each window has one anchor


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=60).map(lambda b: bytes(x % 3 for x in b)))
def test_longest_previous_factors(text):
    n = len(text)
    order = sorted(range(n), key=lambda i: text[i:])

    def shared(i, j):
        k = 0
        while max(i, j) + k < n and text[i + k] == text[j + k]:
            k += 1
        return k

    common = [0, *[shared(a, b) for a, b in zip(order, order[1:])], 0]
    got = dict(zip(order, lpf.previous_factors(order, common)))
    assert got == {i: max([shared(i, j) for j in range(i)], default=0) for i in range(n)}


def test_query_digests(spark, tmp_path):
    from dimforge.llm.queries import op4_lpf_dedup

    spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    texts = [(d[1] or "").encode() for d in sorted(rows())]
    got = {r.doc_id: r for r in op4_lpf_dedup(spark, str(tmp_path)).collect()}
    for d, text, runs in zip(sorted(rows()), texts, brute(texts, 100)):
        gone = sum(b - a for a, b in runs)
        kept = b"".join(text[a:b] for a, b in zip([0, *[x[1] for x in runs]], [*[x[0] for x in runs], len(text)]))
        assert tuple(got[d[0]]) == (d[0], len(text), gone, len(runs), hashlib.sha256(kept).hexdigest())
