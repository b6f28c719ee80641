from edge import frame, repeated, words
from hypothesis import given, settings
from hypothesis import strategies as st

from dimforge.llm import decontam


def brute_tiles(a, b, least):
    """Greedy string tiling by definition: the longest common run of unmarked words, again and again."""
    used_a, used_b, tiles = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and i + k not in used_a and j + k not in used_b:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return len(used_b), tiles
        n, i, j = best
        used_a.update(range(i, i + n))
        used_b.update(range(j, j + n))
        tiles += 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.sampled_from("abc"), min_size=1, max_size=16), st.integers(1, 4))
def test_tiles_match_the_definition(text, item, least):
    least = min(least, len(item))
    found = list(decontam.Items([(1, item)], least).tilings(text))
    want = brute_tiles(text, item, least)
    assert (found[0][1:] if found else (0, 0)) == want


def test_whole_reordered_and_partial_passages(spark):
    item = words(40, 77, 10 ** 6).split()
    text = words(200, 5)
    data = [(1, f"{text} {' '.join(item)} {text}", "en", "s", 1), (2, f"{' '.join(item[20:])}, {text}; {' '.join(item[:20]).upper()}!", "en", "s", 1),
            (3, f"{text} {' '.join(item[:20])}", "en", "s", 1), (4, text, "en", "s", 1), (5, "Yes, short one", "en", "s", 1)] + [(9, None, None, None, None)]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "short one"), (9, None), (10, "?!"), (11, "not there at all")], "item_id long, text string")
    docs = frame(spark, data)
    for block in (5_000_000, 10):  # one pass, several passes
        got = {(r.doc_id, r.item_id): r for r in decontam.contaminations(docs, bench, block_words=block).collect()}
        assert set(got) == {(1, 7), (2, 7), (5, 8)}
        assert got[1, 7].coverage == 1 and got[1, 7].tiles == 1 and got[2, 7].covered == 40 and got[2, 7].tiles == 2
        kept = decontam.decontaminated(docs, bench, block_words=block)
        assert {r.doc_id for r in kept.collect()} == {3, 4, 9} and kept.columns == docs.columns


def test_edge_rows_and_empty_tables(spark):
    docs = frame(spark, repeated())
    bench = spark.createDataFrame([(1, words(70, 11), "clash")], "item_id long, text string, doc_id string")
    got = [r.doc_id for r in decontam.contaminations(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([11, None, None], key=str)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminations(docs, none).count() == 0 and decontam.decontaminated(docs, none).count() == len(repeated())
    assert decontam.contaminations(frame(spark, []), bench).count() == 0


def test_repeated_words_need_no_list_of_pairs(monkeypatch):
    import random
    import tracemalloc

    r = random.Random(4)
    items = [(k, [r.choice("ab") for _ in range(r.randint(5, 30))]) for k in range(12)]
    table = decontam.Items(items, 5)
    texts = [[r.choice("abc" if k % 2 else "ab") for _ in range(120)] for k in range(30)]
    listed = [sorted(table.tilings(t)) for t in texts]
    monkeypatch.setattr(decontam, "_PAIRS", 0)
    assert [sorted(table.tilings(t)) for t in texts] == listed and any(listed)
    monkeypatch.undo()
    same = decontam.Items([("x", ["one"] * 200)], 5)
    tracemalloc.start()
    assert [(k, c) for k, c, _ in same.tilings(["one"] * 20_000)] == [(0, 200)]
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()
