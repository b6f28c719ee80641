"""Packing by minimum bin slack: whole documents, legal sequences, few of them."""

from __future__ import annotations

import itertools
import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from edge import DOCS, frame, repeated, words
from tokenizers import Tokenizer

from dimforge.llm import packing, queries

SF0001 = "/root/testdata/sf0.001"

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(text) -> list[int]:
    global _TOKENIZER
    if "_TOKENIZER" not in globals():
        _TOKENIZER = Tokenizer.from_file(PATH)
    return [*_TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def brute_pieces(docs, capacity) -> Counter:
    """(doc_id, piece, start, length, crc) of every piece of the library's own ids."""
    out: Counter = Counter()
    for key, text in docs:
        ids = library_ids(text)
        for k, lo in enumerate(range(0, len(ids), capacity)):
            cut = ids[lo:lo + capacity]
            out[key, k, lo, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))] += 1
    return out


def check(rows, docs, capacity) -> int:
    """The rows hold all pieces once, sequences without gaps or overflow; returns how many sequences."""
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == brute_pieces(docs, capacity)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    return len(held)


def test_edge_documents(spark):
    data = repeated() + [(200 + i, words(150 + i * 7 % 400, i), "en", "s", 1) for i in range(60)]
    data += [(90, "It's  they'll O'Neil\t<|endoftext|> a<|startoftext|>b éé İstanbul ﬁn ⅷ ½ x\x1cy", None, None, 1), (91, " 　 ", None, None, 1), (92, "--(Ab).;C'est 3.14 [x]_y^ ~É!", "fr", None, 1)]
    capacity = 256
    packed = packing.pack(frame(spark, data).repartition(6), PATH, capacity)
    n = check(packing.piece_digests(packed).collect(), [r[:2] for r in data], capacity)
    total = sum(len(library_ids(r[1])) for r in data)
    assert n <= 1.02 * -(-total // capacity) + 1
    for r in packed.collect():  # the sequences hold the ids themselves
        assert len(r.ids) == 4 * sum(p.length for p in r.pieces)
        assert [p.offset for p in r.pieces] == [0, *itertools.accumulate(p.length for p in r.pieces)][:-1]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "", "en", "s", 0)] * 3])
def test_small_tables(spark, rows):
    got = packing.piece_digests(packing.pack(spark.createDataFrame(rows, DOCS), PATH)).collect()
    assert check(got, [r[:2] for r in rows], packing.CAPACITY) == (1 if rows else 0)


def test_other_tokenizers_are_given_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    rows = packing.pack(spark.createDataFrame([(1, "Two  words,\nnaïve", "en", "s", 1)], DOCS), path, end_id=0).collect()
    assert struct.unpack(f"<{len(rows[0].ids) // 4}I", rows[0].ids) == (*own.encode("Two  words,\nnaïve", add_special_tokens=False).ids, 0)


def test_bins_are_as_full_as_they_can_be():
    r = random.Random(6)
    for _ in range(60):
        many = {n: r.randint(1, 4) for n in r.sample(range(1, 30), r.randint(1, 6))}
        left = Counter(many)
        for bins, used in packing.minimum_slack(many, 30):
            for _ in range(bins):
                first, items = max(left), list(left.elements())
                items.remove(first)
                fills = {first}
                for n in items:
                    fills |= {f + n for f in fills if f + n <= 30}
                assert used[first] and sum(n * c for n, c in used.items()) == max(fills)
                left -= Counter(used)
        assert not left


@pytest.mark.parametrize("lengths", [[4096] * 50, [1] * 9000, [2048] * 31 + [2049] * 10 + [2047] * 10, random.Random(7).choices(range(1, 1200), k=20_000), random.Random(8).choices(range(1, 4097), k=20_000)])
def test_few_sequences(lengths):
    many = Counter(lengths)
    used: Counter = Counter()
    bins = 0
    for b, items in packing.minimum_slack(many, 4096):
        assert sum(n * c for n, c in items.items()) <= 4096
        used.update({n: b * c for n, c in items.items()})
        bins += b
    assert used == many
    halves = sum(n > 2048 for n in lengths)
    assert bins <= 1.01 * max(-(-sum(lengths) // 4096), halves) + 1


def test_lengths_outside_the_capacity():
    for bad in ({0: 1}, {11: 2}):
        with pytest.raises(ValueError, match="capacity"):
            [*packing.minimum_slack(bad, 10)]


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    n = check(queries.op13_minimum_bin_slack(spark, SF0001).collect(), docs, 4096)
    assert n <= -(-sum(len(library_ids(t)) for _, t in docs) // 4096) + 1
