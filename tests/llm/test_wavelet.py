import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from edge import frame, repeated
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dimforge.llm import wavelet

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000)), max_size=1500))
def test_access_rank_select_and_round_trip(ids):
    seq = np.array(ids, np.uint16)
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(seq).to_bytes())
    assert m.decode().tolist() == ids
    for i in range(0, len(ids), 97):
        s = ids[i]
        at = [k for k, x in enumerate(ids) if x == s]
        assert m.access(i) == s and m.count(s) == len(at) and m.rank(s, i) == sum(k < i for k in at)
        assert m.occurrences(s)[:5] == at[:5] and m.select(s, len(at) - 1) == at[-1] and m.count(s, i, i + 50) == sum(i <= k < i + 50 for k in at)
    assert m.count(65000) == 0 and m.occurrences(65000) == []
    with pytest.raises(IndexError):
        m.access(len(ids))
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix.from_bytes(b"nope" + bytes(40))


def test_encoding_equals_the_library():
    with open(PATH, encoding="utf-8") as f:
        encoder = wavelet.Encoder(f.read())
    library, r = Tokenizer.from_file(PATH), random.Random(4)
    parts = ["the", " ", "\n", "  ", "\t", "'s", "a", "É", "12", ".", "!!", "<|endoftext|>", " x", "\x00", " ", "日本", "😀", "wörd,", "ª", "\u180e", "(b)"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_shards_hold_all_ids_in_document_order(spark):
    data = repeated()
    docs = frame(spark, data)
    shards = wavelet.write_shards(docs, PATH, shard_ids=500)
    got = wavelet.read_shards(shards).collect()
    assert len(got) == len(data) and shards.count() > 10
    library = Tokenizer.from_file(PATH)
    ids = {k: [library.encode(d[1] or "", add_special_tokens=False).ids + [0] for d in data if d[0] == k] for k in {d[0] for d in data}}
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (r.n_tokens, r.ids_crc32) in [(len(x), crc(x)) for x in ids[r.doc_id]]
        at += r.n_tokens
    assert at == sum(len(x) for v in ids.values() for x in v)
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    empty = wavelet.write_shards(frame(spark, []), PATH)
    assert wavelet.read_shards(empty).count() == 0
