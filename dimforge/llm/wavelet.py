"""Token ids in wavelet matrix shards.

A shard holds the ids of a run of documents, in ascending order of document id, as a wavelet
matrix: one bit-plane per bit of the id's code, each plane in the order that the planes above
have sorted the shard into, with running counts for rank. Codes number the shard's distinct ids
by falling frequency, so the upper planes are nearly empty and compress well. From a shard alone
any id can be read, counted, or found again.

The file of a shard (one value of the Parquet column ``shard_file``): the magic ``WMX1``, then the
lengths of alphabet, planes and sequence and the size of the compressed body (four unsigned
64-bit little-endian numbers), then the zstd-compressed body: alphabet (uint32 each, by code),
zeros of every plane (uint64), planes (bits, lowest first in a byte).
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dimforge.llm.tables import materialized

END = 0
SHARD_IDS = 1 << 21  # ids after which a shard is closed; a document is never split
_MAGIC, _HEAD = b"WMX1", struct.Struct("<4Q")
_RANK_BITS = 512
_CACHED = 2_000_000  # words that a worker remembers


class WaveletMatrix:
    """Succinct sequence of unsigned ids with access, rank, select, count and occurrences."""

    def __init__(self, alphabet: np.ndarray, zeros: np.ndarray, planes: list[np.ndarray], size: int):
        self.alphabet, self.zeros, self.planes, self.size = alphabet, zeros, planes, size
        self._code = None
        self._counts: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        many = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
        symbols = np.argsort(-many, kind="stable")[:np.count_nonzero(many)]
        code = np.zeros(len(many), np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
        code[symbols] = np.arange(len(symbols))
        seq, planes, zeros = code[ids], [], []
        for shift in reversed(range(max(len(symbols) - 1, 0).bit_length())):
            bit = (seq & seq.dtype.type(1 << shift)) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            off = np.compress(~bit, seq)
            zeros.append(len(off))
            seq = np.concatenate([off, np.compress(bit, seq)])
        return cls(symbols.astype(np.uint32), np.array(zeros, np.uint64), planes, len(ids))

    def to_bytes(self) -> bytes:
        body = zstandard.ZstdCompressor(level=1).compress(b"".join([self.alphabet.astype("<u4").tobytes(), self.zeros.astype("<u8").tobytes(), *[p.tobytes() for p in self.planes]]))
        return _MAGIC + _HEAD.pack(len(self.alphabet), len(self.planes), self.size, len(body)) + body

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != _MAGIC:
            raise ValueError("not a wavelet matrix shard")
        symbols, levels, size, packed = _HEAD.unpack_from(data, 4)
        body = zstandard.ZstdDecompressor().decompress(data[4 + _HEAD.size:4 + _HEAD.size + packed], max_output_size=symbols * 4 + levels * (8 + (size + 7) // 8))
        zeros_at, planes_at, width = symbols * 4, symbols * 4 + levels * 8, (size + 7) // 8
        return cls(np.frombuffer(body, "<u4", symbols), np.frombuffer(body, "<u8", levels, zeros_at),
                   [np.frombuffer(body, np.uint8, width, planes_at + k * width) for k in range(levels)], size)

    def decode(self) -> np.ndarray:
        """All ids: the planes are merged back from the last to the first."""
        seq = np.zeros(self.size, np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        for level in reversed(range(len(self.planes))):
            bit = np.unpackbits(self.planes[level], count=self.size, bitorder="little").view(bool)
            zeros, out = int(self.zeros[level]), np.empty_like(seq)
            out[np.flatnonzero(~bit)] = seq[:zeros]
            out[np.flatnonzero(bit)] = seq[zeros:] | seq.dtype.type(1 << (len(self.planes) - 1 - level))
            seq = out
        return self.alphabet[seq] if self.size else np.zeros(0, np.uint32)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane, by running counts."""
        if self._counts is None:
            self._counts = []
            for p in self.planes:
                bits = np.bitwise_count(np.pad(p, (0, -len(p) % (_RANK_BITS // 8)))).reshape(-1, _RANK_BITS // 8).sum(axis=1, dtype=np.int64)
                self._counts.append(np.r_[0, np.cumsum(bits)])
        block, plane = i // _RANK_BITS, self.planes[level]
        lo = block * _RANK_BITS // 8
        n = int(self._counts[level][block]) + int(np.bitwise_count(plane[lo:i // 8]).sum())
        return n + (int(plane[i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else n

    def access(self, i: int) -> int:
        if not 0 <= i < self.size:
            raise IndexError(i)
        code = 0
        for level, plane in enumerate(self.planes):
            bit, ones = plane[i // 8] >> (i % 8) & 1, self._ones(level, i)
            code = code * 2 + int(bit)
            i = int(self.zeros[level]) + ones if bit else i - ones
        return int(self.alphabet[code])

    def _code_of(self, symbol: int) -> int | None:
        if self._code is None:
            self._code = {int(s): k for k, s in enumerate(self.alphabet)}
        return self._code.get(symbol)

    def _narrow(self, code: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the id's occurrences in [lo, hi) lie below the last plane."""
        for level in range(len(self.planes)):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if code >> (len(self.planes) - 1 - level) & 1:
                lo, hi = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of the id in [lo, hi)."""
        code = self._code_of(symbol)
        if code is None:
            return 0
        hi = self.size if hi is None else min(hi, self.size)
        a, b = self._narrow(code, min(max(lo, 0), max(hi, 0)), max(hi, 0))
        return b - a

    def rank(self, symbol: int, i: int) -> int:
        return self.count(symbol, 0, i)

    def select(self, symbol: int, k: int) -> int:
        """Position of the k-th occurrence (from 0)."""
        code = self._code_of(symbol)
        if code is None or not 0 <= k < self.count(symbol):
            raise IndexError(k)
        i = self._narrow(code, 0, self.size)[0] + k
        for level in reversed(range(len(self.planes))):
            one = code >> (len(self.planes) - 1 - level) & 1
            i = self._nth(level, i - int(self.zeros[level]) if one else i, one)
        return i

    def _nth(self, level: int, k: int, one: int) -> int:
        """Position in a plane of its k-th one or zero, by bisection on the running counts."""
        lo, hi = 0, self.size
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._ones(level, mid + 1)
            if (ones if one else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]


_PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@]*)")  # letters, then ASCII signs other than the apostrophe
_UNSPACED = ["  ", "\n\n", " \n", "\n ", "\x00", "\u180e", *(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n")]
_loaded: dict[int, Encoder] = {}


def _byte_letters() -> dict[int, int]:
    """The printable letter that a byte-level vocabulary writes for each byte: itself if printable, else the next from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


class Encoder:
    """Whole texts to ids with the tokenizers library.

    A byte-level tokenizer without normalizer never merges across white space, so a text whose white space is
    single spaces and line ends is encoded word by word (a word with the space before it), and a word's ids are
    remembered. Words of Latin letters and signs go to the library's model directly, as the pieces that its own
    splitting gives. All other words and texts are given to the library whole.
    """

    _letters = _byte_letters()

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, spec = Tokenizer.from_str(tokenizer_json), json.loads(tokenizer_json)
        pre = spec.get("pre_tokenizer") or {}
        self.dtype = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.by_word = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not (spec.get("truncation") or spec.get("padding"))
        self.char = self.dtype.char
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return array(self.char, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """A run of Latin letters (with the space before it) or of signs, as one piece of the library's model."""
        if (ids := self.known.get(piece)) is None:
            ids = self.known[piece] = array(self.char, [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self._letters))]).tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._library(word)
        letters, signs = plain.groups()
        return self._piece(letters) + self._piece(signs) if signs else self._piece(letters)

    def _spaced(self, text: str) -> bool:
        """White space is single spaces and line ends between words, and no special token occurs."""
        return not (text[:1].isspace() or text[-1:].isspace() or any(x in text for x in _UNSPACED) or any(x in text for x in self.special))

    def encode(self, text: str) -> np.ndarray:
        if not self.by_word or not self._spaced(text):
            return np.frombuffer(self._library(text), self.dtype)
        words = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
        ids, known = [*map(self.known.get, words)], self.known
        if None in ids:
            if len(known) > _CACHED:
                known.clear()
            k = -1
            for _ in range(ids.count(None)):
                k = ids.index(None, k + 1)
                if (x := known.get(words[k])) is None:
                    x = known[words[k]] = self._word(words[k])
                ids[k] = x
        return np.frombuffer(b"".join(ids), self.dtype)

    @staticmethod
    def of(tokenizer_json: str) -> Encoder:
        """One per Python worker."""
        key = zlib.crc32(tokenizer_json.encode())
        if key not in _loaded:
            _loaded[key] = Encoder(tokenizer_json)
        return _loaded[key]


def write_shards(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes every whole text, ends each document with id 0 and writes wavelet matrix shards.

    Returns the written table: part, shard, n_ids, doc_ids, lengths (ids of each document, end included), shard_file.
    (part, shard) ascend with the document id, NULL ids first; equal ids are ordered by their text's checksum. A NULL or
    empty text is the end id alone. A shard is closed at ``shard_ids`` ids, so a task holds one shard and one document.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(docs.schema[id_col].dataType)), T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("shard_file", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        encoder, part, shard = Encoder.of(shared.value), TaskContext.get().partitionId(), 0
        keys, lengths, held, size = [], [], [], 0

        def closed():
            ids = np.concatenate(held)
            row = {"part": part, "shard": shard, "n_ids": len(ids), "doc_ids": keys, "lengths": lengths, "shard_file": WaveletMatrix.build(ids).to_bytes()}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        end = np.array([END], encoder.dtype)
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encoder.encode(text.as_py() or "")
                held += [ids, end]
                keys.append(key)
                lengths.append(len(ids) + 1)
                size += len(ids) + 1
                if size >= shard_ids:
                    yield closed()
                    keys, lengths, held, size, shard = [], [], [], 0, shard + 1
        if keys:
            yield closed()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ordered = rows.repartitionByRange(F.col("id")).sortWithinPartitions("id", F.crc32(F.col("text").cast("binary")))
    return materialized(ordered.mapInArrow(run, schema), "wavelet")


def read_shards(shards: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document, decoded from the shard files.

    ``start`` counts the ids of all documents before: sums per part, then per shard, give the offsets, so no task
    sees more than the parts or one part's shards.
    """
    schema = T.StructType([
        T.StructField("id", shards.schema["doc_ids"].dataType.elementType), T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
        T.StructField("at", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            for part, shard, keys, lengths, data in zip(*b.columns):
                ids = WaveletMatrix.from_bytes(data.as_py()).decode().astype("<u4")
                n = np.array(lengths.as_py(), np.int64)
                at, view = np.cumsum(n) - n, memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a:4 * (a + k)]) for a, k in zip(at.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays([keys.values, pa.array([part.as_py()] * len(n), pa.int32()), pa.array([shard.as_py()] * len(n), pa.int32()),
                                                  pa.array(at), pa.array(n), pa.array(crc, pa.int64())], schema=arrow)

    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before().orderBy("part")), F.lit(0)).alias("parts_before"))
    offsets = sizes.select("part", "shard", F.coalesce(F.sum("n_ids").over(before("part").orderBy("shard")), F.lit(0)).alias("shards_before")).join(parts, "part")
    return shards.select("part", "shard", "doc_ids", "lengths", "shard_file").mapInArrow(run, schema).join(offsets, ["part", "shard"]).select(
        F.col("id").alias(id_col), (F.col("parts_before") + F.col("shards_before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
