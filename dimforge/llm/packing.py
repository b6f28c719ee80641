"""Packing token sequences by minimum bin slack.

Texts become token ids with an end id; documents above the capacity are cut into pieces of it. The bins
are filled one after another: the longest piece left is taken, and a subset-sum dynamic program over the
lengths that are still available, a bit per fill, finds the fullest combination with it, which is removed.
Pieces of one length are alike, so the program sees no more than a count per length, and a combination is
taken at once as often as the counts allow: until then it stays a fullest one. Its work depends on the
capacity, not on the number of documents. Which piece takes which place is a rank among the pieces
of its length, and two lookups.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dimforge.llm.tables import bucketed, materialized

CAPACITY = 4096
END = 1
_CACHED = 600_000  # words, and pieces of words, after which a worker starts a new memory and keeps the last beside it
_BATCH_IDS = 1 << 21
_SIGNS = "!-&(-/:-@[-`{-~"  # ASCII signs but the apostrophe
_PLAIN = re.compile(f"([{_SIGNS}]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([{_SIGNS}]*)")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # the pattern of the tokenizers that may be encoded word by word
_loaded: dict[int, WordEncoder] = {}


class WordEncoder:
    """Whole texts to ids with the tokenizers library, as bytes of ``dtype``.

    A tokenizer that drops white space and splits there, with a normalizer that knows no context, gives a text the ids
    of its words one after another, and a word's ids are remembered. Words of Latin letters between signs go to the
    library's model directly, as the pieces that its own splitting gives, in lower case and in the letters that
    a byte-level vocabulary writes for bytes. Other words, and texts of other tokenizers, are given to the library whole.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, spec = Tokenizer.from_str(tokenizer_json), json.loads(tokenizer_json)
        steps = [(n.get("type"), n.get("pattern"), n.get("content")) for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = (
            steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)] and len(cuts) == 2
            and cuts[0] == {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
            and cuts[1].get("type") == "ByteLevel" and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex", True)
            and not any(t.get("normalized") or any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
            and not (spec.get("truncation") or spec.get("padding")))
        top = max([self.tokenizer.get_vocab_size(), *(t["id"] + 1 for t in spec.get("added_tokens", []))])
        self.dtype = np.dtype("<u2" if top <= 1 << 16 else "<u4")
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.model = self.tokenizer.model
        self.known, self.known_before, self.pieces, self.pieces_before = {}, {}, {}, {}
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: 256 + k for k, b in enumerate(hidden)}

    def _bytes(self, ids: list[int]) -> bytes:
        return array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes()

    def _library(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        if (ids := self.pieces.get(piece)) is None:
            if len(self.pieces) >= _CACHED:
                self.pieces, self.pieces_before = {}, self.pieces
            if (ids := self.pieces_before.get(piece)) is None:
                ids = self._bytes([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))])
            self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if not plain or any(x in word for x in self.special):
            return self._library(word)
        before, letters, after = plain.groups()
        return (self._piece(before) if before else b"") + self._piece(letters.lower()) + (self._piece(after) if after else b"")

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self._library(text)
        words, known = text.replace("\n", " ").split(" "), self.known
        ids = [*map(known.get, words)]
        if None in ids:
            if len(known) >= _CACHED:
                self.known, self.known_before = known, _ = {}, known
            before, k = self.known_before, -1
            for _ in range(ids.count(None)):
                k = ids.index(None, k + 1)
                if (x := known.get(words[k])) is None:
                    if (x := before.get(words[k])) is None:
                        x = self._word(words[k])
                    known[words[k]] = x
                ids[k] = x
        return b"".join(ids)

    @staticmethod
    def of(tokenizer_json: str) -> WordEncoder:
        """One per Python worker."""
        key = zlib.crc32(tokenizer_json.encode())
        if key not in _loaded:
            _loaded[key] = WordEncoder(tokenizer_json)
        return _loaded[key]


def minimum_slack(many: dict[int, int], capacity: int) -> Iterator[tuple[int, dict[int, int]]]:
    """(bins, {length: pieces of it in each of them}) that use up ``many[length]`` pieces, every bin as full as it can be at its turn.

    The longest length left is in the bin; of the fullest combinations the one of the longest other lengths is taken.
    """
    left = {n: c for n, c in sorted(many.items(), reverse=True) if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must be positive and within the capacity")
    while left:
        first = next(iter(left))
        left[first] -= 1
        room = capacity - first
        reach, steps = 1, []  # bit f: the fill f can be reached; what it was before each length
        for n, c in left.items():
            if reach >> room & 1:
                break
            if n > room or not c:
                continue
            steps.append((n, reach))
            fits, mask, step = min(c, room // n), (1 << room + 1) - 1, 1
            while fits:  # runs of 1, 2, 4, ... pieces of the length
                step = min(step, fits)
                reach |= reach << n * step & mask
                fits -= step
                step *= 2
        fill, used = reach.bit_length() - 1, {first: 1}
        for n, before in reversed(steps):
            while not before >> fill & 1:
                fill -= n
                used[n] = used.get(n, 0) + 1
        left[first] += 1
        bins = min(left[n] // c for n, c in used.items())
        yield bins, used
        for n, c in used.items():
            left[n] -= bins * c
            if not left[n]:
                del left[n]


def _places(patterns: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """The combinations as ranges of ranks by length: key = length << 48 | first rank, with bin, pieces a bin and offset."""
    out, seen, sequence = [], {}, 0
    for bins, used in patterns:
        offset = 0
        for n, c in used.items():
            out.append((n << 48 | seen.get(n, 0), sequence, c, offset))
            seen[n] = seen.get(n, 0) + bins * c
            offset += n * c
        sequence += bins
    cols = np.array(sorted(out), np.int64).reshape(-1, 4).T
    return dict(zip(("key", "sequence", "each", "offset"), cols))


def tokenized(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents: id, piece, start, length, ids (binary, little-endian), and part and nth, the piece's
    number among those of its length in the part. Written in buckets of ``part``, where each task already holds its own."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()), T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        encoder, part, seen = WordEncoder.of(shared.value), TaskContext.get().partitionId(), [0] * (capacity + 1)
        one, end = encoder.dtype.itemsize, encoder._bytes([end_id])
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([[part] * len(rows), *zip(*rows)], arrow)], schema=arrow)

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                for lo in range(0, len(ids), capacity * one):
                    cut = ids[lo:lo + capacity * one]
                    n = len(cut) // one
                    rows.append((seen[n], key, lo // (capacity * one), lo // one, n, cut))
                    seen[n] += 1
                    size += n
                    if size >= _BATCH_IDS:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    buckets = min(max(rows.rdd.getNumPartitions(), 1), 100_000)
    return bucketed(rows.mapInArrow(run, schema), "pieces", "part", buckets)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs all documents: sequence_id, ids (binary, little-endian unsigned 32-bit integers), pieces.

    ``pieces`` are structs in order of their offset: doc_id, piece (from 0), start (the document's ids before it), length, offset.
    Every document is its whole text's ids and ``end_id``; a NULL or empty text is the end id alone. Only documents
    above the capacity are cut. Repeated rows and NULL ids are documents of their own. An empty table gives no sequence.

    A count per length (at most ``capacity`` numbers) reaches the driver, and the ranges of places that it sends out have a
    bound by the capacity alone. Ids are written once and shuffled once, to their sequences.
    """
    made = tokenized(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    spark = docs.sparkSession
    many = materialized(made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-lengths")
    total = {r.length: r.n for r in many.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places([*minimum_slack(total, capacity)]))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def by_length(batches):  # the ranks that a part starts with, one row a part
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            for part, n, first in zip(*(c.to_pylist() for c in b.columns)):
                parts.setdefault(part, np.zeros(capacity + 1, np.int64))[n] = first
        for part, first in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first.tolist()], pa.list_(pa.int64()))], names=["part", "first"])

    firsts = many.select("part", "length", before.alias("first")).repartition("part").mapInArrow(by_length, "part int, first array<long>")
    ranked = made.join(firsts.hint("shuffle_hash"), "part").select("id", "piece", "start", "length", "ids", (F.expr("first[int(length)]") + F.col("nth")).alias("rank"))
    id_type = docs.schema[id_col].dataType
    placed_schema = T.StructType([T.StructField("id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                                  T.StructField("ids", T.BinaryType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    placed_arrow = to_arrow_schema(placed_schema)

    def place(batches):
        p = places.value
        for b in batches:
            n, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(p["key"], n << 48 | rank, side="right") - 1
            rank = rank - (p["key"][at] & (1 << 48) - 1)
            sequence, offset = p["sequence"][at] + rank // p["each"][at], p["offset"][at] + rank % p["each"][at] * n
            yield pa.RecordBatch.from_arrays([*b.columns[:4], b.column(4).cast(placed_arrow.field(4).type), pa.array(sequence), pa.array(offset)], schema=placed_arrow)

    piece = T.StructType([T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "offset"))])
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("pieces", T.ArrayType(piece))])
    arrow = to_arrow_schema(schema)

    def joined(batches):  # rows come by sequence and offset; the last sequence of a batch may go on in the next
        held = []
        for b in batches:
            held.append(b)
            table = pa.Table.from_batches(held).combine_chunks()
            sequence = table["sequence_id"].to_numpy()
            cut = int(np.searchsorted(sequence, sequence[-1])) if len(sequence) else 0
            if cut:
                yield from sequences(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield from sequences(pa.Table.from_batches(held).combine_chunks())

    def sequences(table):
        b = table.to_batches()[0]
        sequence = b.column(5).to_numpy()
        starts = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1], True]).astype(np.int32)
        ids, ends = b.column(4), starts
        narrow = f"<u{len(ids[0].as_buffer()) // b.column(3)[0].as_py()}"
        raw = [memoryview(x.as_buffer()) for x in ids]
        whole = pa.array([np.frombuffer(b"".join(raw[lo:hi]), narrow).astype("<u4").tobytes() for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())
        structs = pa.StructArray.from_arrays([b.column(k) for k in (0, 1, 2, 3, 6)], fields=list(arrow.field(2).type.value_type))
        yield pa.RecordBatch.from_arrays([pa.array(sequence[starts[:-1]]), whole, pa.ListArray.from_arrays(pa.array(starts), structs).cast(arrow.field(2).type)], schema=arrow)

    dealt = ranked.mapInArrow(place, placed_schema).repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return dealt.mapInArrow(joined, schema)


def piece_digests(packed: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (of its ids as little-endian unsigned 32-bit integers), sequence_id and offset of every packed piece."""
    each = packed.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    own = F.substring("ids", F.col("p.offset").cast("int") * 4 + 1, F.col("p.length").cast("int") * 4)
    return each.select("p.doc_id", "p.piece", "p.start", "p.length", F.crc32(own).alias("ids_crc32"), "sequence_id", "p.offset")
