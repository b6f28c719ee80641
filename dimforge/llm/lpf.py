"""Exact substring dedup by longest-previous-factor arrays.

Every byte that a string of ``length`` bytes covers goes if that string also starts earlier: in a
document of a smaller id, or earlier in the same document. Matches never cross documents.

No task can hold the suffixes of the whole corpus, so they are dealt by content. In each window of
``length`` bytes the least hash of a ``GRAM``-byte gram marks an anchor; two equal windows mark the
same anchor at the same place, so equal windows always meet in the group of an anchor.

1. Documents are scanned once for anchors: (hash of the gram, hash of all bytes a window through it can hold, place).
   Grams of very many contexts, counted over all anchors, are split by longer strings: the gram with bytes after it for the
   windows that start late, with bytes before it for the others. The windows of halves that are common still are joined
   by a hash of 128 bits.
2. All other anchors are dealt by gram hash. A gram that occurs once can be in no repeat. Where all the bytes around an
   anchor occurred earlier, everything around it is removed; one hash of 64 bits a gram and one of 64 a
   context stand for the bytes. Only the first of each context needs its bytes.
3. Those contexts, cut from the documents, are dealt by gram hash. Their suffixes are sorted; in suffix order,
   the previous and next smaller positions of a suffix give its longest previous factor, and windows whose
   factor reaches ``length`` are removed.
4. Removed runs are merged for each document and cut out of its text.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dimforge.llm.tables import materialized

LENGTH = 100
GRAM = 32
HOT = 1024  # contexts of a gram that no task sorts together: more common grams are split
HOT_BITS = 1 << 28  # bits of the filter that tells common grams; at most 64 MB whatever the corpus
_BYTES_AT_ONCE = 1 << 20
_ANCHORS_AT_ONCE = 1 << 19
_WINDOWS_AT_ONCE = 1 << 18
_HALVES_AT_ONCE = 1 << 16

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.cumprod(np.r_[_U(1), np.full(n - 1, x, _U)], dtype=_U) for x in (_U(_BASE), _U(pow(_BASE, -1, 1 << 64)))]
    return _powers


@dataclass
class Anchors:
    """Anchors of some documents: gram and context hash, document, place, first and last window start."""

    gram: np.ndarray
    context: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[Anchors]:
    """Anchors of whole texts, some _BYTES_AT_ONCE of text at a time; longer texts in overlapping pieces.

    A window's anchor is the least gram hash in it (the first, if several), so it depends on the window's bytes only.
    """
    batch: list[tuple[int, int, bytes]] = []  # (document, offset, bytes)
    size = 0
    for k, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - length + 1), _BYTES_AT_ONCE):
            batch.append((k, lo, t[lo:lo + _BYTES_AT_ONCE + length - 1]))
            size += len(batch[-1][2])
            if size >= _BYTES_AT_ONCE:
                yield _anchors(batch, length, gram)
                batch, size = [], 0
    if batch:
        yield _anchors(batch, length, gram)


def _anchors(batch: list[tuple[int, int, bytes]], length: int, gram: int) -> Anchors:
    sizes = np.array([len(x[2]) for x in batch], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(x[2] for x in batch), np.uint8)
    n, span = len(data), length - gram + 1
    windows = n - length + 1
    if windows <= 0 or not (sizes >= length).any():
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none, none, none)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_VALUES[data] * power[:n], out=sums[1:])
    grams = (sums[gram:] - sums[:-gram]) * inverse[:n - gram + 1]
    mixed = (grams ^ (grams >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    bits = _U(max(1, int(n).bit_length()))
    key = (mixed >> bits << bits) | np.arange(len(mixed), dtype=_U)  # ties: the first
    blocks = -(-len(key) // span)
    padded = np.full(blocks * span, np.iinfo(_U).max, _U)
    padded[:len(key)] = key
    padded = padded.reshape(blocks, span)  # least of any span: of the end of a block and the beginning of the next
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = (np.minimum(behind[:windows], ahead[span - 1:span - 1 + windows]) & ((_U(1) << bits) - _U(1))).astype(np.int64)
    piece = np.repeat(np.arange(len(batch)), sizes)[:windows]
    own = np.arange(windows) + length <= (starts + sizes)[piece]  # windows that lie in one document
    where = np.flatnonzero(own)
    chosen = least[where]
    cut = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (np.diff(where) > 1)]) if len(where) else where
    first, last, at = where[cut], where[np.r_[cut[1:], len(where)] - 1] if len(where) else where, chosen[cut]
    context = (sums[last + length] - sums[first]) * inverse[first]
    shape = ((at - first) << 8 | (last - at + length)).astype(_U)  # the place of the gram in its context counts, too
    context = (context ^ (context >> _U(31)) ^ shape * _U(_BASE)) * _U(0x94D049BB133111EB)
    p, shift = piece[first], np.array([x[1] for x in batch], np.int64)
    move = shift[p] - starts[p]
    return Anchors(mixed[at].view(np.int64), context.view(np.int64), np.array([x[0] for x in batch], np.int64)[p], at + move, first + move, last + move)


def previous_factors(position: list[int], common: list[int]) -> list[int]:
    """Longest previous factor of each suffix, listed in suffix order.

    ``position[k]`` is where the k-th suffix starts, ``common[k]`` the common prefix of the k-th and the one before.
    The previous and the next suffix of smaller position share the longest prefixes with any earlier suffix; each
    stacked suffix remembers the prefix that it shares with the one below.
    """
    n, out = len(position), [0] * len(position)
    for walk, step in ((range(n), 0), (range(n - 1, -1, -1), 1)):
        stack: list[tuple[int, int]] = []
        for k in walk:
            shared = common[k + step] if stack else 0
            while stack and stack[-1][0] > position[k]:
                shared = min(shared, stack.pop()[1])
            if stack and shared > out[k]:
                out[k] = shared
            stack.append((position[k], shared))
    return out


def repeated_windows(data: bytes | np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows at ``starts``, given from the first position to the last, have a previous factor of ``length``.

    Suffixes are sorted by their first ``length`` bytes; common prefixes are cut to 0 or ``length``, so suffixes that share
    less with both neighbours have no such factor and are left out of the array.
    """
    found = np.zeros(len(starts), bool)
    if not len(starts):
        return found
    flat = np.frombuffer(data, np.uint8)
    suffix = np.ndarray(len(flat) - length + 1, f"S{length}", flat, strides=(1,))[starts]
    order = np.argsort(suffix, kind="stable")
    suffix = suffix[order]
    equal = np.r_[False, suffix[1:] == suffix[:-1], False]
    near = np.flatnonzero(equal[1:] | equal[:-1])
    common = np.where(equal[near], length, 0).tolist()
    factor = previous_factors(order[near].tolist(), [*common, 0])
    found[order[near]] = np.array(factor, np.int64) >= length
    return found


def _merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Union of half-open spans, as maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(lo.tolist(), hi.tolist())):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _as_bytes(column: pa.Array) -> list[bytes]:
    return [x.as_py() or b"" for x in column]


def _local_firsts(batch: pa.RecordBatch, keys: list[str], length: int, gram: int) -> Iterator[tuple[Anchors, np.ndarray, np.ndarray]]:
    """(anchors, indexes of the first of each gram and context, indexes of the later ones) of a batch, about _ANCHORS_AT_ONCE at a time."""
    rank = np.empty(batch.num_rows, np.int64)
    rank[pc.sort_indices(pa.Table.from_batches([batch.select(keys)]), sort_keys=[(k, "ascending") for k in keys], null_placement="at_start").to_numpy()] = np.arange(batch.num_rows)

    def joined(parts: list[Anchors]):
        a = Anchors(*(np.concatenate([getattr(p, f) for p in parts]) for f in Anchors.__dataclass_fields__))
        order = np.lexsort((a.at, rank[a.doc], a.context, a.gram))
        later = np.r_[False, (np.diff(a.gram[order]) == 0) & (np.diff(a.context[order]) == 0)][:len(order)]
        return a, order[~later], order[later]

    parts, size = [], 0
    for part in anchors(_as_bytes(batch.column("text")), length, gram):
        parts.append(part)
        size += len(part.gram)
        if size >= _ANCHORS_AT_ONCE:
            yield joined(parts)
            parts, size = [], 0
    if size:
        yield joined(parts)


def _common_grams(anchors_: DataFrame, hot: int) -> tuple[np.ndarray, np.ndarray] | None:
    """A filter of HOT_BITS bits over the grams with at least ``hot`` rows: its words that are not zero, and where; None if there are none.

    It has at most HOT_BITS / 64 words for any corpus. A gram that it takes for a common one is treated as one, with the same result.
    """
    slot = F.col("gram").bitwiseAND(HOT_BITS - 1)
    common = anchors_.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= hot)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    words = common.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    if not words.num_rows:
        return None
    words = words.sort_by("word")
    return words.column("word").to_numpy(), words.column("bits").to_numpy().view(_U)


def _marked(marks: tuple[np.ndarray, np.ndarray], grams: np.ndarray) -> np.ndarray:
    where, bits = marks
    slot = grams & (HOT_BITS - 1)
    word = slot >> 6
    at = np.minimum(np.searchsorted(where, word), len(where) - 1)
    return (where[at] == word) & (bits[at] >> (slot & 63).view(_U) & _U(1)).astype(bool)


def _rare(anchors_: DataFrame, shared) -> DataFrame:
    """The anchors of the grams that a broadcast filter does not mark."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(~_marked(shared.value, b.column("gram").to_numpy())))

    return anchors_.mapInArrow(run, anchors_.schema)


def halves(text: bytes, at: int, first: int, last: int, length: int, gram: int) -> list[tuple[int, int, int]]:
    """(key, first start, last start) of the windows around the gram at ``at`` that start late and of those that start early.

    A late window holds the gram and about half of a window's other bytes after it, an early one as many before it. Equal
    windows have their gram at the same place, so they are of the same half and key.
    """
    middle = (length - gram) // 2
    late, early, out = max(first, at - middle), min(last, at - middle - 1), []
    if late <= last:
        out.append((xxhash.xxh3_64_intdigest(text[at:at + length - middle], seed=1), late, last))
    if first <= early:
        out.append((xxhash.xxh3_64_intdigest(text[at - middle - 1:at + gram], seed=2), first, early))
    return out


def removed_spans(docs: DataFrame, keys: list[str], length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(keys, spans: array of the covered runs' pieces lo and hi) of documents (keys, text as binary) with distinct keys.

    Documents are ordered by ``keys`` (NULL first). Documents without a covered byte are left out. ``docs`` is scanned
    several times and has to come in the same partitions and order each time, as a table does.
    """
    spark = docs.sparkSession
    docs = docs.select(*keys, "text")
    key_fields = [T.StructField(k, docs.schema[k].dataType) for k in keys]
    span = [T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]

    def table(*fields: T.StructField):
        schema = T.StructType([*fields])
        return schema, to_arrow_schema(schema)

    # anchors, the first of each gram and context in its batch (kind 1: gram, context, place with the bytes before and after
    # in one number); whatever the later ones cover is removed (kind 0: lo, hi)
    seen_schema, seen_arrow = table(T.StructField("kind", T.IntegerType()), *key_fields, *[T.StructField(c, T.LongType()) for c in ("a", "b", "c")])

    def survey(batches):
        for b in batches:
            def rows(kind: int, of: np.ndarray, *columns):
                own = pa.array(of)
                numbers = [pa.array(x, pa.int64()) for x in columns] + [pa.nulls(len(of), pa.int64())] * (3 - len(columns))
                return pa.RecordBatch.from_arrays([pa.array(np.full(len(of), kind, np.int32)), *[b.column(k).take(own) for k in keys], *numbers], schema=seen_arrow)

            for a, first, later in _local_firsts(b, keys, length, gram):
                place = a.at[first] << 32 | (a.at[first] - a.first[first]) << 16 | (a.last[first] + length - a.at[first])
                yield rows(1, a.doc[first], a.gram[first], a.context[first], place)
                order = later[np.lexsort((a.first[later], a.doc[later]))]
                own, lo, hi = [], [], []
                for part in np.split(order, np.flatnonzero(np.diff(a.doc[order])) + 1) if len(order) else []:
                    runs = _merged(a.first[part], a.last[part] + length)
                    own += [int(a.doc[part[0]])] * len(runs)
                    lo += [x[0] for x in runs]
                    hi += [x[1] for x in runs]
                yield rows(0, np.array(own, np.int64), lo, hi)

    seen = materialized(docs.mapInArrow(survey, seen_schema), "lpf-survey")
    found = seen.where("kind = 1")

    # grams of at least ``hot`` contexts, counted over all anchors, are split into halves; common halves into windows
    dealt = seen.where("kind = 1").select(F.col("a").alias("gram"), F.col("b").alias("context"), *keys, F.col("c").alias("place"))
    marks = _common_grams(dealt, hot)
    if marks is not None:
        shared = spark.sparkContext.broadcast(marks)
        place_schema, place_arrow = table(T.StructField("gram", T.LongType()), T.StructField("context", T.LongType()), *key_fields, T.StructField("place", T.LongType()))

        def common_halves(b):
            """(document, text, place of the gram, half) for the anchors of common grams of a batch."""
            for a, first, _ in _local_firsts(b, keys, length, gram):
                for k in first[_marked(shared.value, a.gram[first])].tolist():
                    doc, at = int(a.doc[k]), int(a.at[k])
                    text = b.column("text")[doc].as_buffer()
                    for half in halves(text, at, int(a.first[k]), int(a.last[k]), length, gram):
                        yield doc, text, at, half

        def split(batches):
            for b in batches:
                for some in itertools.batched(common_halves(b), _HALVES_AT_ONCE):
                    found = [(doc, key, xxhash.xxh3_64_intdigest(text[lo:hi + length], seed=at - lo), at << 32 | (at - lo) << 16 | (hi + length - at)) for doc, text, at, (key, lo, hi) in some]
                    doc, key, context, place = (np.array(x, kind) for x, kind in zip(zip(*found), (np.int64, _U, _U, np.int64)))
                    own = pa.array(doc)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(context.view(np.int64)), *[b.column(k).take(own) for k in keys], pa.array(place)], schema=place_arrow)

        half = materialized(docs.mapInArrow(split, place_schema), "lpf-halves")
        half_marks = _common_grams(half, hot)
        dealt = _rare(dealt, shared).union(half if half_marks is None else _rare(half, spark.sparkContext.broadcast(half_marks)))

    by_gram = Window.partitionBy("gram").orderBy("context", *keys, "place")
    whole = by_gram.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = dealt.select(
        "gram", *keys, "place", F.coalesce(F.lag("context").over(by_gram) == F.col("context"), F.lit(False)).alias("covered"),
        (F.first("context").over(whole) != F.last("context").over(whole)).alias("varied")).where("covered OR varied")
    marked = materialized(marked, "lpf-marked")
    at, before, after = F.shiftright("place", 32), F.shiftright("place", 16).bitwiseAND(0xFFFF), F.col("place").bitwiseAND(0xFFFF)
    spans = [seen.where("kind = 0").select(*keys, F.col("a").alias("lo"), F.col("b").alias("hi")), marked.where("covered").select(*keys, (at - before).alias("lo"), (at + after).alias("hi"))]

    # the bytes around the first anchor of each context of a varied gram
    wanted = marked.where("NOT covered").groupBy(*keys).agg(F.collect_list(F.struct("gram", "place")).alias("wanted")).select(*[F.col(k).alias(f"w_{k}") for k in keys], "wanted")
    cut_schema, cut_arrow = table(T.StructField("gram", T.LongType()), *key_fields, T.StructField("lo", T.LongType()), T.StructField("bytes", T.BinaryType()))

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for k in range(b.num_rows):
                text, rows = unpack(b.column("text")[k].as_py()), b.column("wanted")[k].values
                place = rows.field("place").to_numpy()
                lo, hi = (place >> 32) - (place >> 16 & 0xFFFF), (place >> 32) + (place & 0xFFFF)
                own = pa.array(np.full(len(place), k))
                yield pa.RecordBatch.from_arrays([rows.field("gram"), *[b.column(c).take(own) for c in keys], pa.array(lo), pa.array([text[x:y] for x, y in zip(lo.tolist(), hi.tolist())], pa.binary())], schema=cut_arrow)

    found = _packed(docs, keys)
    found = found.join(wanted, _same(keys, "w_")).select(*keys, "text", "wanted").mapInArrow(cut, cut_schema)
    part_schema, part_arrow = table(*key_fields, *span)

    def factors(batches):
        def judged(rows: pa.Table):
            data = rows.column("bytes").combine_chunks()
            sizes = np.diff(np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1]).astype(np.int64)
            many, off = sizes - length + 1, np.cumsum(sizes) - sizes
            row = np.repeat(np.arange(len(sizes)), many)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            hit = np.flatnonzero(repeated_windows(b"".join(_as_bytes(data)), off[row] + inner, length))
            if not len(hit):
                return
            r, s = row[hit], inner[hit] + rows.column("lo").to_numpy()[row[hit]]
            start = np.flatnonzero(np.r_[True, (np.diff(r) != 0) | (np.diff(s) != 1)])
            end = np.r_[start[1:], len(s)] - 1
            own = pa.array(r[start])
            yield pa.RecordBatch.from_arrays([*[rows.column(c).combine_chunks().take(own) for c in keys], pa.array(s[start]), pa.array(s[end] + length)], schema=part_arrow)

        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size * 40 >= _WINDOWS_AT_ONCE:  # whole grams only; the last one may go on
                rows = pa.Table.from_batches(held)
                grams = rows.column("gram").to_numpy()
                done = int(np.searchsorted(grams, grams[-1]))
                cuts = np.flatnonzero(np.diff(grams[:done])) + 1
                lo = 0
                for hi in [*cuts[np.flatnonzero(np.diff(cuts * 40 // _WINDOWS_AT_ONCE))], done]:
                    if hi > lo:
                        yield from judged(rows.slice(lo, hi - lo))
                        lo = hi
                held, size = rows.slice(done).combine_chunks().to_batches(), len(grams) - done
        if size:
            yield from judged(pa.Table.from_batches(held))

    spans.append(found.repartition("gram").sortWithinPartitions("gram", *keys, "lo").mapInArrow(factors, part_schema))

    if marks is not None and half_marks is not None:
        shared_halves = spark.sparkContext.broadcast(half_marks)
        window_schema, window_arrow = table(T.StructField("window", T.BinaryType()), *key_fields, T.StructField("lo", T.LongType()))

        def windows(batches):
            for b in batches:
                own, start, digest = [], [], []

                def rows():
                    return pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), *[b.column(c).take(pa.array(own, pa.int64())) for c in keys], pa.array(start, pa.int64())], schema=window_arrow)

                for doc, text, _, (key, lo, hi) in common_halves(b):
                    if not _marked(shared_halves.value, np.array([key], _U).view(np.int64))[0]:
                        continue
                    for s in range(lo, hi + 1):
                        own.append(doc)
                        start.append(s)
                        digest.append(xxhash.xxh3_128_digest(text[s:s + length]))
                    if len(start) >= _WINDOWS_AT_ONCE:
                        yield rows()
                        own, start, digest = [], [], []
                yield rows()

        every = materialized(docs.mapInArrow(windows, window_schema), "lpf-windows").withColumn("me", F.struct(*keys, "lo"))
        least = every.groupBy("window").agg(F.min("me").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
        spans.append(every.join(least, "window").where("NOT (me <=> least)").select(*keys, "lo", (F.col("lo") + length).alias("hi")))

    out = spans[0]
    for more in spans[1:]:
        out = out.union(more)
    return out.groupBy(*keys).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _same(keys: list[str], prefix: str):
    return [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys]


def _packed(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys and text, the text zstd-compressed for a shuffle."""
    schema = T.StructType([*[T.StructField(k, docs.schema[k].dataType) for k in keys], T.StructField("text", T.BinaryType())])

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([pack(x) for x in _as_bytes(b.column("text"))], pa.binary())], names=schema.names)

    return docs.select(*keys, "text").mapInArrow(run, schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per input row: id, n_bytes, spans (maximal removed runs: lo, hi), kept (remaining bytes).

    NULL and empty texts have no bytes; texts shorter than ``length`` lose none. NULL ids come before all others. Rows of
    equal id count as documents in the order of a hash of their text; exact repeats of a row get that row's result and are
    no copies of each other. ``length`` is 40 to 65535 bytes, ``gram`` at most ``length``; no task sorts ``hot`` or more contexts
    of one gram. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("k0"), F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("text"))
    keys = ["k0"]
    one = docs.select(F.col(f"`{id_col}`").alias("k0")).groupBy("k0").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if not one:
        rows, keys = rows.withColumn("k1", F.xxhash64("text")), ["k0", "k1"]
    distinct = rows if one else materialized(rows.dropDuplicates(keys), "lpf-distinct")
    spans = removed_spans(distinct, keys, length, gram, hot).select(*[F.col(k).alias(f"s_{k}") for k in keys], "spans")
    runs = T.ArrayType(T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]))
    schema = T.StructType([T.StructField("k0", rows.schema["k0"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("spans", runs), T.StructField("kept", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            n, cuts, kept = [], [], []
            for packed, found in zip(b.column("text"), b.column("spans")):
                text = unpack(packed.as_py())
                gone = _merged(found.values.field("lo").to_numpy(), found.values.field("hi").to_numpy()) if found.is_valid else []
                n.append(len(text))
                cuts.append([{"lo": x, "hi": y} for x, y in gone])
                kept.append(b"".join(text[x:y] for x, y in zip([0, *[g[1] for g in gone]], [*[g[0] for g in gone], len(text)])))
            yield pa.RecordBatch.from_arrays([b.column("k0"), pa.array(n, pa.int64()), pa.array(cuts, arrow.field("spans").type), pa.array(kept, pa.binary())], schema=arrow)

    out = _packed(rows, keys).join(spans, _same(keys, "s_"), "left").select("k0", "text", "spans").mapInArrow(run, schema)
    return out.withColumnRenamed("k0", id_col)
