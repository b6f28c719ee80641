"""Product codes for vectors by ball k-means.

Vectors are cut into equal parts, and each part position has a codebook of a few entries, refined by
rounds of assignment and averaging over whole numbers. An assignment starts from the entry that a part had
before. The parts of an entry are a ball around it: entries whose half distance exceeds the ball's radius
cannot be nearer to any of them, the rest are its neighbours. Parts nearer to their entry than half the way
to the first neighbour are the stable core and skip the work; the others lie in annular rings between the
half distances, and a part in ring k is compared with the k nearest neighbours alone. All of it is exact,
ties included. Balls are taken within a block of vectors, where their radii are smaller still.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dimforge.llm.tables import bucketed, materialized
from dimforge.operators.joins import broadcast_if_small

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
LIMIT = 1 << 28  # scaled components stay below, so that squared distances and a block's sums fit 64 bits
BLOCK = 1 << 14  # vectors of a block, one row of the work table
BUCKET_BYTES = 64 << 20


def assign(x: np.ndarray, book: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of every row of ``x``, starting from the entries ``code``; ties to the lower index."""
    x, book, code = x.astype(np.int64), book.astype(np.int64), code.astype(np.int64)
    dist = np.square(x - book[code]).sum(axis=1)
    reach = -(-np.square(book[:, None] - book[None]).sum(axis=2) // 4)  # an entry is a rival from this squared distance on
    best, best_dist = code.copy(), dist.copy()
    for i in np.unique(code).tolist():
        ball = np.flatnonzero(code == i)
        ball = ball[np.argsort(-dist[ball], kind="stable")]  # outermost ring first
        rivals = np.argsort(reach[i], kind="stable")
        within = np.searchsorted(-dist[ball], -reach[i][rivals], side="right")
        for j, n in zip(rivals.tolist(), within.tolist()):
            if not n:  # the radius is less than half the way to this entry and all further ones
                break
            if j == i:
                continue
            ring = ball[:n]
            d = np.square(x[ring] - book[j]).sum(axis=1)
            nearer = (d < best_dist[ring]) | ((d == best_dist[ring]) & (j < best[ring]))
            best[ring[nearer]], best_dist[ring[nearer]] = j, d[nearer]
    return best, best_dist


def _blocks(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int, block: int) -> tuple[DataFrame, int, int]:
    """The kept vectors in whole numbers, a block a row: block, ids, labels, wide (32 bits a component, else 16), vectors.
    Beside it their common length, and their number."""
    ids, labels = vectors.schema[id_col].dataType, vectors.schema[label_col].dataType
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.where("v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    longest, many = rows.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    width = -(-(longest or 0) // parts) * parts
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(ids)), T.StructField("labels", T.ArrayType(labels)),
                           T.StructField("wide", T.BooleanType()), T.StructField("vectors", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for b in batches:
            for lo in range(0, b.num_rows, block):
                piece = b.slice(lo, block)
                v, n = piece.column(2), piece.num_rows
                size = pc.list_value_length(v).to_numpy(zero_copy_only=False)
                out = np.zeros((n, width))
                out[np.arange(width) < size[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
                out = np.floor(out * SCALE)
                most = np.abs(out).max(initial=0)
                if most >= LIMIT:
                    raise ValueError(f"a component is {most / SCALE:g}; they must stay below {LIMIT // SCALE}")
                wide = bool(most >= 1 << 15)
                data = out.astype("<i4" if wide else "<i2").tobytes()
                lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), piece.column(k)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array([at]), *(x.cast(arrow.field(k + 1).type) for k, x in enumerate(lists)), pa.array([wide]), pa.array([data], pa.binary())], schema=arrow)
                at += 1

    return rows.mapInArrow(run, schema), width, many


def _numbers(wide: bool, data: bytes, parts: int, width: int) -> np.ndarray:
    """(rows, parts, components of a part)"""
    x = np.frombuffer(data, "<i4" if wide else "<i2")
    return x.reshape(-1, parts, width // parts) if width else x.reshape(0, parts, 0)


def _seeds(blocks: DataFrame, entries: int, parts: int, width: int) -> np.ndarray:
    """The vectors of the smallest ids (NULL last; of one id's rows the least), by id; a few rows of each task are compared."""
    schema = T.StructType([T.StructField("id", blocks.schema["ids"].dataType.elementType), T.StructField("v", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        found: dict = {}
        for b in batches:
            for ids, wide, data in zip(b.column(0), b.column(1), b.column(2)):
                ids, x = ids.values, _numbers(wide.as_py(), data.as_py(), 1, width)
                distinct = pc.unique(ids)
                low = distinct.take(pc.sort_indices(distinct)[:entries])  # NULL comes last
                for k in np.flatnonzero(pc.is_in(ids, value_set=low).to_numpy(zero_copy_only=False)).tolist():
                    key, v = ids[k].as_py(), x[k, 0].tolist()
                    found[key] = min(found.get(key, v), v)
            found = {k: found[k] for k in sorted(found, key=lambda k: (k is None, 0 if k is None else k))[:entries]}
        yield pa.RecordBatch.from_pylist([{"id": k, "v": v} for k, v in found.items()], schema=arrow)

    low = blocks.select("ids", "wide", "vectors").mapInArrow(run, schema).groupBy("id").agg(F.min("v").alias("v")).orderBy(F.asc_nulls_last("id")).limit(entries)
    rows = [r.v for r in low.collect()]
    return np.array(rows, np.int64).reshape(len(rows), parts, width // parts).transpose(1, 0, 2)


def _round(blocks: DataFrame, codes: DataFrame | None, book: np.ndarray) -> DataFrame:
    """block, codes and stats (how many parts each entry has, then their sums), a row a block."""
    parts, entries, width = book.shape

    def run(batches):
        for b in batches:
            for block, wide, data, before in zip(*b.columns):
                x = _numbers(wide.as_py(), data.as_py(), parts, parts * width)
                old = np.frombuffer(before.as_py(), "<u2").reshape(parts, -1) if before.is_valid else np.zeros((parts, len(x)), np.uint16)
                new = np.stack([assign(x[:, p], book[p], old[p])[0] for p in range(parts)])
                many = [np.bincount(new[p], minlength=entries) for p in range(parts)]
                sums = [np.bincount(new[p], x[:, p, j], entries).astype(np.int64) for p in range(parts) for j in range(width)]
                stats = np.concatenate([np.concatenate(many), np.array(sums, np.int64).reshape(parts, width, entries).transpose(0, 2, 1).ravel()])
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()]), pa.array([new.astype("<u2").tobytes()], pa.binary()), pa.array([stats.tolist()], pa.list_(pa.int64()))],
                                                 names=["block", "codes", "stats"])

    return _with_codes(blocks, codes, "wide", "vectors").mapInArrow(run, "block long, codes binary, stats array<long>")


def _with_codes(blocks: DataFrame, codes: DataFrame | None, *columns: str) -> DataFrame:
    if codes is None:
        return blocks.select("block", *columns, F.lit(None).cast("binary").alias("codes"))
    return blocks.select("block", *columns).join(codes.select("block", "codes").hint("shuffle_hash"), "block").select("block", *columns, "codes")


def _moved(stats: DataFrame, book: np.ndarray) -> np.ndarray:
    """Entries at the floored means of their parts; unused ones stay. The driver gets a number per entry component."""
    parts, entries, width = book.shape
    sums = stats.select(F.posexplode("stats").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    flat = np.zeros(parts * entries * (1 + width), object)
    for r in sums.collect():
        flat[r["at"]] = int(r["x"])
    many, total = flat[:parts * entries].reshape(parts, entries), flat[parts * entries:].reshape(parts, entries, width)
    out = book.copy()
    for p, e in zip(*np.nonzero(many)):
        out[p, e] = [int(s) // int(many[p, e]) for s in total[p, e]]
    return out


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes, error) of each kept row, and the codebooks (parts, entries, components of a part).

    Rows whose vector is NULL or holds NULL or non-finite components are dropped. Components become
    floor(4096 * x); one of 65,536 or more raises ValueError. Vectors shorter than the longest, or than a
    multiple of ``parts``, count as ending in zeros. Codebooks start as the vectors of the ``entries`` smallest
    ids (NULL ids last; an id counts once, with its least vector), so there are fewer entries if there are fewer ids.
    Repeated rows are kept, each counts. An empty table gives an empty one, and codebooks without entries.

    Blocks of vectors and their codes are two tables in the same buckets, so a round joins a vector with
    its entry of the round before without a shuffle, and writes two bytes a part. The driver gets sums per entry.
    """
    if entries > 1 << 16:
        raise ValueError("a code has at most 65,536 entries")
    made, width, many = _blocks(vectors, id_col, vector_col, label_col, parts, block)
    buckets = min(max(2 * width * many // BUCKET_BYTES, vectors.sparkSession.sparkContext.defaultParallelism), 100_000)
    blocks = bucketed(made.repartition(buckets, "block"), "vectors", "block", buckets)
    book, codes = _seeds(blocks, entries, parts, width), None
    for k in range(rounds if book.shape[1] else 0):
        codes = bucketed(_round(blocks, codes, book), f"codes{k}", "block", buckets)
        book = _moved(codes, book)
    schema = T.StructType([T.StructField("id", vectors.schema[id_col].dataType), T.StructField("label", vectors.schema[label_col].dataType),
                           T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    arrow = to_arrow_schema(schema)

    def last(batches):
        for b in batches:
            for _, ids, labels, wide, data, before in zip(*b.columns):
                x = _numbers(wide.as_py(), data.as_py(), parts, width)
                old = np.frombuffer(before.as_py(), "<u2").reshape(parts, -1) if before.is_valid else np.zeros((parts, len(x)), np.uint16)
                got = [assign(x[:, p], book[p], old[p]) for p in range(parts)]
                new, error = np.stack([g[0] for g in got], axis=1).astype(np.int32), np.sum([g[1] for g in got], axis=0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts), pa.array(new.ravel()))
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, lists.cast(arrow.field(2).type), pa.array(error)], schema=arrow)

    coded = _with_codes(blocks, codes, "ids", "labels", "wide", "vectors").mapInArrow(last, schema)
    return materialized(coded.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "codes", "error"), "vector-codes"), book


def book_sha256(book: np.ndarray) -> str:
    """Of all entries' decimal components by part, entry, position, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """Adds ``label_error``, the error summed over equal labels (NULLs are equal).

    Sums are pre-aggregated per task; they are broadcast if their size is checked to be small, else joined by a shuffle.
    """
    sums = materialized(coded.groupBy(F.col(f"`{label_col}`").alias("__label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(broadcast_if_small(sums), coded[label_col].eqNullSafe(sums["__label"])).drop("__label")
