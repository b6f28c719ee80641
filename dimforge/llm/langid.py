"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
MAX_TRAIN_ROWS = 1_000_000  # labelled rows that a model is fitted on at most
MAX_LANGS = 1_000  # classes, so that counts and matrix are bounded
SMOOTHING = 0.5
UNDETERMINED = "und"
_CHARS_AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Model:
    langs: list[str]
    log_prob: np.ndarray  # (orders * buckets, langs), float32
    log_prior: np.ndarray  # (langs,)


def _buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each code point (the last order - 1 wrap and are cut by the caller)."""
    h = np.zeros(len(codes), np.uint32)
    for k in range(order):
        h = (h ^ np.roll(codes, -k)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return (h & np.uint32(BUCKETS - 1)).astype(np.int64) + (order - 1) * BUCKETS


def _spans(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lower-cased texts as (code points, row of each), about _CHARS_AT_ONCE at a time.

    A text is framed by spaces. A longer text comes in pieces that overlap by the n-grams' context,
    so each n-gram is seen once.
    """
    longest = max(ORDERS)
    codes, rows, size = [], [], 0
    for i, t in enumerate(texts):
        c = np.frombuffer(f" {t or ''} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        for lo in range(0, len(c), _CHARS_AT_ONCE):
            piece = c[lo:lo + _CHARS_AT_ONCE + longest - 1]
            fresh = np.full(len(piece), i, np.int64)
            fresh[_CHARS_AT_ONCE:] = -1  # these start an n-gram of the next piece
            codes.append(piece)
            rows.append(fresh)
            size += len(piece)
            if size >= _CHARS_AT_ONCE:
                yield np.concatenate(codes), np.concatenate(rows)
                codes, rows, size = [], [], 0
    if size:
        yield np.concatenate(codes), np.concatenate(rows)


def _grams(codes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) arrays of every order; n-grams that would leave their text or piece are left out."""
    start = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) & (rows[1:] >= 0)])
    end = np.repeat(np.r_[start[1:], len(codes)], np.diff(np.r_[start, len(codes)]))
    for order in ORDERS:
        ok = (np.arange(len(codes)) + order <= end) & (rows >= 0)
        yield _buckets(codes, order)[ok], rows[ok]


def train(docs: DataFrame, text_col: str = "text", label_col: str = "lang", max_rows: int = MAX_TRAIN_ROWS, seed_col: str | None = None) -> Model:
    """Fits on the rows with a non-NULL label and text, on a hash sample of about ``max_rows`` of them if there are more.

    Counts are taken per task, then summed by Spark; only (language, bucket) sums reach the driver, at most
    MAX_LANGS x 3 x 32768 numbers. No labelled row gives a model without languages.
    """
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{label_col}`").cast("string").alias("lang"),
                       (F.col(f"`{seed_col}`").cast("string") if seed_col else F.col(f"`{text_col}`")).alias("seed")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    total = sum(r.n for r in sizes)
    if total > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("seed"), F.lit(1 << 30)) < int(max_rows / total * (1 << 30)))

    def count(batches):
        acc: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(1).to_pylist()
            for codes, row in _spans(b.column(0).to_pylist()):
                names, which = np.unique(np.array(langs, object)[np.unique(row[row >= 0])].astype(str), return_inverse=True)
                lang_of = np.zeros(len(langs), np.int64)
                lang_of[np.unique(row[row >= 0])] = which
                for bucket, r in _grams(codes, row):
                    n = np.bincount(lang_of[r] * (len(ORDERS) * BUCKETS) + bucket, minlength=len(names) * len(ORDERS) * BUCKETS)
                    for k, name in enumerate(names):
                        acc[name] = acc.get(name, 0) + n[k * len(ORDERS) * BUCKETS:(k + 1) * len(ORDERS) * BUCKETS]
        for name, n in acc.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([str(name)] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"])

    langs = [r.lang for r in sizes]
    counts = np.full((len(ORDERS) * BUCKETS, len(langs)), SMOOTHING)
    sums = rows.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    at = {x: k for k, x in enumerate(langs)}
    got = sums.toArrow() if langs else None
    if got is not None and got.num_rows:
        counts[got["bucket"].to_numpy(), np.array([at[x] for x in got["lang"].to_pylist()])] += got["n"].to_numpy()
    by_order = counts.reshape(len(ORDERS), BUCKETS, len(langs))
    log_prob = np.log(by_order / by_order.sum(axis=1, keepdims=True)).reshape(len(ORDERS) * BUCKETS, len(langs)).astype(np.float32)
    prior = np.log(np.array([r.n for r in sizes], float) / max(total, 1))
    return Model(langs, log_prob, prior)


def score(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the best language, its posterior) of each text; sparse rows times matrix as gather and segment sums."""
    total = np.tile(model.log_prior, (len(texts), 1))
    for codes, rows in _spans(texts):
        for bucket, r in _grams(codes, rows):
            if len(r):
                cut = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                total[r[cut]] += np.add.reduceat(model.log_prob[bucket], cut, axis=0, dtype=np.float64)
    best = total.argmax(axis=1)  # ties: the first language in order
    return best, 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)


def lettered(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def judged(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """(language, posterior) of each text; ``und`` and 0 for a NULL, a text without a letter, or a model without languages."""
    known = [bool(model.langs) and lettered(t) for t in texts]
    if not any(known):
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    best, prob = score(model, [t if ok else None for t, ok in zip(texts, known)])
    return [model.langs[k] if ok else UNDETERMINED for k, ok in zip(best, known)], np.where(known, prob, 0.0)


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, lang_pred and score (posterior, 0 to 1) of every row, whole texts.

    NULL, empty and letterless texts are ``und`` with score 0; equal texts get equal results; ties of languages go to
    the first in order. The matrix is broadcast: at most MAX_LANGS x 3 x 32768 numbers of four bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]

    def run(batches):
        for b in batches:
            lang, prob = judged(shared.value, b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(lang, pa.string()), pa.array(prob, pa.float64())], names=[*[f.name for f in fields], "lang_pred", "score"])

    out = docs.select(F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]).mapInArrow(
        run, T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is not ``und``; those with a letter if the model has no languages."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            keep = [x != UNDETERMINED for x in judged(shared.value, texts)[0]] if shared.value.langs else list(map(lettered, texts))
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 1 modulo 3 (a NULL id: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
