"""Benchmark decontamination by greedy string tiling.

A document is searched for the test items' words. Seeds are Karp-Rabin hashes of ``min_match``
consecutive words that document and item share (their words are compared, too). Tiling then
marks, again and again, the longest match of unmarked words of both, down to ``min_match`` words.
The share of the item's words under tiles is the coverage; order does not matter, so moved
passages count. Documents are scanned where they lie: nothing of them is shuffled.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MIN_MATCH = 5  # words of the shortest tile
COVERAGE = 0.8
BLOCK_WORDS = 5_000_000  # words of test items broadcast at once; more items take more passes
_PAIRS = 1 << 18  # pairs of equal seeds of a text that are listed at once; more are found by diagonals
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, lower-cased."""
    return _WORD.findall((text or "").lower())


def karp_rabin(ids: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of every run of ``size`` ids."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * _BASE + ids[k:k + n].astype(np.uint64) + np.uint64(1)
    return h


class Items:
    """Test items of a block: vocabulary, words and seeds."""

    def __init__(self, items: list[tuple[object, list[str]]], min_match: int):
        self.min_match, self.vocabulary, self.keys, self.ids = min_match, {}, [], []
        seeds, where = [], []
        for key, words in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64)
            h = karp_rabin(ids, min_match)
            seeds.append(h)
            where.append(np.stack([np.full(len(h), len(self.ids)), np.arange(len(h))], axis=1))
            self.keys.append(key)
            self.ids.append(ids)
        seeds = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(seeds, kind="stable")
        self.seeds = seeds[order]
        self.where = (np.concatenate(where) if where else np.zeros((0, 2), np.int64))[order]

    def tilings(self, words: list[str]):
        """(item index, covered words, tiles) of every item that shares a seed with the words."""
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        known = np.convolve(ids >= 0, np.ones(self.min_match, np.int64), "valid") == self.min_match if len(ids) >= self.min_match else np.zeros(0, bool)
        at = np.flatnonzero(known)
        if not len(at) or not len(self.seeds):
            return
        h = karp_rabin(ids, self.min_match)[at]
        lo = np.searchsorted(self.seeds, h)
        at, h, lo = (x[self.seeds[np.minimum(lo, len(self.seeds) - 1)] == h] for x in (at, h, lo))
        many = np.searchsorted(self.seeds, h, side="right") - lo
        if many.sum() > _PAIRS:  # words that repeat on both sides: their pairs are not listed
            first = np.unique(lo, return_index=True)[1]
            items = np.unique(np.concatenate([self.where[a:a + n, 0] for a, n in zip(lo[first].tolist(), many[first].tolist())]))
            found = ((int(item), _diagonals(ids, self.ids[item], self.min_match)) for item in items)
        else:
            found = self._paired(ids, at, lo, many)
        for item, runs in found:
            tiles = greedy_tiles(runs, self.min_match)
            if tiles:
                yield item, sum(t[2] for t in tiles), len(tiles)

    def _paired(self, ids, at, lo, many):
        """(item, maximal common runs) from the pairs of equal seeds."""
        doc = np.repeat(at, many)
        hit = self.where[np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(len(doc))] if len(doc) else np.zeros((0, 2), np.int64)
        order = np.lexsort((hit[:, 1], doc, hit[:, 0]))
        for cut in np.split(order, np.flatnonzero(np.diff(hit[order, 0])) + 1) if len(order) else []:
            item = int(hit[cut[0], 0])
            runs: dict[int, list[list[int]]] = defaultdict(list)
            for d, i in zip(doc[cut].tolist(), hit[cut, 1].tolist()):
                if (ids[d:d + self.min_match] != self.ids[item][i:i + self.min_match]).any():
                    continue
                diagonal = runs[d - i]
                if diagonal and d == diagonal[-1][0] + diagonal[-1][2] - self.min_match + 1:
                    diagonal[-1][2] += 1
                else:
                    diagonal.append([d, i, self.min_match])
            yield item, [tuple(r) for found in runs.values() for r in found]


def _diagonals(text: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of at least ``min_match`` words, by one pass over the text per word of the item: the length of the match
    that ends at each place of the text. Memory is a few numbers per word of the text, however often words repeat."""
    length, runs = np.zeros(len(text) + 1, np.int64), []
    for i, word in enumerate([*item.tolist(), -2]):
        now = np.zeros(len(text) + 1, np.int64)
        now[1:] = np.where(text == word, length[:-1] + 1, 0)
        ended = length >= min_match  # not prolonged by this word, or at the end of the text
        ended[:-1] &= now[1:] == 0
        at = np.flatnonzero(ended)
        n = length[at]
        runs += zip((at - n).tolist(), (i - n).tolist(), n.tolist())
        length = now
    return runs


def greedy_tiles(runs: list[tuple[int, int, int]], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (text position, item position, length): the longest match of unmarked words first, until none is left.

    ``runs`` are the maximal common runs of at least ``min_match`` words. A tile cuts what it overlaps, and the
    rests compete again. Ties: first in the text, then the item.
    """
    heap = [(-n, d, i) for d, i, n in runs]
    heapq.heapify(heap)
    in_text, in_item, tiles = set(), set(), []
    while heap:
        n, d, i = heapq.heappop(heap)
        free = [k for k in range(-n) if d + k not in in_text and i + k not in in_item]
        if len(free) == -n:
            tiles.append((d, i, -n))
            in_text.update(range(d, d - n))
            in_item.update(range(i, i - n))
            continue
        start = 0  # the unmarked rests that are still long enough
        for k in range(1, len(free) + 1):
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - start >= min_match:
                    heapq.heappush(heap, (start - k, d + free[start], i + free[start]))
                start = k
    return tiles


def _blocks(benchmark: DataFrame, min_match: int, item_col: str, item_text_col: str, block_words: int):
    """Test items in blocks of at most ``block_words`` words (one item at least), each broadcast; items come one by one.

    A block is a list of ``Items``, by length of the seeds: an item of fewer than ``min_match`` words is one seed.
    """
    shared = benchmark.sparkSession.sparkContext.broadcast

    def packed(items):
        return shared([Items(own, n) for n in range(1, min_match + 1) if (own := [x for x in items if min(len(x[1]), min_match) == n])])

    block, size = [], 0
    for r in benchmark.select(F.col(f"`{item_col}`").alias("k"), F.col(f"`{item_text_col}`").alias("t")).orderBy("k", "t").toLocalIterator():
        words = words_of(r.t)
        if block and size + len(words) > block_words:
            yield packed(block)
            block, size = [], 0
        if words:
            block.append((r.k, words))
            size += len(words)
    if block:
        yield packed(block)


def _found(tables: list[Items], text: str | None, coverage: float):
    """(item, covered words, its words, tiles) with at least ``coverage``."""
    words = words_of(text)
    for t in tables:
        for k, covered, n in t.tilings(words):
            if covered >= coverage * len(t.ids[k]):
                yield t.keys[k], covered, len(t.ids[k]), n


def contaminations(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, item_id, covered, n_words, tiles, coverage) of each document and test item with at least ``coverage``.

    An item of fewer than ``min_match`` words has to occur as a whole. Items without a word, NULL texts and empty
    tables find nothing; repeated items or documents are found each; a very long text is read whole; other columns
    are ignored. Each block of items is one pass over the documents.
    """
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("item", benchmark.schema[item_col].dataType),
                           T.StructField("covered", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("tiles", T.LongType())])
    arrow = to_arrow_schema(schema)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def search(shared):
        def run(batches):
            for b in batches:
                rows = [(key, *hit) for key, text in zip(b.column(0).to_pylist(), b.column(1)) for hit in _found(shared.value, text.as_py(), coverage)]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=arrow)

        return texts.mapInArrow(run, schema)

    out = texts.sparkSession.createDataFrame([], schema)
    for shared in _blocks(benchmark, min_match, item_col, item_text_col, block_words):
        out = out.union(search(shared))
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "covered", "n_words", "tiles", (F.col("covered") / F.col("n_words")).alias("coverage"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``contaminations`` finds nothing in.

    NULL, empty and wordless texts stay, as do all rows where no item has a word; repeated rows stay or go together.
    """
    at = docs.columns.index(text_col)

    def clean(shared):
        def run(batches):
            for b in batches:
                yield b.filter(pa.array([not any(_found(shared.value, text.as_py(), coverage)) for text in b.column(at)], pa.bool_()))

        return run

    for shared in _blocks(benchmark, min_match, item_col, item_text_col, block_words):
        docs = docs.mapInArrow(clean(shared), docs.schema)
    return docs
