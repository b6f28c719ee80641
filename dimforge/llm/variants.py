"""Spelling variants: words one edit apart, found with a trie over letter-group counts.

A word's vector counts its letters by groups of the alphabet. One inserted letter raises one count (a surplus
of one), a deleted one lowers one (a deficit of one), a replaced one does both or neither. The trie arranges
words by their successive counts; a depth-first search from a word's counts spends a surplus and a deficit of one
each, and the words of the leaves it reaches are compared letter by letter.

The trie of all words is spread over shards, one per prefix of the vector, and a word goes as a question to the few
prefixes it can reach with its budget. A prefix that holds too many words is cut again by the next counts; one that is
too large with all counts is dealt to several tasks in pieces, as are too many questions to one shard.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.llm.tables import materialized

#: Letters by group; all other code points are one more group.
GROUPS = ("e", "a", "t", "o", "i", "n", "s", "r", "l", "u", "dc", "mpq", "hgb", "fvkj", "wyxz")
STEP = 3  # counts by which a prefix grows
SHARD_WORDS, SHARD_ASKED = 50_000, 1_000_000
DROPPED_EVERY = 199
_HALVED = 256  # words of a leaf above which they are looked up by their halves
_PADDED = 32  # code points of a word above which it is compared by itself
_ASKED, _PAIRS = 4096, 1 << 18  # words that descend a trie together; pairs compared at once
_HELD = 200_000  # words that a task counts before it hands them on
_LOWER = {c: c + 32 for c in range(65, 91)}


def vectors(words: list[str], groups: tuple[str, ...] = GROUPS) -> np.ndarray:
    """(words, groups + 1): how many letters of each group every word has."""
    n, g = len(words), len(groups) + 1
    group = np.full(256, g - 1)
    for k, letters in enumerate(groups):
        group[[ord(c) for c in letters]] = k
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    of = np.where(codes < 256, group[codes & 255], g - 1)
    row = np.repeat(np.arange(n), np.fromiter(map(len, words), np.int64, n))
    return np.bincount(row * g + of, minlength=n * g).reshape(n, g)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


class Trie:
    """The words of a shard by their successive counts from level ``depth`` on, level by level in arrays.

    ``search`` lets a batch of words descend together: each visits the nodes that a depth-first search with its budget
    would. Words of the leaves are compared in arrays; a leaf with many words keeps them by their halves, as one edit
    leaves one half as it is, and so do words too long for the arrays.
    """

    def __init__(self, words: list[tuple[str, int]], depth: int, groups: tuple[str, ...] = GROUPS):
        counts = vectors([w for w, _ in words], groups)
        order = np.lexsort(counts.T[::-1])
        self.depth, self.words, counts = depth, [words[k] for k in order], counts[order]
        self.size = np.fromiter((len(w) for w, _ in self.words), np.int64, len(words))
        self.codes = _padded([w for w, _ in self.words])
        node = np.zeros(len(words), np.int64)
        self.levels = []
        for level in range(depth, counts.shape[1]):  # rows are sorted, so children are numbered in the order of their keys
            wide = int(counts[:, level].max()) + 1
            key = node * wide + counts[:, level]
            fresh = np.r_[True, key[1:] != key[:-1]]
            node = np.cumsum(fresh) - 1
            self.levels.append((wide, _children(key[fresh], wide)))
        self.first = np.r_[np.flatnonzero(np.r_[True, node[1:] != node[:-1]]), len(words)]
        self.halved: dict[int, tuple[dict, dict]] = {}

    def search(self, words: list[str], counts: np.ndarray, more: np.ndarray, less: np.ndarray) -> Iterator[tuple[int, int]]:
        """(number of a word in ``words``, of a stored word) one edit apart, where the stored word is as long and greater, or
        longer by one: each pair from one side. ``more`` and ``less`` are the words' surplus and deficit."""
        asked, node = np.arange(len(words)), np.zeros(len(words), np.int64)
        for k, (wide, children) in enumerate(self.levels):
            c = counts[asked, self.depth + k]
            parts = []
            for step, can in ((0, None), (1, more > 0), (-1, less > 0)):
                x = c + step
                at = np.flatnonzero((x >= 0) & (x < wide) if can is None else can & (x >= 0) & (x < wide))
                child = children(node[at] * wide + x[at])
                at, child = at[child >= 0], child[child >= 0]
                parts.append((asked[at], child, more[at] - (step == 1), less[at] - (step == -1)))
            asked, node, more, less = (np.concatenate(x) for x in zip(*parts))
        keep = more <= less  # equal budgets left: equal lengths
        asked, node = asked[keep], node[keep]
        lo, many = self.first[node], self.first[node + 1] - self.first[node]
        long = (many > _HALVED) | (self.size[lo] > _PADDED)
        for a, leaf in zip(asked[long].tolist(), node[long].tolist()):
            yield from ((a, w) for w in self._by_halves(leaf, words[a]))
        asked, lo, many = asked[~long], lo[~long], many[~long]
        ends = np.cumsum(many)
        mine = _padded(words)
        start = 0
        while start < len(many):  # so many pairs at once
            stop = max(int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _PAIRS, side="right")), start + 1)
            n = many[start:stop]
            a = np.repeat(asked[start:stop], n)
            w = np.repeat(lo[start:stop] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            hit = _one_edit(mine[a], self.codes[w], self.size[w])
            yield from ((x, y) for x, y in zip(a[hit].tolist(), w[hit].tolist()) if len(words[x]) < self.size[y] or words[x] < self.words[y][0])
            start = stop

    def _by_halves(self, leaf: int, word: str) -> Iterator[int]:
        lo, hi = self.first[leaf], self.first[leaf + 1]
        if leaf not in self.halved:
            heads, tails = self.halved[leaf] = {}, {}
            size = int(self.size[lo])
            for k in range(lo, hi):
                w = self.words[k][0]
                for h in {size // 2, (size - 1) // 2}:  # half of a word as long, or shorter by one
                    heads.setdefault(w[:h], []).append(k)
                    tails.setdefault(w[size - h:], []).append(k)
        heads, tails = self.halved[leaf]
        h = len(word) // 2
        head = word[:h]
        for k in (*heads.get(head, ()), *(k for k in tails.get(word[len(word) - h:], ()) if self.words[k][0][:h] != head)):
            other = self.words[k][0]
            if (len(word) < len(other) or word < other) and one_edit(word, other):
                yield k


def _children(keys: np.ndarray, wide: int):
    """Looks up child numbers by parent * wide + count; -1 where there is none."""
    size = (int(keys[-1]) // wide + 1) * wide
    if size <= 64 * len(keys):
        table = np.full(size, -1, np.int64)
        table[keys] = np.arange(len(keys))
        return lambda key: table[key]

    def looked_up(key):
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, at, -1)

    return looked_up


def _padded(words: list[str]) -> np.ndarray:
    """Code points of words of at most _PADDED, zeros behind (longer words: zeros)."""
    out = np.zeros((len(words), _PADDED + 1), np.uint16)
    short = [w if len(w) <= _PADDED else "" for w in words]
    size = np.fromiter(map(len, short), np.int64, len(short))
    out[np.arange(_PADDED + 1) < size[:, None]] = np.frombuffer("".join(short).encode("utf-32-le"), np.uint32)
    return out[:, :int(size.max(initial=0)) + 1]


def _one_edit(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``one_edit`` of padded rows, where row k of ``b`` has size[k] code points, as many as that of ``a`` or one more."""
    wide = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (a, b))
    differ = a != b
    as_long = a[np.arange(len(a)), size - 1] != 0
    first = differ.argmax(axis=1)
    moved = np.zeros_like(differ)  # from the first difference on, b is a moved by one
    moved[:, :-1] = a[:, :-1] != b[:, 1:]
    moved &= np.arange(wide) >= first[:, None]
    return np.where(as_long, differ.sum(axis=1) == 1, ~moved.any(axis=1))


def _reached(counts: list[int], lo: int, hi: int, more: int, less: int) -> Iterator[tuple[list[int], int, int]]:
    """Counts lo..hi that the budget reaches, with what is left of it."""
    part = counts[lo:hi]
    yield part, more, less
    for i in range(len(part)):
        if more:
            part[i] += 1
            yield part, more - 1, less
            for j in range(len(part)) if less else ():
                if j != i and part[j]:
                    part[j] -= 1
                    yield part, more - 1, less - 1
                    part[j] += 1
            part[i] -= 1
        if less and part[i]:
            part[i] -= 1
            yield part, more, less - 1
            part[i] += 1


_ROUTED = "key string, stored boolean, word string, n long, surplus int, deficit int"


def _routed(rows: DataFrame, lo: int, hi: int, groups: tuple[str, ...]) -> DataFrame:
    """Stored words under their prefix of length ``hi``, and every question under the prefixes it reaches, from rows routed to ``lo``."""
    def run(batches):
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])

            def put(*row):
                for c, x in zip(out, row):
                    c.append(x)

            rows = [c.to_pylist() for c in b.columns]
            for key, stored, word, n, more, less, counts in zip(*rows, vectors(rows[2], groups).tolist()):
                if stored:
                    put(key + ".".join(map(str, counts[lo:hi])) + ".", True, word, n, 0, 0)
                else:
                    for part, m, d in _reached(counts, lo, hi, more, less):
                        put(key + ".".join(map(str, part)) + ".", False, word, n, m, d)
                if len(out[0]) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)
                    for c in out:
                        c.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    types, names = [pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int32(), pa.int32()], [c.split()[0] for c in _ROUTED.split(", ")]
    return rows.mapInArrow(run, _ROUTED)


def _answered(rows: DataFrame, depth: int, groups: tuple[str, ...]) -> DataFrame:
    """Both directions of every near pair that meets in a shard: word, n, other, other_n."""
    def run(batches):
        shard, stored, trie = None, [], None
        for b in batches:
            keys, deals, is_stored, words, ns, more, less = (c.to_pylist() for c in b.columns)
            a, an, o, on = [], [], [], []
            lo = 0
            while lo < len(keys):  # rows come by shard, its stored words first
                if (keys[lo], deals[lo]) != shard:
                    shard, stored, trie = (keys[lo], deals[lo]), [], None
                hi = lo
                while hi < len(keys) and hi - lo < _ASKED and is_stored[hi] == is_stored[lo] and (keys[hi], deals[hi]) == shard:
                    hi += 1
                if is_stored[lo]:
                    stored += zip(words[lo:hi], ns[lo:hi])
                elif stored:
                    trie = trie or Trie(stored, depth, groups)
                    asked = words[lo:hi]
                    for x, y in trie.search(asked, vectors(asked, groups), np.array(more[lo:hi]), np.array(less[lo:hi])):
                        other, m = trie.words[y]
                        a += (asked[x], other)
                        an += (ns[lo + x], m)
                        o += (other, asked[x])
                        on += (m, ns[lo + x])
                lo = hi
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(an, pa.int64()), pa.array(o, pa.string()), pa.array(on, pa.int64())], names=["word", "n", "other", "other_n"])

    return rows.select("key", "deal", "stored", "word", "n", "surplus", "deficit").mapInArrow(run, "word string, n long, other string, other_n long")


def near_pairs(words: DataFrame, groups: tuple[str, ...] = GROUPS, step: int = STEP, shard_words: int = SHARD_WORDS, shard_asked: int = SHARD_ASKED) -> DataFrame:
    """(word, n, other, other_n) for all ordered pairs of distinct ``words`` (word, n) that are one edit apart.

    A prefix with over ``shard_words`` words goes on to longer prefixes; with all counts in the prefix its words
    are dealt to several tasks, and its questions go to each of them. Shards with over ``shard_asked`` questions are repeated
    for parts of them. The prefixes that are dealt so are broadcast: each stands for that many rows.
    """
    last, depth, found = len(groups) + 1, 0, None
    rows = words.select(F.lit("").alias("key"), F.explode(F.array(F.lit(True), F.lit(False))).alias("stored"), "word", "n", F.lit(1).alias("surplus"), F.lit(1).alias("deficit"))
    while True:
        upto = min(depth + step, last)
        rows, depth = materialized(_routed(rows, depth, upto, groups), f"variants-{upto}"), upto
        sizes = rows.groupBy("key").agg(F.count_if("stored").alias("words"), F.count_if(~F.col("stored")).alias("asked")).where("words > 0")
        large = materialized(sizes.where((F.col("words") > shard_words) | (F.col("asked") > shard_asked)).select(
            "key", (F.col("words") > shard_words).alias("hot"), F.ceil(F.col("words") / shard_words).cast("int").alias("of_words"), F.ceil(F.col("asked") / shard_asked).cast("int").alias("of_asked")), "variants-large")
        dealt = rows.join(F.broadcast(large), "key", "left").withColumns({"hot": F.coalesce("hot", F.lit(False)), "of_words": F.coalesce("of_words", F.lit(1)), "of_asked": F.coalesce("of_asked", F.lit(1))})
        here = dealt if depth == last else dealt.where(~F.col("hot"))
        own = F.pmod(F.xxhash64("word"), F.when(F.col("stored"), F.col("of_words")).otherwise(F.col("of_asked")))
        each = F.sequence(F.lit(0), F.when(F.col("stored"), F.col("of_asked")).otherwise(F.col("of_words")) - 1)
        here = here.withColumn("each", F.explode(each)).withColumn("deal", F.concat_ws(".", F.when(F.col("stored"), own).otherwise(F.col("each")).cast("string"), F.when(F.col("stored"), F.col("each")).otherwise(own).cast("string")))
        pairs = _answered(here.repartition("key", "deal").sortWithinPartitions("key", "deal", F.desc("stored")), depth, groups)
        found = pairs if found is None else found.union(pairs)
        if depth == last or large.where("hot").isEmpty():
            return found
        rows = dealt.where("hot").select("key", "stored", "word", "n", "surplus", "deficit")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, dropped_every: int = DROPPED_EVERY) -> DataFrame:
    """(word, n) of all words of at least ``least_length`` code points in the whole texts.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. Where ``dropped_every`` divides the
    checksum h of "<id>:<word>" (NULL id: empty), the word is counted without its code point h % length.
    """
    runs = re.compile(f"[A-Za-z\u00c0-\u00ff]{{{least_length},}}")

    def run(batches):
        held: Counter = Counter()

        def handed():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                low: Counter = Counter()
                for w, n in Counter(runs.findall(text.as_py() or "")).items():
                    low[w.lower() if w.isascii() else w.translate(_LOWER)] += n
                seed = zlib.crc32(b":" if key is None else f"{key}:".encode())
                for w, n in low.items():
                    h = zlib.crc32(w.encode(), seed)
                    if h % dropped_every == 0:
                        w = w[:h % len(w)] + w[h % len(w) + 1:]
                        if len(w) < least_length:
                            continue
                    held[w] += n
                if len(held) > _HELD:
                    yield handed()
        yield handed()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def variants(words: DataFrame, ratio: int = 5, max_rounds: int = 64, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct ``words`` (word, n).

    Near words differ by one inserted, deleted or replaced code point. ``form`` is the near word of largest n (ties: smallest
    in code-point order) if that n is at least ``ratio`` times the word's own, else NULL. ``root`` follows the forms to
    the last, by jumps that double. No words give no rows.
    """
    near = near_pairs(words, **options).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best"))
    has_form = F.col("near.best.n") * -1 >= F.lit(ratio) * F.col("w.n")
    formed = materialized(words.alias("w").join(near.alias("near"), F.col("w.word") == F.col("near.word"), "left").select(
        "w.word", "w.n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("near.best.word")).alias("form"),
        F.when(has_form, -F.col("near.best.n")).alias("form_n")), "variants-forms")
    hop = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max_rounds):  # a form's n is a multiple of its word's, so chains are short
        nxt = hop.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = materialized(hop.join(nxt, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "variants-roots")
        hop = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    else:
        raise RuntimeError(f"roots did not settle in {max_rounds} rounds")
    return formed.join(hop, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_n: int = 5, **options) -> DataFrame:
    """``variants`` of the words that occur at least ``least_n`` times in the whole texts of ``docs``.

    NULL, empty and letterless texts hold no words; repeated rows count each time; other columns are ignored; an
    empty table gives an empty one.
    """
    words = word_counts(docs, id_col, text_col).where(F.col("n") >= least_n)
    return variants(materialized(words, "variants-words"), **options)
