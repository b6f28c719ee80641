"""SimHash near-duplicates: fingerprints, BK-trees, components.

Fingerprints within ``radius`` bits agree on all but ``radius`` of radius + 3 bit fields, so any
link is found among the fingerprints that share some 3 of the fields. Each such shard gets a
BK-tree whose children are keyed by their integer Hamming distance to the parent; a search
follows the edges within the radius. Trees stay with their shard: together they grow with the
corpus, so they travel to the shard's queries by the shuffle and are never sent to all executors.
A shard above ``TREE`` fingerprints is split again by the remaining bits (at most ``radius`` of
radius + 1 fields can differ) until what can differ is so few bits that the tree is small.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.llm.components import connected_components
from dimforge.llm.tables import materialized

TREE = 512  # fingerprints in one BK-tree; larger shards are split without loss
_SHINGLES_AT_ONCE = 1 << 16
_PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of a whole text: bit b is set if over half of the XXH64 (seed 42) of its word shingles have it.

    A-Z are lower-cased, words are runs of bytes other than ASCII white space, shingles keep repeats.
    Fewer words than a shingle: the whole sequence is the one shingle; no word (or NULL): 0.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined, n = b" ".join(found), max(1, len(found) - words + 1)
    starts = np.zeros(len(found) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1, out=starts[1:])
    first, last = starts[:n].tolist(), (starts[min(words, len(found)):][:n] - 1).tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for lo in range(0, n, _SHINGLES_AT_ONCE):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[lo:lo + _SHINGLES_AT_ONCE], last[lo:lo + _SHINGLES_AT_ONCE])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text", extra: Column | None = None) -> DataFrame:
    """(id, fp as a signed long, and ``extra``, a long, if given) of every row."""
    kind, more = docs.schema[id_col].dataType, [] if extra is None else [extra.alias("extra")]

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names=["id", "fp", "extra"][:len(b.columns)])

    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType()), *[T.StructField("extra", T.LongType()) for _ in more]])
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), *more).mapInArrow(run, schema)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def bk_forest(fp: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of the distinct fingerprints of each group (sorted): (root of each item, edge keys, edge children).

    The key of an edge is parent * 65 + distance, ascending; a parent has one child for each distance.
    All trees grow together: the first item that reaches a free edge takes it, the others go on below it.
    """
    n = len(fp)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    root = np.repeat(first, np.diff(np.r_[first, n]))
    left = np.setdiff1d(np.arange(n), first, assume_unique=True)
    at, keys, kids = root[left], [], []
    while len(left):
        key = at * 65 + _distance(fp[left], fp[at])
        taken, who, slot = np.unique(key, return_index=True, return_inverse=True)
        keys.append(taken)
        kids.append(left[who])
        below = np.ones(len(left), bool)
        below[who] = False
        at, left = left[who][slot][below], left[below]
    if not keys:
        return root, np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, kids = np.concatenate(keys), np.concatenate(kids)
    order = np.argsort(keys)
    return root, keys[order], kids[order]


def bk_search(fp: np.ndarray, root: np.ndarray, keys: np.ndarray, kids: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, found) of items within ``radius`` in the query's own tree, the query itself left out.

    The frontier holds (query, node); below a node at distance d only the edges d - radius to d + radius are followed.
    """
    found_q, found_n = [], []
    query, node = np.arange(len(fp)), root
    while len(query):
        d = _distance(fp[query], fp[node])
        hit = (d <= radius) & (query != node)
        found_q.append(query[hit])
        found_n.append(node[hit])
        lo = np.searchsorted(keys, node * 65 + np.maximum(d - radius, 0))
        hi = np.searchsorted(keys, node * 65 + np.minimum(d + radius, 64), side="right")
        many = hi - lo
        query = np.repeat(query, many)
        node = kids[np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(len(query))]
    return np.concatenate(found_q or [root]), np.concatenate(found_n or [root])


def _stars(groups: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of several shards as stars: every linked fingerprint with the smallest of its component there."""
    fp = np.concatenate(groups)
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    q, n = bk_search(fp, *bk_forest(fp, group), radius)
    low = np.arange(len(fp))
    while True:  # least label over the links, with pointer jumping
        new = low.copy()
        np.minimum.at(new, q, low[n])
        new = new[new]
        if (new == low).all():
            break
        low = new
    linked = np.flatnonzero(low != np.arange(len(fp)))
    return fp[linked], fp[low[linked]]


def _link(radius: int):
    def run(batches):
        for b in batches:
            todo, cost, out = [], 0, []
            for fps in b.column(0):
                todo.append(np.unique(np.array(fps.as_py(), np.int64)).view(np.uint64))
                cost += len(todo[-1]) ** 2
                if cost > _PAIRS_AT_ONCE:
                    out.append(_stars(todo, radius))
                    todo, cost = [], 0
            if todo:
                out.append(_stars(todo, radius))
            u, v = (np.concatenate([x[i] for x in out] or [np.zeros(0, np.uint64)]).view(np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def _fields(bits: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, x)) for x in np.array_split(np.array(bits), parts)]


def _mask(bits) -> int:
    return int(np.array(sum(1 << b for b in bits), np.uint64).view(np.int64))


def fingerprint_links(fps: DataFrame, radius: int = 2, tree: int = TREE) -> DataFrame:
    """(u, v): links that connect all distinct fingerprints (column fp) of at most ``radius`` differing bits.

    Connected as by all links, without listing all pairs of a dense group. ``radius`` 0 to 8.
    """
    if not 0 <= radius <= 8:
        raise ValueError("radius must be 0 to 8")
    fields = _fields(list(range(64)), radius + 3)
    shards = [_mask(b for f in pick for b in fields[f]) for pick in combinations(range(radius + 3), 3)]
    cur = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in shards])).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
    schema, out = "u long, v long", None
    left = 64 - min(sum(len(fields[f]) for f in pick) for pick in combinations(range(radius + 3), 3))
    while True:
        # what may differ in a shard: few bits mean a small tree whatever the data
        done = (1 << left) <= tree or left <= radius
        sizes = cur.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        small = cur.join(sizes.where("n > 1" if done else f"n > 1 AND n <= {tree}"), ["mask", "value"])
        links = small.groupBy("mask", "value").agg(F.collect_list("fp").alias("fps")).select("fps").mapInArrow(_link(radius), schema)
        out = links if out is None else out.union(links)
        if done:
            return out.distinct()
        hot = materialized(cur.join(sizes.where(f"n > {tree}"), ["mask", "value"]).select("fp", "mask"), "simhash-hot")
        if hot.isEmpty():
            return out.distinct()
        cuts = []
        for (m,) in hot.select("mask").distinct().collect():  # the masks are parameters: at most (radius + 3 choose 3) * (radius + 1)^level
            free = [b for b in range(64) if not (m >> b) & 1]
            cuts += [(m, m | _mask(f) if f else m) for f in _fields(free, radius + 1)]
        finer = hot.sparkSession.createDataFrame(cuts, "mask long, finer long")
        cur = hot.join(F.broadcast(finer), "mask").select("fp", F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("value")).distinct()
        left -= left // (radius + 1)


def _classes(rows: DataFrame, radius: int) -> DataFrame:
    """Adds component_id and root, the component's least fingerprint, to rows with id and fp."""
    least = materialized(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    comp = connected_components(fingerprint_links(least, radius))
    rooted = least.join(comp, least.fp == comp.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    top = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(top, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of at most ``radius`` differing bits, the row itself
    included; equal fingerprints are linked, so NULL, empty and white-space texts (fingerprint 0) are one group.
    Rows of NULL id get the component of their fingerprint (NULL if it holds no id). Repeated rows are kept.
    Other columns are ignored.
    """
    rows = materialized(fingerprints(docs, words, id_col, text_col), "simhash-fp")
    return _classes(rows, radius).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their group: one row of each group that ``near_duplicates`` finds.

    It is the row of the smallest id; where that id has several texts in the group, the one of the least fingerprint,
    then of the least hash of the text; of rows that repeat both, one. An id may stand for several groups by
    different texts. Rows of NULL id cannot stand for a group or be named in one: all stay. An empty table gives an empty one.
    """
    named = docs.where(F.col(f"`{id_col}`").isNotNull())
    hashed = F.xxhash64(F.col(f"`{text_col}`"))
    rows = fingerprints(named, words, id_col, text_col, hashed)
    first = _classes(materialized(rows, "simhash-fp"), radius).groupBy("root").agg(F.min(F.struct("id", "fp", "extra")).alias("first")).select(F.col("first.id").alias("__id"), F.col("first.extra").alias("__hash"))
    keyed = named.withColumn("__text_hash", hashed)
    kept = keyed.join(first, (keyed[id_col] == first["__id"]) & (keyed["__text_hash"] == first["__hash"]), "left_semi")
    return kept.dropDuplicates([id_col, "__text_hash"]).drop("__text_hash").unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
