"""Sharding by a hierarchical weighted hash tree.

A shard tree has regions, racks and shards. At every level a row draws one exponential
variate per child, -ln(u) / weight, with u hashed from the row's key and the child's name,
and descends into the smallest draw. A child therefore receives rows in proportion to its
weight, and a draw depends on nothing but the key, the child and the child's weight: a weight
that changes moves rows only into or out of the subtrees that hold it. A shard added with
``grow`` is a region of its own, so all other draws stay and rows move only into it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.llm.ranks import gapless_rank

MAX_SHARDS = 20_000  # the tree is a literal of the plan


@dataclass(frozen=True)
class Shard:
    shard: int
    region: str
    rack: str
    weight: float = 1.0


def topology(shards: int, regions: int = 4, racks: int = 2) -> list[Shard]:
    """``shards`` equal shards, numbered from 0, dealt to ``regions`` of ``racks`` racks in contiguous runs."""
    n = regions * racks
    return [Shard(s, f"region{s * n // shards // racks}", f"rack{s * n // shards}") for s in range(shards)]


def grow(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard (the next number), in a region of its own."""
    s = max((x.shard for x in tree), default=-1) + 1
    return [*tree, Shard(s, f"grown{s}", f"grown{s}", weight)]


def _children(tree: list[Shard]) -> dict[str, dict[str, float]]:
    """Node name -> {child name: weight}; names are paths, a node weighs what its shards weigh."""
    out: dict[str, dict[str, float]] = {}
    for x in tree:
        path = ["", f"{x.region}", f"{x.region}/{x.rack}", f"{x.region}/{x.rack}/{x.shard}"]
        for parent, child in zip(path, path[1:]):
            kids = out.setdefault(parent, {})
            kids[child] = kids.get(child, 0.0) + x.weight
    return out


def draw(key: Column, child: Column, weight: Column) -> Column:
    """Exponential variate with rate ``weight``, from 52 bits of the md5 of key and child."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", key, child).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 52))) / weight


def assign(key: Column, tree: list[Shard]) -> Column:
    """Shard number of a text key (NULL counts as the text ``\\N``): three weighted draws from the root."""
    if not tree:
        raise ValueError("a shard tree needs a shard")
    if len(tree) > MAX_SHARDS or len({x.shard for x in tree}) < len(tree) or any(x.weight <= 0 for x in tree):
        raise ValueError(f"shards must be distinct, of positive weight and at most {MAX_SHARDS}")
    key = F.coalesce(key, F.lit("\\N"))
    kids = _children(tree)
    depth: list[dict[str, dict[str, float]]] = [{k: v for k, v in kids.items() if (k.count("/") + bool(k)) == d} for d in range(3)]
    node: Column = F.lit("")
    for level in depth:
        table = F.create_map(*[x for parent, c in level.items() for x in (
            F.lit(parent), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in c.items()]))])
        drawn = F.transform(F.element_at(table, node), lambda c: F.struct(draw(key, c["name"], c["weight"]).alias("d"), c["name"].alias("name")))
        node = F.array_min(drawn)["name"]
    return F.element_at(F.split(node, "/"), -1).cast("int")


def dealt(docs: DataFrame, tree: list[Shard], id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row, without its text: id, size, text_crc32, shard, grown_shard (see ``shard_documents``) and the columns ``keep``."""
    text, key = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")), F.col(f"`{id_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").alias(id_col), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).cast("long").alias("text_crc32"), assign(key, tree).alias("shard"), assign(key, grow(tree)).alias("grown_shard"),
                       *[c.alias(k) for k, c in (keep or {}).items()])


def shard_documents(docs: DataFrame, tree: list[Shard], id_col: str = "doc_id", text_col: str = "text", blocks: int = 256) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes (NULL: 0) plus 16, ``text_crc32`` its CRC-32 (NULL and empty: 0),
    ``slot`` numbers the rows of a shard from 0 without gaps, ``grown_shard`` is the shard after ``grow``.
    Equal ids (also NULL ids) share a shard; repeated rows keep a slot each; an empty table gives an empty
    one. Only the id, size and checksum are shuffled. Other columns of ``docs`` are ignored.
    """
    rows, key = dealt(docs, tree, id_col, text_col), F.col(f"`{id_col}`").cast("string")
    spread = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("slot"), key, F.col("text_crc32").cast("string")).cast("binary")), 1, 7), 16, 10).cast("long")
    return gapless_rank(rows, ["shard"], spread, [F.col(f"`{id_col}`"), F.col("text_crc32"), F.col("size")], "slot", blocks).select(
        id_col, "size", "text_crc32", "shard", "slot", "grown_shard")


def slots_by_position(rows: DataFrame, position_col: str = "position", id_col: str = "doc_id", blocks: int = 256) -> DataFrame:
    """``dealt`` rows with a position each as the columns of ``shard_documents``: a shard's slots, from 0 without gaps, ascend with the position.

    A shard is cut into ranges of positions of about equal rows, so no task holds a whole shard; ``rows`` are read three times.
    Rows of one position, repeated ones too, get distinct slots; NULL positions come first; no rows give none.
    """
    at = F.col(f"`{position_col}`")
    cuts = sorted({int(x) for x in rows.approxQuantile(position_col, [i / blocks for i in range(1, blocks)], 0.25 / blocks)})
    spread = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<long>"), lambda c: c <= at)) if cuts else F.lit(0)
    return gapless_rank(rows, ["shard"], spread, [at], "slot", blocks).select(id_col, "size", "text_crc32", "shard", "slot", "grown_shard")
