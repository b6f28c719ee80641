import zlib

import pytest
from edge import frame, repeated

from dimforge.llm import sharding


def test_every_row_gets_a_slot_and_growth_moves_rows_only_into_the_new_shard(spark):
    data = repeated()
    got = sharding.shard_documents(frame(spark, data), sharding.topology(8)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (False, d[0], len((d[1] or "").encode()) + 16, zlib.crc32((d[1] or "").encode())) for d in data if d[0] is not None)
    assert len(got) == len(data)
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert sharding.shard_documents(frame(spark, []), sharding.topology(3)).count() == 0


def test_weights_decide_shares_and_a_changed_weight_moves_rows_only_through_its_subtree(spark):
    docs = spark.range(20000).selectExpr("id AS doc_id", "'x' AS text")
    tree = [sharding.Shard(0, "a", "r", 1.0), sharding.Shard(1, "a", "r", 3.0), sharding.Shard(2, "b", "r", 4.0), sharding.Shard(3, "c", "r", 8.0)]
    heavier = [*tree[:3], sharding.Shard(3, "c", "r", 16.0)]
    key = docs.doc_id.cast("string")
    rows = docs.select(sharding.assign(key, tree).alias("a"), sharding.assign(key, heavier).alias("b")).collect()
    share = [sum(r.a == s for r in rows) / len(rows) for s in range(4)]
    assert share == pytest.approx([1 / 16, 3 / 16, 4 / 16, 8 / 16], abs=0.02)
    assert all(r.b in (r.a, 3) for r in rows) and any(r.b != r.a for r in rows)
    with pytest.raises(ValueError):
        sharding.assign(key, [])
