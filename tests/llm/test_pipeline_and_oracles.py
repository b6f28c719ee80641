import os
import sys
import zlib

import duckdb
import pytest
from edge import DOCS, rows, words

from conftest import ROOT, SF0001

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import corpus_pipeline as P  # noqa: E402
from check_oracle import digest  # noqa: E402

from dimforge.llm import decontam, queries, simhash  # noqa: E402


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = queries.QUERIES[key](spark, SF0001)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(queries.ORACLE[key])
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(columns, want)[0]


def test_all_queries_are_registered():
    import __spark_entry__ as E

    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


def test_pipeline_keeps_clean_documents_and_drops_the_others(spark, tmp_path):
    item = words(40, 500, 10 ** 6)
    data = rows() + [(300, words(50, 20) + " " + item, "en", "src1", 1), (301, words(55, 21), "en", "src1", 1)]
    spark.createDataFrame(data, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    lettered = [d for d in data if d[1] and any(c.isalpha() for c in d[1])]
    fps = [simhash.fingerprint(d[1]) for d in lettered]
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    first = {min(e[0] for e, y in zip(lettered, label) if x == y) for x in label}
    found = decontam.Items([(1, decontam.words_of(item))], 5)
    want = {d[0] for d in lettered if d[0] in first and not any(c >= 0.8 * 40 for _, c, _ in found.tilings(decontam.words_of(d[1])))}
    got = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want) and 300 not in want and 301 in want
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    docs = spark.createDataFrame(rows(), DOCS)
    spark.createDataFrame([(1, words(40, 500))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert all(stage(spark, docs.limit(0), str(tmp_path)).count() == 0 for _, stage in P.STAGES)


def test_slots_of_a_shard_follow_the_mix(spark, tmp_path):
    sources = ["hot"] * 700 + [f"src{i % 5}" for i in range(200)] + [None] * 60
    data = [(i, words(20, i), "en", s, 1) for i, s in enumerate(sources)] + [(None, words(20, 5000 + i), "en", "hot", 1) for i in range(40)]
    docs = spark.createDataFrame(data, DOCS).repartition(4, "doc_id")
    stages = dict(P.STAGES)
    mixed = [(d.doc_id, zlib.crc32(d.text.encode())) for d in stages["source_mixing"](spark, docs, str(tmp_path)).collect()]
    assert [x[0] for x in mixed] != sorted((x[0] for x in mixed), key=lambda i: (i is not None, i))
    got = stages["sharding"](spark, docs, str(tmp_path)).collect()
    assert len(got) == len(data) and len({r.shard for r in got}) > 20
    for s in {r.shard for r in got}:
        inside = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        keys = [(r.doc_id, r.text_crc32) for r in inside]
        assert [r.slot for r in inside] == list(range(len(inside))) and keys == [x for x in mixed if x in set(keys)]


def test_pipeline_with_clashing_columns_and_ids_that_repeat_with_other_texts(spark, tmp_path):
    from edge import frame

    a, b, c = (words(60, k) for k in (801, 802, 803))
    data = rows() + [(900, a, "en", "src1", 1), (901, a, "en", "src1", 1), (901, b, "de", None, 1), (902, c, "en", "src2", 1), (902, b + " tail", "en", "src2", 1), (None, words(60, 804), None, None, None)]
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = P.run(spark, str(tmp_path)).collect()
    crc = {(r.doc_id, r.text_crc32) for r in got}
    for key, text in ((900, a), (901, b), (902, c)):
        assert (key, zlib.crc32(text.encode())) in crc
    assert (901, zlib.crc32(a.encode())) not in crc and sum(r.doc_id is None for r in got) == 1
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
