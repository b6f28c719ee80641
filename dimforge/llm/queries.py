"""One query per operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm import bm25, decontam, langid, lpf, mixing, packing, revisits, sharding, simhash, url_filter, variants, vector_codes, wavelet

SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weighted_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards. NULL ids share a shard, repeated rows keep a slot each, NULL and empty texts have size 16; no documents give no rows."""
    out = sharding.shard_documents(_table(spark, sf_dir, "documents"), sharding.topology(SHARDS))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document. NULL, empty and white-space texts have fingerprint 0; repeated rows are kept; NULL ids get their fingerprint's component."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits derived from all pages, resolved. NULL URLs find no response, equal times take the greatest record, repeated pages are resolved each; no pages give no rows."""
    out = revisits.resolve_revisits(revisits.captures(_table(spark, sf_dir, "pages")))
    lines = F.array_join(F.transform("merged", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return out.select("rec_id", "canonical", "ts", "outcome", F.coalesce("resolved_to", F.lit(-1).cast("long")).alias("resolved_to"), lines.alias("merged_headers"), "body_digest")


def op4_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and removed bytes of every document. NULL and empty texts have none; of equal documents the one of the smallest id stays whole; no documents give no rows."""
    out = lpf.dedup(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["hi"] - x["lo"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_naive_bayes_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document. NULL and letterless texts are und with score 0; ties go to the first language; repeated rows are scored each; without labels all are und."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))), seed_col="doc_id")
    return langid.predict(docs, model).withColumn("held_out", langid.held_out(F.col("doc_id"))).select("doc_id", "held_out", "lang_pred", "score")


def op6_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every twentieth one. NULL and wordless texts find nothing and are not found; ties go to the smaller id; no documents give no rows."""
    docs = _table(spark, sf_dir, "documents")
    asked = docs.where(F.col("doc_id") % 20 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return bm25.search(bm25.build_index(docs), asked)


URL_RULES = [url_filter.Rule(*r.split()) for r in ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")]


def op7_gbt_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL. NULL and malformed URLs have an empty host and path and a verdict; equal URLs are judged alike; without labelled URLs all are allowed."""
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of the sources. NULL is a source; NULL and repeated ids keep a place each, no two rows share one; no documents give no rows."""
    docs = _table(spark, sf_dir, "documents")
    weights, rest = mixing.tempered_weights(docs)
    return mixing.mix(docs, weights, rest)


def op9_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item. NULL, empty and wordless texts and items are not found; repeated rows are found each; ties of tiles go to the first place."""
    return decontam.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, read back from its shard's file. NULL and empty texts are the end id; equal ids keep a row each in the order of their text's checksum."""
    import public_tokenizers

    shards = wavelet.write_shards(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return wavelet.read_shards(shards)


def op11_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector. NULL vectors and those with NULL or non-finite components are dropped; ties go to the lower entry; repeated rows are kept; NULL labels are equal."""
    coded, book = vector_codes.encode(_table(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return vector_codes.with_label_error(coded).select("vec_id", digits.alias("code"), "error", "label_error", F.lit(vector_codes.book_sha256(book)).alias("codebooks_sha256"))


def op12_frequency_vector_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents and their forms. NULL, empty and letterless texts hold none; repeated rows count each; ties of forms go to the smallest word."""
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces. NULL and empty texts are the end id alone; repeated rows and NULL ids are packed each; no documents give no rows."""
    import public_tokenizers

    return packing.piece_digests(packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


QUERIES = {f.__name__: f for f in (
    op1_weighted_hash_tree, op2_simhash_bktree, op3_warc_revisits, op4_lpf_dedup, op5_naive_bayes_langid, op6_block_max_wand, op7_gbt_url_filter, op8_pfair_mixing, op9_greedy_string_tiling, op10_wavelet_matrix,
    op11_ball_kmeans, op12_frequency_vector_trie, op13_minimum_bin_slack)}

_CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) r(i)) x)"""


def _tree_values(tree: list[sharding.Shard]) -> str:
    return ", ".join(f"('{p}', '{c}', {w!r})" for p, kids in sharding._children(tree).items() for c, w in kids.items())


def _descent(name: str, tree: str) -> str:
    """Three levels of least draws for every key."""
    def level(n: int, src: str) -> str:
        return f"""{name}{n} AS (
  SELECT d.key, arg_min(t.child, -ln((('0x' || substr(md5(d.key || '|' || t.child), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / t.weight) AS node
  FROM {src} d JOIN {tree} t ON t.parent = d.node GROUP BY d.key)"""

    return f"{level(1, 'keyed')}, {level(2, name + '1')}, {level(3, name + '2')}"


def _op1_sql() -> str:
    base = sharding.topology(SHARDS)
    return f"""
WITH {_CRC_TABLE},
base(parent, child, weight) AS (VALUES {_tree_values(base)}),
grown(parent, child, weight) AS (VALUES {_tree_values(sharding.grow(base))}),
keyed AS (SELECT DISTINCT coalesce(doc_id::VARCHAR, '\\N') AS key, '' AS node FROM documents),
{_descent('b', 'base')},
{_descent('g', 'grown')},
docs AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '\\N') AS key, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (
  SELECT doc_id, key, size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i::INT + 1, 2))::BIGINT)),
      lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295) AS text_crc32
  FROM docs, crc_table),
dealt AS (
  SELECT s.doc_id, s.size, s.text_crc32, split_part(b3.node, '/', 3)::INT AS shard, split_part(g3.node, '/', 3)::INT AS grown_shard,
    ('0x' || substr(md5('slot|' || CASE WHEN s.doc_id IS NULL THEN '' ELSE s.key || '|' END || s.text_crc32::VARCHAR), 1, 7))::BIGINT % 256 AS blk
  FROM summed s JOIN b3 USING (key) JOIN g3 USING (key))
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY blk, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM dealt"""


_OP3_SQL = """
WITH bare AS (
  SELECT page_id, md5(coalesce(html, '')) AS sum, 1600000000 + page_id * 60 AS t,
    regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM pages),
parts AS (
  SELECT *, regexp_replace(lower(regexp_extract(b, '^[^/?]*', 0)), '^www\\.|:(80|443)$', '', 'g') AS host,
    regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '\\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS kept
  FROM bare),
urls AS (
  SELECT *, host || path || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical, '"' || substr(sum, 1, 16) || '"' AS tag FROM parts),
pages_e AS (
  SELECT page_id, canonical, t, sum, page_id % 2 AS e1, page_id % 2 + CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END AS e2 FROM urls),
fulls AS (
  SELECT page_id * 8 + v AS rec_id, canonical, t + v * 86400 AS ts, md5(sum || ':' || e) AS sum, t + e * 86400 AS modified
  FROM (SELECT *, unnest([0, 1, 2]) AS v, unnest([0, e1, e2]) AS e FROM pages_e) WHERE NOT (v = 1 AND page_id % 5 = 0)),
visits AS (
  SELECT page_id * 8 + 3 AS rec_id, canonical, t + 3600 AS ts, CASE WHEN page_id % 7 = 0 THEN '"changed"' ELSE '"' || substr(md5(sum || ':0'), 1, 16) || '"' END AS tag, NULL AS modified, NULL AS sum FROM pages_e
  UNION ALL SELECT page_id * 8 + 4, canonical, t + 86400 + 3600, NULL, t + e1 * 86400, NULL FROM pages_e
  UNION ALL SELECT page_id * 8 + 5, canonical, t + 2 * 86400 + 3600, NULL, NULL, md5(sum || ':' || CASE WHEN page_id % 11 = 0 THEN 0 ELSE e2 END) FROM pages_e
  UNION ALL SELECT page_id * 8 + 6, canonical, t + 2 * 86400 + 7200, NULL, NULL, NULL FROM pages_e
  UNION ALL SELECT page_id * 8 + 7, canonical, t - 30, '"' || substr(md5(sum || ':0'), 1, 16) || '"', NULL, NULL FROM pages_e),
latest AS (
  SELECT v.rec_id AS visit, arg_max(f.rec_id, (f.ts, f.rec_id)) AS rec_id FROM visits v JOIN fulls f ON f.canonical = v.canonical AND f.ts < v.ts GROUP BY v.rec_id),
judged AS (
  SELECT v.*, f.rec_id AS full_id, f.modified AS fmodified, f.sum AS fsum, '"' || substr(f.sum, 1, 16) || '"' AS ftag,
    CASE WHEN f.rec_id IS NULL THEN 'no_response'
      WHEN coalesce(v.tag = '"' || substr(f.sum, 1, 16) || '"', v.modified = f.modified, v.sum = f.sum, true) THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM visits v LEFT JOIN latest l ON l.visit = v.rec_id LEFT JOIN fulls f ON f.rec_id = l.rec_id)
SELECT rec_id, canonical, ts, outcome, CASE WHEN outcome = 'resolved' THEN full_id ELSE -1 END AS resolved_to,
  CASE WHEN outcome <> 'resolved' THEN NULL
    ELSE 'cache-control: ' || CASE WHEN rec_id % 8 = 3 THEN 'max-age=600' ELSE 'max-age=60' END || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10)
      || 'etag: ' || coalesce(tag, ftag) || chr(10) || CASE WHEN rec_id % 8 = 5 THEN 'expires: ' || (ts + 60) || chr(10) ELSE '' END || 'last-modified: ' || coalesce(modified, fmodified) END AS merged_headers,
  CASE WHEN outcome = 'resolved' THEN fsum END AS body_digest
FROM judged"""

_OP6_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM documents),
tf AS (SELECT doc_id, w, count(*) AS tf FROM words GROUP BY ALL),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
len AS (SELECT doc_id, sum(tf) AS dl FROM tf GROUP BY doc_id),
size AS (SELECT count(*)::DOUBLE AS n, (SELECT sum(dl) FROM len)::DOUBLE / count(*) AS mean FROM documents),
scored AS (
  SELECT q.doc_id AS query_id, d.doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS score
  FROM tf q JOIN tf d ON d.w = q.w JOIN df ON df.w = q.w JOIN len ON len.doc_id = d.doc_id, size WHERE q.doc_id % 20 = 0 GROUP BY q.doc_id, d.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored)
SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

ORACLE = {"op1_weighted_hash_tree": _op1_sql(), "op3_warc_revisits": _OP3_SQL, "op6_block_max_wand": _OP6_SQL}
