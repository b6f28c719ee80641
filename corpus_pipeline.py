"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. ``run`` writes each stage's rows as Parquet into the shared folder of
spark.checkpoint.dir and hands them, reread, to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm import decontam, langid, mixing, sharding, simhash
from dimforge.llm.tables import materialized

SHARDS = 40


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: NULL texts and texts without a letter. Repeated rows and NULL ids stay as they are."""
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))), seed_col="doc_id")
    return langid.identified(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group, of the smallest id; an id stays for every group that its texts are first in. NULL ids stay."""
    return simhash.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item of the benchmark; an empty benchmark drops none."""
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents in the order of the Pfair mix of their sources; NULL is a source, repeated rows keep a place each."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the documents to shards; the slots of each shard follow the mix.

    A row's position is computed again from the rows, the same as in ``mix_sources``, however the files are read.
    """
    rows = sharding.dealt(docs, sharding.topology(SHARDS), keep={"source": F.col("source"), "tie": mixing.row_hash(docs)})
    weights, rest = mixing.tempered_weights(rows)
    placed = mixing.mix(rows, weights, rest, keep=("size", "text_crc32", "shard", "grown_shard"), tie=F.col("tie"))
    return sharding.slots_by_position(materialized(placed.select("doc_id", "position", "kept.*"), "shard-positions"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None  # XXH64 fingerprints, components and the language model have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
