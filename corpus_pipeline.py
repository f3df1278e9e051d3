"""A corpus pipeline in four stages: toxicity, quality rules, n-gram Jaccard join, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents. Rows with a null doc_id cannot be named by the
toxicity and the near-duplicate stage, which keep them; the quality stage decides about them by their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import pick, small_batches, staged, table
from tessera.llm.jaccard import ngram_classes
from tessera.llm.line_rules import quality
from tessera.llm.packing import pack
from tessera.llm.queries import vocabulary_file
from tessera.llm.toxicity import toxicity


#: Rows of texts in a batch: executors also hold what the stages before left.
BATCH = 500


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not predict toxic."""
    small_batches(spark, BATCH)
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return pick(docs, staged(scored.where("predicted = 1").select("doc_id"), "toxic"), ["doc_id"], "left_anti")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted by frequent lines."""
    small_batches(spark, BATCH)
    return quality(docs).where("kept").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group: five words, similarity of 0.8; one row of each id."""
    small_batches(spark, BATCH)
    rows = staged(ngram_classes(docs, n=5, num=80, den=100), "groups")
    kept = pick(docs, rows.where("doc_id <> component_id").select("doc_id"), ["doc_id"], "left_anti")
    again = staged(rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        return kept
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last()))
    repeated = pick(kept, again, ["doc_id"], "left_semi").select("*", first.alias("_n")).where("_n = 1").drop("_n")
    return pick(kept, again, ["doc_id"], "left_anti").unionByName(repeated)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of at most 2048 tokens. Small chunks and a small cache, as the executors hold what
    the stages before left."""
    small_batches(spark, BATCH)
    rows = pack(docs, vocabulary_file("byte_bpe_50k.json"), chunk_chars=1_000_000, cache_pieces=150_000)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("packing", pack_windows),
]

#: Packing and block-max neighbours are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
