"""The registered query of each operator of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .common import table


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pq_dedup import near_copies

    return near_copies(table(spark, sf_dir, "embeddings"))


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .huffman import token_file, with_crc

    return with_crc(token_file(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json")))


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_rules import quality

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "depleted", "n_frequent_lines", "left_chars", "line_chars"]
    return quality(table(spark, sf_dir, "documents"), counts=True).select(*names)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import digest, scan

    return digest(scan(table(spark, sf_dir, "documents")))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import ngram_classes

    return ngram_classes(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    rows = pack(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled of high quality; background: all documents."""
    from .lm_scores import cross_entropy_difference

    target = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), target)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"))


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .preferences import by_opening, gather, preference_rows

    rows = preference_rows(by_opening(gather(table(spark, sf_dir, "conversations"))))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["length"])), ",")
    return rows.withColumns({"chosen_spans": spans("chosen_spans"), "rejected_spans": spans("rejected_spans")})


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .alignment import align

    return align(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model"))


def op12_elkan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .elkan import cluster

    return cluster(table(spark, sf_dir, "embeddings")).drop("asked")


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose crc32 of the id as text, modulo 5, is not 0."""
    from .language import identify

    return identify(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


QUERIES = {f.__name__: f for f in (op1_pq_dedup, op2_token_file, op3_line_frequency, op4_licenses, op5_ngram_jaccard, op6_packing, op7_cross_entropy, op8_toxicity, op9_bpe, op10_preferences, op11_alignment, op12_elkan, op13_language)}
ORACLE_SQL: dict[str, str] = dict(oracle.SQL)
