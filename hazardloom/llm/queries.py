"""Queries of the corpus operators over the supplied tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardloom.llm import (collocations, decontaminate, fingerprint, jaccard, language, negatives, oracles, pieces, pii,
                            quality, shards, suffix, tokencount, toxicity)
from hazardloom.llm.common import crc_mod


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, folder, "documents"))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.fit_toxicity(docs, labels, lambda doc_id: crc_mod(doc_id, 5) != 0)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "gain", "n_toxic")


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.fit_languages(docs, lambda doc_id: crc_mod(doc_id, 4) != 2)
    return language.predict_languages(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_components(_table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return tokencount.count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pieces.encoded_digests(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pii.find_pii(docs, pii.fit_pii(docs))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = quality.fit_quality(docs, labels, lambda doc_id: crc_mod(doc_id, 4) != 2)
    return quality.score_quality(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "line_quality")


def op11_balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard_documents(_table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_fingerprints, op3_toxicity, op4_language, op5_jaccard_join, op6_token_counts, op7_decontamination, op8_pieces, op9_pii, op10_quality,
                                  op11_balanced_shards, op12_hard_negatives, op13_collocations)}
ORACLES: dict[str, str] = {"op12_hard_negatives": oracles.OP12, "op13_collocations": oracles.OP13}
