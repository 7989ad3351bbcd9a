"""Training-data pipeline over `documents`: each stage reads what the one before has written.

quality classifier -> n-gram Jaccard join -> benchmark decontamination -> personal data -> SentencePiece pieces.
Rejected documents, all but one of near-equal ones, and documents with benchmark passages go; personal data is
replaced by its kind; the last stage adds the pieces. A null text has the quality of an empty one; with empty
tables every stage returns no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hazardloom.llm import decontaminate, jaccard, pieces, pii, quality
from hazardloom.llm.common import Scratch

#: Name of the tokenizer file that the last stage looks up.
PIECES = "piece_bpe_32k.model"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.good_documents(docs, quality.fit_quality(docs, labels))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs, pii.fit_pii(docs))


def add_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.encode_documents(docs, public_tokenizers.path(PIECES))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_uncontaminated),
    ("PII", redact_personal_data),
    ("SentencePiece encoding and decoding", add_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
