"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from archive_spark.llm import decontaminate, jaccard_join, packing, quality, secrets
from archive_spark.llm.queries import tokenizer_path
from archive_spark.llm.registry import table
from archive_spark.session import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secrets.mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", good_quality),
    ("jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("secret_scans", masked_secrets),
    ("packing", packed),
]

# A trained classifier and a tokenizer are beyond SQL; tests/llm compares every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
