"""A corpus from documents: quality, near duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of docs.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm import jaccard, packing, paragraphs, pii, quality
from spindrift.llm.common import ensure_checkpoint_dir, free_name, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry classifier accepts.

    Null and empty texts and very long ones are scored like others; rows with null ids and repeated rows
    are judged by their texts; an empty table gives no rows; other columns may have any names.
    """
    column = free_name("_quality", docs.columns)
    scored = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")), column=column)
    return scored.where(F.col(column) >= 0.5).select(docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    Texts without words and rows with null ids stay, repeated rows stay once, very long texts are compared
    whole; an empty table gives no rows; other columns may have any names.
    """
    return jaccard.first_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has.

    Every row stays, if with an empty text; null texts and rows with null ids stay as they are, rows with one
    id keep each other's passages, very long texts are compared whole; an empty table gives no rows; other
    columns may have any names.
    """
    return paragraphs.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind.

    Every row stays; null and empty texts and null ids stay as they are, repeated rows change alike, very
    long texts are searched whole; an empty table gives no rows; other columns may have any names.
    """
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens.

    Null and empty texts are one piece of the end token, very long ones are cut into full pieces; null ids
    and repeated rows are packed like others; an empty table gives no rows; other columns are not read.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]
#: The stages learn models and resolve near duplicates, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
