"""A training-data pipeline over ``documents``: quality, exact and near copies, secrets, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``, works on all rows that the stage before it kept, and is written
as Parquet before the next one reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firmroll.llm.common import DOCUMENT_COLUMNS, table
from firmroll.llm.exact_dedup import without_copies
from firmroll.llm.packing import pack
from firmroll.llm.quality import good_documents
from firmroll.llm.secrets import masked
from firmroll.llm.simhash import without_near_copies
from firmroll.sources.storage import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a fence rejects go."""
    return good_documents(docs.select(DOCUMENT_COLUMNS))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that differ in blanks at most, the longest stays."""
    return without_copies(docs.select(DOCUMENT_COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return without_near_copies(docs.select(DOCUMENT_COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return masked(docs.select(DOCUMENT_COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# Token ids cannot be made in SQL; the stages are tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
