"""What several corpus operators share: the given tables, ASCII rules, scratch tables, rows that stay."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmroll.sources.storage import scratch_path

# The six blanks that separate words, and the letters whose case is ignored.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_ROWS = 1000
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a name like it that no column of ``df`` has in any case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Batches of at most ``rows`` rows to Python workers while a job runs: texts are long, workers many."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a narrow intermediate result to the shared folder and read it back.

    It cuts lineage, survives the loss of executors, and lets a job that runs twice see the same rows.
    """
    path = scratch_path(df.sparkSession, label)
    with small_batches(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame) -> Column:
    """Identifies a row by content: rows that differ in no column are interchangeable.

    The hash passes over nulls, so each column goes in with a flag for them.
    """
    columns = [F.col(f"`{name}`") for name in df.columns]
    return F.xxhash64(*[part for column in columns for part in (column, column.isNull())])


def rows_that_stay(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``(doc_id, row_key)`` is in ``keys``; of rows equal in all columns one stays.

    Shuffled once, on the pair, which no two different documents share, so no key is hot but a row repeated in full;
    those copies are dropped before the shuffle. A null doc_id counts as 0 there: ``row_key`` tells it from one.
    """
    mark, own = (f"_{name}_{uuid.uuid4().hex[:8]}" for name in ("mark", "id"))
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    keyed = docs.withColumn(mark, row_key(docs)).withColumn(own, number)
    listed = keys.select(number.alias(own), F.col("row_key").alias(mark))
    return keyed.join(listed, [own, mark], "left_semi").dropDuplicates([own, mark]).select(docs.columns)
