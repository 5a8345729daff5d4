"""From raw files to clean staging tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmroll.fixed_values import FEED_COLUMNS
from firmroll.functions.cleaning import clean_feed, clean_field
from firmroll.sources.feeds import REPAIR, REPAIRED_IN, read_raw, width_repair
from firmroll.sources.storage import MOST_BUCKETS, staging_name, write_staging

BUCKET_BYTES = 256 * 1024 * 1024
BUCKET_ROWS = 1_000_000


def ingest_feed(spark: SparkSession, feed: str, paths: str | Sequence[str], quote: str | None = None) -> DataFrame:
    """Scan, name and clean one feed: a narrow plan without any shuffle. All columns are text and never NULL."""
    return clean_feed(read_raw(spark, feed, paths, quote), feed)


def ingest_marked(spark: SparkSession, feed: str, paths: str | Sequence[str], quote: str | None = None) -> DataFrame:
    """:func:`ingest_feed` with the columns ``REPAIR`` and ``REPAIRED_IN``, in the same scan.

    The marks stay with the rows, so counting them later is exact however often a task was run; a counter that tasks add
    to would count the tasks that are run again after the loss of an executor twice.
    """
    line = "whole_line"
    raw = read_raw(spark, feed, paths, quote, line)
    repair = width_repair(F.col(line), feed, quote)
    shard = F.when(F.col(line).isNotNull(), F.col("_metadata.file_name"))
    columns = [clean_field(name) for name in FEED_COLUMNS[feed]]
    return raw.select(*columns, repair.alias(REPAIR), shard.alias(REPAIRED_IN))


def repaired_rows(rows: DataFrame) -> DataFrame:
    """Marked rows of a staging table per shard and repair: ``shard``, ``repair``, ``n``. Only the marks are read, and
    statistics skip files without any.
    """
    marked = rows.where(F.col(REPAIR).isNotNull())
    return marked.groupBy(F.col(REPAIRED_IN).alias("shard"), F.col(REPAIR).alias("repair")).agg(F.count(F.lit(1)).alias("n"))


def bucket_count(spark: SparkSession, raw_root: str, period: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for all feeds of a month, from the bytes of its largest feed's raw files; their contents are not read.

    There are no more than the session allows; buckets grow beyond ``bucket_bytes`` then.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(f"{raw_root.rstrip('/')}/{period}")
    feed = F.regexp_extract("path", r"([A-Za-z]+)[^/]*$", 1)
    largest = files.groupBy(feed).agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    return min(max(1, -(-(largest or 0) // bucket_bytes)), int(spark.conf.get(MOST_BUCKETS)))


def buckets_for(spark: SparkSession, feeds: Iterable[DataFrame], least: int = 1, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for feeds that are tables, from the rows of the largest one; a plain scan is counted from its footers.

    A bucket is read by one task, so their number has to grow with the rows: a fixed one leaves cores idle and makes every
    sort of a bucket grow. There are at least ``least`` and no more than the session allows.
    """
    largest = max((rows.count() for rows in feeds), default=0)
    return min(max(least, -(-largest // bucket_rows)), int(spark.conf.get(MOST_BUCKETS)))


def stage_feed(
    spark: SparkSession,
    feed: str,
    paths: str | Sequence[str],
    period: str,
    buckets: int,
    database: str | None = None,
    path: str | None = None,
) -> str:
    """Ingest one feed into its staging table of the month and return the table's name.

    ``buckets`` must be alike for all feeds of a month; :func:`bucket_count` finds it. Rows that were padded or cut are
    marked.
    """
    table = staging_name(feed, period, database)
    write_staging(ingest_marked(spark, feed, paths), table, buckets=buckets, path=path)
    return table
