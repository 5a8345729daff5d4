"""The end-to-end job of one month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from firmroll.fixed_values import FEED_COLUMNS, LOOKUP_COLUMNS, SIZE_OVERRIDE_TABLE
from firmroll.plans.enrich import Feeds, enrich
from firmroll.plans.ingest import bucket_count, stage_feed
from firmroll.plans.metrics import snapshot_metrics
from firmroll.plans.publish import publish_snapshot
from firmroll.sources.feeds import REPAIR, shard_glob
from firmroll.sources.listing import compact_period
from firmroll.sources.storage import read_snapshot, staging_name


def stage_month(
    spark: SparkSession, raw_root: str, period: str, database: str | None = None, buckets: int | None = None
) -> dict[str, str]:
    """Stage all four feeds; feed -> staging table. A feed that cannot be read fails the run.

    All feeds get the same number of buckets, by default from the size of the largest one.
    """
    buckets = buckets or bucket_count(spark, raw_root, period)
    return {
        feed: stage_feed(spark, feed, shard_glob(raw_root, period, feed), period, buckets, database)
        for feed in FEED_COLUMNS
    }


def staged_tables(spark: SparkSession, period: str, database: str | None = None) -> dict[str, DataFrame]:
    return {feed: spark.table(staging_name(feed, period, database)) for feed in FEED_COLUMNS}


def staged_feeds(spark: SparkSession, period: str, size_override: DataFrame, database: str | None = None) -> Feeds:
    staged = staged_tables(spark, period, database)
    tables = {feed: rows.select(FEED_COLUMNS[feed]) for feed, rows in staged.items()}
    return Feeds(
        establishments=tables["estabelecimentos"],
        companies=tables["empresas"],
        partners=tables["socios"],
        tax_status=tables["simples"],
        size_override=size_override,
    )


def lookup_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """The six dictionaries and the size override, which other jobs maintain, by table name."""
    prefix = f"{database}." if database else ""
    return {name: spark.table(prefix + name) for name in [*LOOKUP_COLUMNS, SIZE_OVERRIDE_TABLE]}


def publish_month(
    spark: SparkSession,
    period: str,
    lookups: Mapping[str, DataFrame],
    as_of: dt.date,
    table: str,
    old_period: str | None = None,
    database: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Enrich the staged month and publish it; returns the counts of the run, stored as ``<table>_metrics_<yyyymm>``."""
    feeds = staged_feeds(spark, period, lookups[SIZE_OVERRIDE_TABLE], database)
    marked = {feed: rows for feed, rows in staged_tables(spark, period, database).items() if REPAIR in rows.columns}
    publish_snapshot(enrich(feeds, lookups, as_of), table, period, old_period, path)
    counts = f"{table}_metrics_{compact_period(period)}"
    found = snapshot_metrics(feeds, read_snapshot(spark, table), marked)
    found.write.mode("overwrite").format("parquet").saveAsTable(counts)
    return spark.table(counts)
