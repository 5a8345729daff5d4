"""Command line: ``python -m firmroll stage|publish ...`` (also for ``spark-submit``)."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from firmroll.fixed_values import FEED_COLUMNS
from firmroll.plans.ingest import bucket_count, stage_feed
from firmroll.plans.monthly import lookup_tables, publish_month
from firmroll.sources.feeds import shard_glob
from firmroll.sources.storage import clear_scratch


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="firmroll")
    commands = top.add_subparsers(dest="command", required=True)

    stage = commands.add_parser("stage", help="raw files of one feed to its staging table")
    stage.add_argument("period", help="YYYY-MM")
    stage.add_argument("feed", choices=sorted(FEED_COLUMNS), type=str.lower)
    stage.add_argument("--raw-root", required=True, help="folder with one subfolder per period")
    stage.add_argument("--buckets", type=int, help="alike for all feeds of a month; by the largest feed's size if not given")

    publish = commands.add_parser("publish", help="staging tables to the live table")
    publish.add_argument("period", help="YYYY-MM or YYYYMM")
    publish.add_argument("old_period", nargs="?", help="period of the table that is live now")
    publish.add_argument("--table", required=True)
    publish.add_argument("--as-of", type=dt.date.fromisoformat, default=None, help="day to count ages to; today")
    publish.add_argument("--path", help="folder for snapshots; default beside the database")

    for command in (stage, publish):
        command.add_argument("--database")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"firmroll-{args.command}").getOrCreate()
    if args.command == "stage":
        raw = shard_glob(args.raw_root, args.period, args.feed)
        buckets = args.buckets or bucket_count(spark, args.raw_root, args.period)
        print(stage_feed(spark, args.feed, raw, args.period, buckets, args.database))
        return
    counts = publish_month(
        spark,
        args.period,
        lookup_tables(spark, args.database),
        args.as_of or dt.date.today(),
        args.table,
        args.old_period,
        args.database,
        args.path,
    )
    # One line per kind of count; all of them are in the table.
    summary = counts.groupBy("metric").agg(F.count("item").alias("items"), F.sum("n").alias("n")).orderBy("metric")
    for row in summary.collect():
        print(f"{row['metric']}: {row['n']}" + (f" in {row['items']} items" if row["items"] else ""))
    clear_scratch(spark)


if __name__ == "__main__":
    main()
