"""Publishing a snapshot under its live name, with the previous one archived by month."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from firmroll.fixed_values import ARCHIVE_BEFORE_PERIOD, ARCHIVE_OF_PERIOD
from firmroll.plans.enrich import PARTITION
from firmroll.sources import switch
from firmroll.sources.listing import compact_period
from firmroll.sources.switch import Journal


def archive_name(table: str, period: str, old_period: str | None = None) -> str:
    """Name that the live table takes when it makes way for ``period``."""
    pattern = ARCHIVE_OF_PERIOD if old_period else ARCHIVE_BEFORE_PERIOD
    return pattern.format(table=table, period=compact_period(old_period or period))


def snapshot_root(spark: SparkSession, table: str) -> str:
    """Default folder for the snapshots of a table: beside the tables of its database."""
    database, _, name = table.rpartition(".")
    location = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{location.rstrip('/')}/{name}_snapshots"


def write_snapshot(df: DataFrame, table: str, path: str) -> None:
    """Write rows partitioned by state and sorted by key within each file, as an external table at ``path``.

    The partition column is the never-blank state label, since a blank partition value would come back as NULL.
    Numbered rows arrive ranged and sorted by state and key, so each task holds few states and nothing moves or is
    sorted again here.
    """
    (
        df.write.mode("errorifexists")
        .format("parquet")
        .partitionBy(PARTITION)
        .option("path", path)
        .saveAsTable(table)
    )


@dataclass
class Publication:
    """One change of the live name, step by step. All that is needed to undo it is in its fields, and in the journal.

    ``live_was`` and ``archive_was`` are the tables that the two names stood for before; ``adopted`` lists names that
    were plain tables, with the versioned names that those tables get.
    """

    table: str
    fresh: str
    folder: str
    archive: str
    live_was: str | None = None
    archive_was: str | None = None
    adopted: list[list[str]] = field(default_factory=list)

    @staticmethod
    def planned(spark: SparkSession, table: str, period: str, old_period: str | None, root: str) -> Publication:
        table = switch.qualified(spark, table)
        fresh = switch.version_of(table, f"{compact_period(period)}_")
        one = Publication(table, fresh, f"{root}/{fresh.rpartition('.')[2]}", archive_name(table, period, old_period))
        for name, was in ((table, "live_was"), (one.archive, "archive_was")):
            found = switch.target(spark, name)
            if found == name:
                found = switch.version_of(name)
                one.adopted.append([name, found])
            setattr(one, was, found)
        return one

    def adopt(self, spark: SparkSession) -> None:
        """Names that are plain tables become switched names; there is no table for a moment, but only this once."""
        for name, version in self.adopted:
            switch.rename(spark, name, version)
            switch.point(spark, name, version)

    def write(self, df: DataFrame) -> None:
        write_snapshot(df, self.fresh, self.folder)

    def keep_previous(self, spark: SparkSession) -> None:
        if self.live_was:
            switch.point(spark, self.archive, self.live_was)

    def go_live(self, spark: SparkSession) -> None:
        switch.point(spark, self.table, self.fresh)

    def is_live(self, spark: SparkSession) -> bool:
        return switch.target(spark, self.table) == self.fresh

    def undo(self, spark: SparkSession) -> None:
        """Leave names and tables as they were, wherever the steps stopped; may itself be repeated."""
        for name, version in self.adopted:
            if not spark.catalog.tableExists(name) and spark.catalog.tableExists(version):
                switch.rename(spark, version, name)
        for name, was in ((self.table, self.live_was), (self.archive, self.archive_was)):
            now = switch.target(spark, name)
            if now == name:  # still, or again, the plain table that it was
                continue
            if was and now != was:
                switch.point(spark, name, was)
            elif now and not was:
                switch.drop_name(spark, name)
        switch.drop_table(spark, self.fresh)

    def finish(self, spark: SparkSession) -> None:
        """Give up the table that an archive of the same name stood for."""
        if self.archive_was and self.live_was and self.archive_was != self.live_was:
            switch.drop_table(spark, self.archive_was)


def journal_of(spark: SparkSession, table: str, path: str | None = None) -> Journal:
    root = (path or snapshot_root(spark, table)).rstrip("/")
    return Journal(spark, f"{root}/{table.rpartition('.')[2]}_publishing.json")


def recover(spark: SparkSession, table: str, path: str | None = None) -> str | None:
    """Clear up after a process that died while publishing: "finished", "undone", or None if there was none.

    If the live name had been switched already, the rest is done; otherwise everything is as before that process.
    """
    journal = journal_of(spark, table, path)
    entry = journal.read()
    if entry is None:
        return None
    left = Publication(**entry)
    done = left.is_live(spark)
    left.finish(spark) if done else left.undo(spark)
    journal.clear()
    return "finished" if done else "undone"


def publish_snapshot(
    df: DataFrame, table: str, period: str, old_period: str | None = None, path: str | None = None
) -> str | None:
    """Make ``df`` the live ``table``; return the name the previous snapshot was archived under, if there was one.

    Names are views over snapshot tables. The new rows are written as a table of their own, so that a failing job leaves
    the live name untouched; then the archive's name is pointed to the snapshot that was live, and the live name to the
    new one, each in one step: a reader finds the live name at any time. What is to be done is in a journal beside the
    snapshots first. A failure undoes exactly what this call did; after a dead process the next call, or
    :func:`recover`, does that. One process at a time may publish to a name.

    Snapshots are external tables in folders of their own below ``path``: nothing is moved, also on an object store. The
    folder of a snapshot that an archive of the same name replaces is left, since readers may still be using it, to the
    storage's retention rule.
    """
    spark = df.sparkSession
    recover(spark, table, path)
    journal = journal_of(spark, table, path)
    one = Publication.planned(spark, table, period, old_period, (path or snapshot_root(spark, table)).rstrip("/"))
    journal.write(asdict(one))
    try:
        one.write(df)
        one.adopt(spark)
        one.keep_previous(spark)
        one.go_live(spark)
    except Exception:
        one.undo(spark)
        journal.clear()
        raise
    one.finish(spark)
    journal.clear()
    return one.archive if one.live_was else None
