"""Tables on shared storage: scratch results, staging tables, snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmroll.sources import switch
from firmroll.sources.schemas import TARGET_COLUMNS

CHECKPOINT_SETTING = "spark.checkpoint.dir"
MOST_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"
_named: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: the one ``spark.checkpoint.dir`` names, else the current database's.

    A database's tables lie on shared storage too, so a session that names no folder still writes nothing to the own
    disk of a machine. The session is left as it is.
    """
    named = own = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri
    if not named:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    if not own and named.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{named} may lie on each machine's own disk; set {CHECKPOINT_SETTING} to a shared folder")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`; :func:`clear_scratch` or the folder's own retention rule clears it."""
    _named.append(f"{shared_dir(spark)}/firmroll/{label}-{uuid.uuid4().hex}")
    return _named[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything that :func:`scratch_path` has named in this process; results that still read it are lost."""
    while _named:
        path = spark._jvm.org.apache.hadoop.fs.Path(_named.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a result to shared storage and read it back: cuts lineage and survives the loss of executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staging_name(feed: str, period: str, database: str | None = None) -> str:
    """``<feed>_<yyyymm>``, with the database if one is given."""
    name = f"{feed.lower()}_{period.replace('-', '')}"
    return f"{database}.{name}" if database else name


def write_staging(df: DataFrame, table: str, buckets: int, key: str = "cnpj_basico", path: str | None = None) -> None:
    """Replace a staging table, bucketed and sorted by ``key`` so that joins on it need no shuffle.

    Rows travel once, hashed as the buckets are, so each task writes one bucket. A bucket that outgrows the advisory
    partition size, as one with a very large company does, is split over several tasks by adaptive execution, which
    add files to the same bucket.

    Every load writes a table of its own, below ``path`` if that is given, and ``table`` is a name that is then switched
    to it in one step: until a load has succeeded, readers have the one before, and a failing load changes nothing. The
    table that a load replaces is kept for those who are still reading it; the next load drops it.
    """
    spark = df.sparkSession
    limit = int(spark.conf.get(MOST_BUCKETS))
    if buckets > limit:
        raise ValueError(f"{buckets} buckets are above {MOST_BUCKETS} = {limit}")
    table = switch.qualified(spark, table)
    fresh = switch.version_of(table)
    placed = df.hint("rebalance", buckets, F.col(key))
    writer = placed.write.mode("errorifexists").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", f"{path.rstrip('/')}/{fresh.rpartition('.')[2]}")
    before = switch.target(spark, table)
    try:
        writer.saveAsTable(fresh)
        if before == table:  # a plain table takes a versioned name, once
            before = switch.version_of(table)
            switch.rename(spark, table, before)
        switch.point(spark, table, fresh)
    except Exception:
        if before and not spark.catalog.tableExists(table):
            switch.rename(spark, before, table)
        switch.drop_table(spark, fresh)
        raise
    for old in switch.versions(spark, table):
        if old not in (before, fresh):
            switch.drop_table(spark, old)


def read_snapshot(spark: SparkSession, table: str) -> DataFrame:
    """A published table in its contract order; the partition column is stored last."""
    return spark.table(table).select(TARGET_COLUMNS)
