"""Names that are switched in one step: views over versioned tables, and a journal for steps that belong together.

A reader of a name always finds a whole table behind it, the old one or the new one: ``ALTER VIEW`` is a single call to
the catalog, while replacing or renaming tables leaves a moment without one.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

_MARK = "__"
_TARGET = re.compile(r"SELECT \* FROM `([^`]+)`\.`([^`]+)`")


def qualified(spark: SparkSession, name: str) -> str:
    return name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"


def quoted(spark: SparkSession, name: str) -> str:
    return ".".join(f"`{part}`" for part in qualified(spark, name).split("."))


def version_of(name: str, label: str = "") -> str:
    """A fresh table name for what ``name`` shall point to."""
    return f"{name}{_MARK}{label}{uuid.uuid4().hex[:12]}"


def versions(spark: SparkSession, name: str) -> list[str]:
    """All tables named by :func:`version_of` for ``name``."""
    database, table = qualified(spark, name).split(".")
    listed = spark.catalog.listTables(database, f"{table}{_MARK}*")
    return [f"{database}.{t.name}" for t in listed if t.name.startswith((table + _MARK).lower())]


def target(spark: SparkSession, name: str) -> str | None:
    """The table that ``name`` points to; ``name`` itself if it is a table, None if there is no such name."""
    name = qualified(spark, name)
    if not spark.catalog.tableExists(name):
        return None
    if spark.catalog.getTable(name).tableType != "VIEW":
        return name
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(spark, name)}").where("col_name = 'View Text'").first()
    found = _TARGET.fullmatch(described["data_type"])
    if not found:
        raise ValueError(f"{name} is a view of its own and not switched here")
    return ".".join(found.groups())


def point(spark: SparkSession, name: str, table: str) -> None:
    """Let ``name`` stand for ``table`` from now on."""
    verb = "ALTER" if spark.catalog.tableExists(qualified(spark, name)) else "CREATE"
    spark.sql(f"{verb} VIEW {quoted(spark, name)} AS SELECT * FROM {quoted(spark, table)}")


def rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(spark, old)} RENAME TO {quoted(spark, new)}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(spark, name)}")


def drop_name(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {quoted(spark, name)}")


class Journal:
    """A small file on shared storage that says what a process was about to do. It is replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path, self._next = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def write(self, entry: dict) -> None:
        self._files.mkdirs(self._path.getParent())
        out = self._files.create(self._next, True)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        self._files.delete(self._path, False)
        if not self._files.rename(self._next, self._path):
            raise OSError(f"cannot write {self._path}")

    def read(self) -> dict | None:
        if not self._files.exists(self._path):
            return None
        source = self._files.open(self._path)
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def clear(self) -> None:
        self._files.delete(self._path, False)
