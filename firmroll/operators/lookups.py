"""Code dictionaries: size check, broadcast or balanced shuffle join."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmroll.operators.skew import Hot, hot_keys, salted_left_join

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64


@dataclass(frozen=True)
class Lookup:
    """A dictionary with its measured size.

    ``table`` has the two columns ``code`` and ``description``; codes are trimmed, so joins use them bare.
    """

    table: DataFrame
    unique: bool
    size_bytes: int
    limit_bytes: int | None = None

    @property
    def small(self) -> bool:
        return self.size_bytes <= (BROADCAST_LIMIT_BYTES if self.limit_bytes is None else self.limit_bytes)


def measure_lookups(
    sources: Mapping[str, tuple[DataFrame, str, str]], limit_bytes: int | None = None
) -> dict[str, Lookup]:
    """Measure dictionaries, given as name -> (table, code column, description column), in a single job.

    ``limit_bytes`` is the size up to which they are broadcast, by default ``BROADCAST_LIMIT_BYTES``. Only one row per dictionary comes back to the driver: its size and whether its codes are unique.
    """
    tables = {
        name: df.select(F.trim(F.col(code)).alias("code"), F.col(description).alias("description"))
        for name, (df, code, description) in sources.items()
    }
    width = F.coalesce(F.octet_length("code"), F.lit(0)) + F.coalesce(F.octet_length("description"), F.lit(0))
    sized = [
        table.select(F.lit(name).alias("name"), "code", (width + ROW_OVERHEAD_BYTES).cast("long").alias("size"))
        for name, table in tables.items()
    ]
    measured = (
        reduce(DataFrame.unionByName, sized)
        .groupBy("name", "code")
        .agg(F.count("code").alias("n"), F.sum("size").alias("size"))
        .groupBy("name")
        .agg(F.max("n").alias("most"), F.sum("size").alias("size"))
        .collect()
    )
    found = {row["name"]: row for row in measured}
    return {
        name: Lookup(
            table,
            name not in found or found[name]["most"] <= 1,
            found[name]["size"] if name in found else 0,
            limit_bytes,
        )
        for name, table in tables.items()
    }


def describe(df: DataFrame, lookup: Lookup, code: str, out: str, hot: Hot | None = None) -> DataFrame:
    """Add ``out``, the description of column ``code``; NULL without a match, one row per match if codes repeat.

    A dictionary within the measured limit is broadcast, so the large side does not move. A larger one is joined by
    shuffle, with the codes that many rows share, ``hot``, spread over several tasks. None looks for them in ``df``,
    which runs its plan; give them where ``df`` is more than a scan.
    """
    table = lookup.table.select(F.col("code").alias(code), F.col("description").alias(out))
    if lookup.small:
        return df.join(F.broadcast(table), code, "left")
    return salted_left_join(df, table, code, hot_keys(df, code) if hot is None else hot)


def grouped(lookup: Lookup) -> Lookup:
    """A dictionary with repeated codes as one row per code, with all its descriptions in an array of structs."""
    each = F.collect_list(F.struct("description")).alias("description")
    return replace(lookup, table=lookup.table.groupBy("code").agg(each), unique=True)
