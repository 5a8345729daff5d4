"""Row numbers per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmroll.operators.skew import Hot, hot_keys, only_hot, slices, without_hot
from firmroll.sources.storage import materialise

POSITION = "_position"
COPY = "_copy"
PARTITION_BITS = 33
RANGE = "_range"
SAMPLE = 50


def number_sorted(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, spread_copies: bool = False
) -> DataFrame:
    """Number the rows of each group 1..n in ``order``; a group may span any number of tasks.

    Rows are range-partitioned and sorted by (group, order) and stored with their position. Then each (partition,
    group) needs a single offset: how many rows of the group lie in earlier partitions. Groups are contiguous, so
    there are fewer offsets than partitions plus groups; they are stored, and Spark broadcasts them if they are small.

    Rows that tie in ``order`` stay in one task. ``spread_copies`` breaks ties by the position in ``df``, so that
    even full copies of one row spread; it needs a ``df`` that is a plain scan, where positions are repeatable.
    """
    keys = [*group, *order]
    placed = df
    if spread_copies:
        placed = df.withColumn(COPY, F.monotonically_increasing_id())
        keys.append(COPY)
    placed = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*df.columns)
    stored = materialise(placed.withColumn(POSITION, F.monotonically_increasing_id()), "numbering")

    partition = F.shiftright(POSITION, PARTITION_BITS)
    blocks = stored.groupBy(partition.alias("_partition"), *group).agg(
        F.min(POSITION).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.partitionBy(*group).orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("_partition"),
        *[F.col(name).alias(f"_group_{i}") for i, name in enumerate(group)],
        (F.col("_first") - F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).alias("_offset"),
    )
    offsets = materialise(offsets, "offsets")
    same_block = [partition == F.col("_partition")] + [
        F.col(name).eqNullSafe(F.col(f"_group_{i}")) for i, name in enumerate(group)
    ]
    return stored.join(offsets, same_block, "inner").select(
        *df.columns, (F.col(POSITION) - F.col("_offset") + 1).alias(out)
    )


def range_bounds(keys: DataFrame, order: Sequence[str], parts: int) -> list[tuple]:
    """Up to ``parts - 1`` bounds that cut ``keys`` into even ranges of ``order``, from a narrow scan.

    They are quantiles of those distinct keys whose hash falls in the sample: some ``SAMPLE`` per range come to the
    driver, whatever the input, and the same ones in every run.
    """
    every = max(1, keys.count() // (parts * SAMPLE))
    chosen = keys.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0).dropna().distinct()
    sample = sorted(tuple(row) for row in chosen.collect())
    if not sample:
        return []
    return sorted({sample[i * len(sample) // parts] for i in range(1, parts)})


def range_number(order: Sequence[str], bounds: Sequence[tuple]) -> Column:
    """How many bounds are at most the row's key, by binary search; NULL keys come first."""
    if not bounds:
        return F.lit(0)
    edges = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(order, b, strict=True)]) for b in bounds])
    key = F.struct(*[F.col(name) for name in order])

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        below = F.get(edges, middle) <= key
        open_ = state["low"] < state["high"]
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~below, middle).otherwise(state["high"]).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    return F.aggregate(steps, start, halve, lambda state: state["low"])


def number_ranged(
    df: DataFrame, keys: DataFrame, group: Sequence[str], order: Sequence[str], out: str, first: Sequence[str] = ()
) -> DataFrame:
    """Number the rows of few groups 1..n in ``order`` while they move once; a group may span any number of tasks.

    Ranges of (group, order) are cut by bounds from ``keys``, a narrow scan with those columns. Counting the rows per
    range and group reads only what those columns need. Then the rows move to their range, are sorted there, and get
    the number within it plus the rows of the group in earlier ranges. Ranges and groups follow each other, so at most
    the first group of a range has rows in earlier ones: there are fewer such offsets than ranges, however many the
    groups, and only those are broadcast. ``first`` names columns that are functions
    of the group and shall lead the sort, such as the one a table is partitioned by.
    """
    parts = slices(df)
    by = [*group, *order]
    ranged = df.withColumn(RANGE, range_number(by, range_bounds(keys, by, parts)))
    counts = ranged.groupBy(RANGE, *group).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(RANGE).alias("_at"),
        *[F.col(name).alias(f"_group_{i}") for i, name in enumerate(group)],
        F.sum("_rows").over(earlier).alias("_offset"),
    ).where("_offset is not null")
    within = Window.partitionBy(*first, *group, RANGE).orderBy(*order)
    placed = ranged.repartitionById(parts, F.col(RANGE)).withColumn("_within", F.row_number().over(within))
    same = [F.col(RANGE) == F.col("_at")] + [
        F.col(name).eqNullSafe(F.col(f"_group_{i}")) for i, name in enumerate(group)
    ]
    return placed.join(F.broadcast(offsets), same, "left").select(
        *df.columns, (F.col("_within") + F.coalesce("_offset", F.lit(0))).cast("long").alias(out)
    )


def number_rows(df: DataFrame, key: str, order: Sequence[str], out: str, hot: Hot | None = None) -> DataFrame:
    """``row_number`` per ``key`` for many keys: a window for most, :func:`number_sorted` for the hot ones.

    ``df`` should be a plain scan, such as a staging table.
    """
    hot = hot_keys(df, key) if hot is None else hot
    window = Window.partitionBy(key).orderBy(*order)
    numbered = F.row_number().over(window).cast("long").alias(out)
    if not hot:
        return df.select("*", numbered)
    large = number_sorted(only_hot(df, key, hot), [key], order, out, spread_copies=True)
    return without_hot(df, key, hot).select("*", numbered).unionByName(large)
