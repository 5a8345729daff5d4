"""Keys that hold a large share of all rows, and joins that stay balanced in their presence."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
TRACKED, MOST_TRACKED, MOST_LISTED = 16, 1_000_000, 5000

# Hot keys with the number of slices each is cut into, or just the keys.
Hot = Mapping[str | None, int] | Sequence[str | None]


def slices(df: DataFrame) -> int:
    """The most slices a hot key is cut into: as many as a shuffle has partitions."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def candidates(df: DataFrame, key: str, most: int) -> tuple[int, list[str], bool]:
    """Rows of ``df``, keys that may hold more than a ``1/most`` of them, and whether the missing key may.

    From one column, by mergeable frequent-item summaries: one per task, merged in groups of tasks and then together, so
    only summaries are shuffled, never the keys. They track ``TRACKED`` items per item looked for, which overestimates a
    count by less than a quarter of the limit, so no key above it is missed and fewer than twice ``most`` are listed.
    """
    tracked = min(MOST_TRACKED, TRACKED * most)
    # A letter before known keys tells the missing one from all others.
    marked = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n"))
    parts = (
        df.select(marked.alias("key"), F.pmod(F.spark_partition_id(), F.lit(slices(df))).alias("part"))
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(key, {tracked})").alias("summary"))
    )
    merged = parts.groupBy(F.lit(1)).agg(
        F.sum("rows").alias("rows"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary, {tracked}), {2 * most})").alias("top"),
    ).first()
    if merged is None:
        return 0, [], False
    listed = {r["item"] for r in merged["top"] if r["count"] * most > merged["rows"]}
    return merged["rows"], sorted(item[1:] for item in listed - {"n"}), "n" in listed


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> dict[str | None, int]:
    """Keys, NULL included, that hold more than ``share`` of all rows, by default a fair task's; key -> slices.

    The few :func:`candidates` are counted exactly, with map-side combining, and those above the limit come to the driver,
    fewer than ``1/share`` of them. A key gets as many slices as it has fair shares.
    """
    parts = slices(df)
    share = 1 / parts if share is None else share
    total, listed, missing = candidates(df, key, min(MOST_LISTED, math.ceil(1 / share)))
    if not listed and not missing:
        return {}
    chosen = only_hot(df, key, [*listed, *([None] if missing else [])])
    counted = chosen.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    found = counted.where(F.col("n") > total * share).collect()
    return {r["key"]: min(parts, max(2, math.ceil(r["n"] * parts / total))) for r in found}


def _slices_by_key(df: DataFrame, hot: Hot) -> dict[str | None, int]:
    return dict(hot) if isinstance(hot, Mapping) else dict.fromkeys(hot, slices(df))


def _known(hot: Hot) -> list[str]:
    return [value for value in hot if value is not None]


def only_hot(df: DataFrame, key: str, hot: Hot) -> DataFrame:
    """Rows with a hot key; a plain condition that reaches the scan."""
    known = _known(hot)
    listed = F.col(key).isin(known) if known else F.lit(False)
    return df.where(listed | F.col(key).isNull() if None in hot else listed)


def without_hot(df: DataFrame, key: str, hot: Hot) -> DataFrame:
    """All other rows; in sorted files, blocks that hold nothing but one hot key are skipped.

    The condition on known keys is NULL for a missing key; that row is kept or left out by a condition of its own.
    """
    known = _known(hot)
    others = ~F.col(key).isin(known) if known else F.col(key).isNotNull()
    return df.where(others if None in hot else others | F.col(key).isNull())


def parts_of(key: str, hot: Mapping[str | None, int]) -> Column:
    """Number of slices of a row's key, 1 if it is not hot."""
    known = {value: parts for value, parts in hot.items() if value is not None}
    parts = F.lit(1)
    if known:
        table = F.create_map(*[F.lit(x) for x in chain.from_iterable(known.items())])
        parts = F.coalesce(table[F.col(key)], F.lit(1))
    return F.when(F.col(key).isNull(), F.lit(hot.get(None, 1))).otherwise(parts)


def salted(df: DataFrame, key: str, hot: Hot, scan: bool = False) -> DataFrame:
    """Give every row a slice of its key, so that a task that runs again places every row as before.

    That holds for the content of a row, and in a plain ``scan`` for its position too, which spreads even full copies of
    one row.
    """
    parts = parts_of(key, _slices_by_key(df, hot))
    place = F.monotonically_increasing_id() if scan else F.xxhash64(*df.columns)
    return df.withColumn(SALT, F.pmod(place, parts).cast("int"))


def repeated(df: DataFrame, key: str, hot: Mapping[str | None, int]) -> DataFrame:
    """The other side of a salted join: rows of a hot key once per slice of it, all others once."""
    return df.withColumn(SALT, F.explode(F.sequence(F.lit(0), parts_of(key, hot) - 1)))


def salted_left_join(left: DataFrame, right: DataFrame, key: str, hot: Hot) -> DataFrame:
    """One left join in which hot keys are spread. Both sides are read once, whatever the number of hot keys."""
    parts = _slices_by_key(left, hot)
    if not parts:
        return left.join(right, key, "left")
    return salted(left, key, parts).join(repeated(right, key, parts), [key, SALT], "left").drop(SALT)


def left_join_all(
    left: DataFrame, rights: Sequence[DataFrame], key: str, hot: Hot | None = None, scan: bool = False
) -> DataFrame:
    """Left-join every table of ``rights`` on ``key``; duplicate keys on the right fan out.

    All joins share one partitioning, so each side is shuffled at most once, and not at all where it is bucketed by
    ``key``. Rows of ``hot`` keys take a way of their own: they are salted and meet those few rows of the right sides
    that have a hot key, a filter that reaches the scans; all other rows keep their plan. None looks for hot keys in
    ``left``. The branch reads ``left`` a second time, so give it a plain scan; ``scan`` says that it is one, and spreads
    full copies of a row too.
    """
    hot = hot_keys(left, key) if hot is None else hot
    if not hot:
        return _chain(left, rights, [key])
    parts = _slices_by_key(left, hot)
    # A missing key matches nothing, so the right sides need only the known ones.
    few = [repeated(only_hot(right, key, _known(hot)), key, parts) for right in rights]
    spread = _chain(salted(only_hot(left, key, hot), key, parts, scan), few, [key, SALT]).drop(SALT)
    return _chain(without_hot(left, key, hot), rights, [key]).unionByName(spread)


def _chain(left: DataFrame, rights: Sequence[DataFrame], on: list[str]) -> DataFrame:
    for right in rights:
        left = left.join(right, on, "left")
    return left
