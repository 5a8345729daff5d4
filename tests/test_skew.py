"""Balanced joins, lookups and numbering against plain Python, on data with very large groups."""

from collections import Counter, defaultdict

import pytest
from plan_text import explained
from pyspark.sql import functions as F

from firmroll.operators import lookups as lookup_module
from firmroll.operators.lookups import Lookup, describe, measure_lookups
from firmroll.operators.numbering import number_ranged, number_rows, number_sorted
from firmroll.operators.skew import SALT, hot_keys, left_join_all, only_hot, salted, slices, without_hot


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a third under one key, a third without key, the rest spread."""
    rows = [("hot", i) for i in range(1000)] + [(None, i) for i in range(1000, 2000)]
    rows += [(f"k{i % 400}", i) for i in range(2000, 3000)]
    return spark.createDataFrame(rows, "k string, v int").repartition(5).persist()


def counted(df):
    return Counter(tuple(row) for row in df.collect())


def left_join(left, right):
    """Plain nested left join of (key, value) rows with (key, value) rows."""
    matches = defaultdict(list)
    for key, value in right:
        if key is not None:
            matches[key].append(value)
    return Counter((key, value, other) for key, value in left for other in matches.get(key, [None]))


def test_hot_keys_are_exact(spark, skewed):
    fair = -(-slices(skewed) // 3)
    assert hot_keys(skewed, "k", 0.3) == {"hot": fair, None: fair}
    assert hot_keys(skewed, "k") == {"hot": fair, None: fair}
    assert hot_keys(skewed, "k", 0.5) == {}
    assert hot_keys(skewed.where("k <> 'hot'"), "k", 0.004) == {}
    assert hot_keys(skewed.where("k is null"), "k", 0.5) == {None: slices(skewed)}
    assert hot_keys(skewed.where("v < 0"), "k", 0.5) == {}


def test_hot_keys_shuffle_summaries_and_candidates_only(spark, monkeypatch):
    """No shuffle on the keys of all rows: the first plan merges summaries, the second one counts a few listed keys."""
    plans = []
    kind = type(spark.range(1))
    for name in ("collect", "first"):
        real = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda df, real=real: plans.append(explained(df)) or real(df))
    hot_keys(spark.range(1000).selectExpr("cast(if(id % 2 = 0, 0, id) as string) as k"), "k", 0.3)
    summaries, counts = [p for p in plans if "approx" in p.lower()], [p for p in plans if "approx" not in p.lower()]
    assert summaries and counts
    assert all("hashpartitioning(part" in p and "hashpartitioning(key" not in p for p in summaries)
    assert all("partial_count" in p and "Filter" in p and "SinglePartition" not in p for p in counts)


def test_hot_keys_among_very_many(spark):
    """Every key just above the limit is found among a long tail, over many tasks."""
    parts = slices(spark.range(1))
    rows = spark.range(0, 400_000, 1, 12).selectExpr("if(id % 100 < 60, concat('hot', id % 4), concat('k', id)) as k")
    assert hot_keys(rows, "k", 0.1) == {f"hot{i}": min(parts, max(2, -(-15 * parts // 100))) for i in range(4)}
    assert hot_keys(rows.where("k not like 'hot%'"), "k") == {}


def test_copies_of_one_row_spread_over_all_slices(spark):
    copies = spark.range(0, 4000, 1, 4).selectExpr("'hot' as k", "1 as v")
    assert copies.select(F.lit(1)).count() == 4000
    per_slice = salted(copies, "k", ["hot"], scan=True).groupBy(SALT).count().collect()
    assert len(per_slice) == slices(copies) and max(r["count"] for r in per_slice) < 4000 / slices(copies) * 1.5
    right = spark.createDataFrame([("hot", 7)], "k string, w int")
    joined = left_join_all(copies, [right], "k", ["hot"], scan=True)
    assert joined.where("w = 7").count() == 4000


def test_salting_spreads_a_key_over_all_slices(spark, skewed):
    parts = slices(skewed)
    per_slice = salted(skewed.where("k = 'hot'"), "k", ["hot"]).groupBy(SALT).count().collect()
    assert len(per_slice) == parts and max(row["count"] for row in per_slice) < 1000 / parts * 1.5


def test_split_by_keys_loses_and_repeats_no_row(skewed):
    for hot in ([], [None], ["hot"], ["hot", None], ["absent"], ["absent", None]):
        both = only_hot(skewed, "k", hot).unionByName(without_hot(skewed, "k", hot))
        assert counted(both) == counted(skewed)
        assert only_hot(skewed, "k", hot).count() == 1000 * sum(k in (None, "hot") for k in hot)


@pytest.mark.parametrize("hot", [None, [], [None], ["hot", None], ["hot"], ["absent"], {"hot": 3, None: 2}])
def test_left_join_with_and_without_salt(spark, skewed, hot):
    right = [("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("k2", 5), ("other", 6), (None, 7)]
    other = spark.createDataFrame(right, "k string, w int")
    left = [tuple(row) for row in skewed.collect()]
    assert counted(left_join_all(skewed, [other], "k", hot).select("k", "v", "w")) == left_join(left, right)


def test_left_join_finds_a_key_with_a_third_of_all_rows(spark):
    left = spark.range(45_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 5000)) as k", "id as v")
    right = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, w int")
    found = left_join_all(left, [right], "k")
    assert SALT in explained(found)
    assert found.groupBy("w").count().orderBy("w").collect() == left_join_all(left, [right], "k", []).groupBy(
        "w"
    ).count().orderBy("w").collect()
    assert found.where("w = 1").count() == 15_000 and found.count() == 45_000


def test_chain_of_joins_multiplies_matches(spark, skewed):
    a = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3)], "k string, a int")
    b = spark.createDataFrame([("hot", 1), ("hot", 2), ("k2", 3)], "k string, b int")
    salted_chain = left_join_all(skewed, [a, b], "k", ["hot"])
    assert counted(salted_chain) == counted(left_join_all(skewed, [a, b], "k", []))
    assert salted_chain.where("k = 'hot'").count() == 4000


def test_measured_lookups(spark):
    def lookup(*rows):
        return spark.createDataFrame(rows, "c string, d string"), "c", "d"

    found = measure_lookups(
        {
            "unique": lookup((" a", "x"), ("b", None), (None, "n"), (None, "m")),
            "repeated": lookup(("a", "x"), ("a ", "y")),
            "empty": (spark.createDataFrame([], "c string, d string"), "c", "d"),
        }
    )
    assert {name: found[name].unique for name in found} == {"unique": True, "repeated": False, "empty": True}
    assert found["unique"].size_bytes == 4 * lookup_module.ROW_OVERHEAD_BYTES + 5
    assert found["empty"].size_bytes == 0 and found["empty"].small


def test_large_lookup_takes_the_balanced_join(spark, skewed):
    table = spark.createDataFrame([("hot", "H"), ("k1", "1"), ("k1", "2")], "code string, description string")
    small = Lookup(table, False, 100)
    large = Lookup(table, False, lookup_module.BROADCAST_LIMIT_BYTES + 1)
    by_broadcast = describe(skewed, small, "k", "d")
    by_shuffle = describe(skewed, large, "k", "d", hot=["hot", None])
    for hot in (None, [], [None], {"hot": 4}):
        assert counted(describe(skewed, large, "k", "d", hot).select("k", "v", "d")) == counted(
            by_broadcast.select("k", "v", "d")
        )
    assert counted(by_shuffle.select("k", "v", "d")) == counted(by_broadcast.select("k", "v", "d"))
    assert SALT in explained(by_shuffle) and SALT not in explained(by_broadcast)


def brute_numbers(rows):
    """(key, value) rows -> numbers per key in value order."""
    groups = defaultdict(list)
    for key, value in rows:
        groups[key].append(value)
    return Counter((key, value, i) for key, values in groups.items() for i, value in enumerate(sorted(values), 1))


@pytest.fixture
def tiny_partitions(spark):
    """Keep small shuffles apart, as they are on large data."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.usefixtures("tiny_partitions")
def test_number_sorted(spark, skewed):
    for frame in (skewed, skewed.coalesce(1), skewed.where("k = 'hot'")):
        expected = brute_numbers([tuple(row) for row in frame.collect()])
        assert counted(number_sorted(frame, ["k"], ["v"], "n").select("k", "v", "n")) == expected


@pytest.mark.usefixtures("tiny_partitions")
def test_large_group_spans_partitions(spark, skewed):
    """The point of numbering by ranges: no task holds the whole group."""
    plain = skewed.where("k = 'hot'").repartitionByRange("k", "v")
    assert plain.select(F.spark_partition_id()).distinct().count() > 4


@pytest.mark.usefixtures("tiny_partitions")
def test_copies_of_one_row_spread_and_get_all_numbers(spark):
    copies = spark.range(0, 4000, 1, 4).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    numbered = number_sorted(copies, ["k"], ["v"], "n", spread_copies=True)
    assert sorted(row["n"] for row in numbered.collect()) == list(range(1, 4001))


@pytest.mark.usefixtures("tiny_partitions")
@pytest.mark.parametrize("hot", [None, [], [None], ["hot"], ["hot", None]])
def test_number_rows(spark, skewed, hot):
    rows = [tuple(row) for row in skewed.collect()]
    assert counted(number_rows(skewed, "k", ["v"], "n", hot).select("k", "v", "n")) == brute_numbers(rows)


@pytest.mark.usefixtures("tiny_partitions")
def test_as_many_groups_as_rows(spark):
    """No broadcast grows with the groups: offsets are fewer than ranges, or are joined as Spark sees fit."""
    frame = spark.range(0, 3000, 1, 4).selectExpr("cast(if(id % 3 = 0, -1, id) as int) as k", "id as v")
    expected = brute_numbers([tuple(row) for row in frame.collect()])
    assert counted(number_ranged(frame, frame, ["k"], ["v"], "n").select("k", "v", "n")) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sorted_ = number_sorted(frame, ["k"], ["v"], "n")
        assert "BroadcastExchange" not in explained(sorted_)
        assert counted(sorted_.select("k", "v", "n")) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_input(spark, skewed):
    nothing = skewed.where("v < 0")
    assert number_rows(nothing, "k", ["v"], "n").count() == 0
    assert number_sorted(nothing, ["k"], ["v"], "n").count() == 0
    assert left_join_all(nothing, [skewed.withColumnRenamed("v", "w")], "k").count() == 0
