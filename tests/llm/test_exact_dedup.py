import random

import pytest

from firmroll.llm import exact_dedup


def brute(rows):
    """doc_id -> (keep_id, group size) by plain comparison; and how many rows stay."""
    groups = {}
    for doc_id, text in rows:
        text = text or ""
        groups.setdefault("".join(text.translate({ord(c): None for c in " \t\n\x0b\x0c\r"})), []).append((-len(text), doc_id is None, doc_id or 0, doc_id))
    return sorted(
        ((m[3], min(g)[3], len(g)) for g in groups.values() for m in g), key=lambda r: (r[0] is None, r)
    ), len(groups)


def check(docs, rows, block_bytes):
    found = exact_dedup.exact_duplicates(docs, block_bytes).collect()
    expected, kept = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=lambda r: (r[0] is None, r)) == expected
    assert sum(r.kept for r in found) == kept


def test_query(same_as_sql):
    same_as_sql("op5_exact_dedup")


@pytest.mark.parametrize("block_bytes", [4, 4096])
def test_against_brute_force(documents, block_bytes):
    rng = random.Random(block_bytes)
    rows = [(i, "".join(rng.choice("ab \n") for _ in range(rng.choice([0, 1, 3, 4, 5, 9, 14])))) for i in range(400)]
    rows += [(1000 + i, "ab ab ab ab ab") for i in range(200)]
    rows += [(5000, None), (5001, ""), (5002, " \t\r\n"), (None, "ab"), (None, "a b"), (7, "ab"), (7, "ab")]
    check(documents(rows), rows, block_bytes)


def test_copies_over_many_partitions(spark, documents):
    """Runs of one block span partitions and still get one name."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, "same text in many rows") for i in range(300)] + [(300 + i, f"text {i}") for i in range(30)]
        check(documents(rows), rows, 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_text_columns_and_empty_table(spark):
    long = "x" * 300_000
    rows = [(1, long + "a", 1, "u", None), (2, long + "b", 2, "u", None), (3, " " + long + "a", 3, "u", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int, block string, name string")
    found = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs).collect()}
    assert (found[1].keep_id, found[2].keep_id, found[3].keep_id) == (3, 2, 3)
    assert sorted(r.doc_id for r in exact_dedup.without_copies(docs).collect()) == [2, 3]
    assert exact_dedup.without_copies(docs).columns == docs.columns
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0
    assert exact_dedup.without_copies(docs.unionByName(docs)).count() == 2


def test_place_of_a_null_counts(spark):
    from firmroll.llm.common import row_key, rows_that_stay

    rows = [(1, "x", None), (1, None, "x"), (None, "x", None), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(rows_that_stay(docs, docs.withColumn("row_key", row_key(docs))).collect(), key=str) == sorted(rows, key=str)
