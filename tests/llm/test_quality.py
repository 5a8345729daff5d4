import random

import pytest

from firmroll.llm import quality


def test_query(same_as_sql):
    rows = same_as_sql("op10_quality_rules")
    assert sum(rows.values()) == 1000


def test_clean_documents_stay_and_junk_goes(spark, sf_dir):
    """Labels are not used by the rules; they only judge them here."""
    verdicts = quality.quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = verdicts.join(labels, "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.985 * len(clean)
    assert sum(junk) <= 0.05 * len(junk)


def brute_repeats(words):
    spans = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, span in enumerate(spans):
        if spans.count(span) > 1:
            hit.update(range(i, i + 5))
    return len(hit)


@pytest.mark.parametrize("seed", range(20))
def test_repeated_words(seed):
    rng = random.Random(seed)
    words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(0, 60))]
    assert quality.repeated_words(words) == brute_repeats(words)


def test_repeated_words_of_many_kinds():
    """More different words than five names of them fit in 64 bits, and a long text in little time."""
    words = [b"%d" % i for i in range(20_000)]
    assert quality.repeated_words(words) == 0
    assert quality.repeated_words([*words, *words[100:104]]) == 0
    assert quality.repeated_words([*words, *words[100:105]]) == 10
    assert quality.repeated_words([*words, b"x", *words]) == 40_000
    assert quality.repeated_words([b"a"] * 2_000_000) == 2_000_000


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    schema = "doc_id long, text string, lang string, source string, n_chars long, m string, kept string, limit_lang int"
    rows = [
        (1, None, "en", "a", 0, "x", "y", 1),
        (2, "", None, None, 0, "x", "y", 1),
        (None, long, "en", "a", 1, "x", "y", 1),
        (4, "one\ntwo\none\n \none", "en", "a", 1, "x", "y", 1),
        (4, "one\ntwo\none\n \none", "en", "a", 1, "x", "y", 1),
        (5, "a b " * 10, "en", "a", 1, "x", "y", 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    found = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert (found[1].n_words, found[1].base_failed, found[1].kept) == (0, True, False)
    assert found[2].kept is False
    assert found[None].n_words == 200_000 and found[None].base_failed is False
    assert (found[4].n_words, found[4].n_dup_lines) == (4, 2)
    assert found[5].n_repeat_words == 20 and found[5].base_failed
    assert quality.quality_rules(docs).count() == len(rows)
    good = quality.good_documents(docs)
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} <= {None}
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_sketches_merge(spark, documents):
    docs = quality.measured(documents([(i, "word " * (i + 1)) for i in range(50)]))
    whole = quality.sketches(docs)
    halves = quality.sketches(docs.where("doc_id < 20")).union(quality.sketches(docs.where("doc_id >= 20")))
    both = quality.merged(halves, "lang", "source")
    assert sorted(whole.select(both.columns).collect()) == sorted(both.collect())
