import re
import zlib
from collections import Counter

import pytest

from firmroll.llm.url_filter import UrlFilter, allowed_pages, judge_urls, vocabulary


def test_query(same_as_sql):
    same_as_sql("op9_url_filter")


CASES = [
    (None, ("", "", None, "allow")),
    ("", ("", "", None, "allow")),
    ("no scheme.com/", ("", "", None, "allow")),
    ("http://COM/x", ("com", "/x", "com/", "allow")),
    ("http://a.com", ("a.com", "", None, "allow")),
    ("http://xcom/", ("xcom", "/", None, "allow")),
    ("http://x.example.com/en/1?q#f", ("x.example.com", "/en/1", "example.com/en/", "block")),
    ("http://m.www.example.com/en/", ("m.www.example.com", "/en/", "www.example.com/en/", "allow")),
    ("http://a.net/fr/", ("a.net", "/fr/", "net/fr/", "block")),
    ("http://a.net/fr?x", ("a.net", "/fr", None, "allow")),
    ("http://a.org?x://b.com/", ("a.org", "", None, "allow")),
    ("http://a.org/porn", ("a.org", "/porn", None, "block")),
    ("http://a.org/pornography", ("a.org", "/pornography", None, "allow")),
    ("http://a.org/PORN-1", ("a.org", "/PORN-1", None, "block")),
    ("http://a.org/bet", ("a.org", "/bet", None, "allow")),
    ("http://a.org/bet/bet", ("a.org", "/bet/bet", None, "allow")),
    ("http://a.org/bet?poker", ("a.org", "/bet", None, "block")),
    ("http://a.com/porn", ("a.com", "/porn", "com/", "allow")),
    ("http://a.org/" + "x/" * 100_000 + "porn", ("a.org", "/" + "x/" * 100_000 + "porn", None, "block")),
]


def test_cases(spark):
    pages = spark.createDataFrame([(i, url, "old") for i, (url, _) in enumerate(CASES)], "page_id long, url string, judged string")
    found = {r.page_id: r.judged for r in judge_urls(pages).collect()}
    for i, (_, expected) in enumerate(CASES):
        got = found[i]
        assert (got.host, got.path, got.rule, got.verdict) == expected


def test_repeated_rows_empty_table_and_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.org/porn", "x"), (2, None, "y"), (2, None, "y")], "page_id long, url string, judged string")
    assert sorted(allowed_pages(pages).collect()) == [(2, None, "y"), (2, None, "y")]
    assert judge_urls(pages.limit(0)).count() == 0


@pytest.mark.parametrize("settings", [UrlFilter(strict=(), soft=()), UrlFilter(rules=())])
def test_empty_lists(spark, settings):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert judge_urls(pages, settings=settings).first().judged.verdict == "allow"


def plain(url, strict, weights, needed):
    """Terms found by cutting the lower-cased url at everything but ASCII letters and digits: single-word terms only."""
    words = set(re.split("[^a-z0-9]", re.sub("[A-Z]", lambda m: m[0].lower(), url or "")))
    soft = words & set(weights) - strict
    return len(words & strict) > 0 or (len(soft) >= 2 and sum(weights[w] for w in soft) >= needed)


def test_vocabulary_from_a_table_over_all_pages(spark, sf_dir):
    """The words of all urls but the commonest as terms, weights 0 to 4, and 5,000 terms that no url has."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    urls = {r.page_id: r.url for r in pages.collect()}
    seen = Counter(w for url in urls.values() for w in set(re.split("[^a-z0-9]", (url or "").lower())) - {""})
    terms = [(w.upper(), "strict" if zlib.crc32(w.encode()) % 50 == 0 else "soft", zlib.crc32(w.encode()) % 5) for w, n in seen.items() if n < 200]
    terms += [(f"nowhere{i}", "soft", 1) for i in range(5000)]
    table = spark.createDataFrame(terms, "term string, kind string, weight int")
    settings = vocabulary(table, soft_needed=5, rules=())
    strict = {w.lower() for w, kind, _ in terms if kind == "strict"}
    weights = {w.lower(): n for w, kind, n in terms if kind == "soft"}
    assert len(settings.strict) == len(strict) and len(settings.soft) == len(weights) and len(terms) > 5000
    found = {r.page_id: r.judged.verdict for r in judge_urls(pages, settings=settings).collect()}
    assert found == {i: "block" if plain(url, strict, weights, 5) else "allow" for i, url in urls.items()}
    assert set(found.values()) == {"allow", "block"}


def test_vocabulary_rows(spark):
    rows = [("Bet", "soft", 2), ("bet", "soft", None), ("x", "soft", 1), ("X", "strict", None), (None, "soft", 1), ("", "strict", 1), ("y", None, 3), ("loan", "soft", None)]
    table = spark.createDataFrame(rows, "term string, kind string, weight int")
    settings = vocabulary(table)
    assert (settings.strict, settings.soft, settings.soft_weights()) == (("x",), ("bet", "loan"), {"bet": 2, "loan": 1})
    with pytest.raises(ValueError):
        vocabulary(table, max_terms=2)
    assert vocabulary(table.limit(0)).soft == ()
    pages = spark.createDataFrame([(1, "http://a.org/bet"), (2, "http://a.org/bet/loan"), (3, "http://a.org/x")], "page_id long, url string")
    verdicts = {r.page_id: r.judged.verdict for r in judge_urls(pages, settings=settings).collect()}
    assert verdicts == {1: "allow", 2: "block", 3: "block"}
