import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from firmroll.llm import search
from firmroll.llm.k2_treap import K2Treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, key string, rank int"


def test_query(same_as_sql):
    rows = same_as_sql("op12_ranked_search")
    assert sum(rows.values()) == 40 * 50


@settings(deadline=None, max_examples=100)
@given(st.integers(0, 10**6))
def test_treap_against_a_dense_grid(seed):
    rng = np.random.default_rng(seed)
    grid = (rng.random((rng.integers(1, 30), rng.integers(1, 90))) < rng.random()) * rng.integers(1, 5)
    rows, columns = np.nonzero(grid)
    treap = K2Treap(rows, columns, grid[rows, columns])
    asked = rng.permutation(len(grid))[: rng.integers(1, len(grid) + 1)]
    weight, wanted, least = rng.integers(0, 4, len(asked)), int(rng.integers(1, 9)), int(rng.integers(1, 4))
    scores = weight @ grid[asked]
    best = [(int(c), int(scores[c])) for c in np.lexsort((np.arange(len(scores)), -scores)) if scores[c] >= least]
    found = treap.best(asked, weight, wanted, least)
    assert list(zip(*(x.tolist() for x in found), strict=True)) == best[:wanted]


def test_treap_opens_few_ranges(monkeypatch):
    """One column far above all others: most of the grid stays closed."""
    opened = []
    whole = K2Treap._open
    monkeypatch.setattr("firmroll.llm.k2_treap._WAVE", 8)
    monkeypatch.setattr(K2Treap, "_open", lambda self, r, w, level, *x: opened.append(len(level)) or whole(self, r, w, level, *x))
    values = np.ones(4096, np.int64)
    values[1234] = 1000
    treap = K2Treap(np.zeros(4096, np.int64), np.arange(4096), values)
    assert [x.tolist() for x in treap.best(np.array([0]), np.array([1]), 1)] == [[1234], [1000]]
    assert sum(opened) < 200


def plain(docs, items, places):
    terms = [TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in docs]
    held = [(d, Counter(t)) for (d, _), t in zip(docs, terms, strict=True) if t]
    n, total = len(held), sum(map(len, terms))
    df = Counter(w for _, c in held for w in c)
    rows = []
    for item, text in items:
        asked = set(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        scored = []
        for d, c in held:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(floor(1000 * log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in asked & c.keys())
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (score, missing, d) in enumerate(sorted(scored)[:places], 1):
            rows.append((item, rank, None if missing else d, -score))
    return Counter(rows)


@pytest.mark.parametrize("item_bytes", [40, 1 << 20])
def test_small_blocks_odd_rows_and_ties(spark, monkeypatch, item_bytes):
    monkeypatch.setattr(search, "BLOCK_DOCUMENTS", 7)
    monkeypatch.setattr(search, "_CHUNK", 16)
    rng = random.Random(3)
    words = ["one", "Two", "three-four", "été", "日本", "x1", "\x7f", "_", "ONE"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(12)))) for i in range(60)]
    docs += [(1, "one two")] * 5 + [(None, "one two"), (None, None), (70, None), (71, ""), (72, "x1 " * 5000)]
    items = [(1, "one été"), (2, "ONE one two, 日本?"), (2, "x1"), (3, None), (4, ""), (None, "three"), (5, "absent"), (1, "one été")]
    table = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, score string").repartition(3)
    asked = spark.createDataFrame([(*r, "k", 0) for r in items], ITEMS)
    found = search.ranked(table, asked, places=6, item_bytes=item_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == plain(docs, items, 6)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.ranked(docs.limit(0), items).count() == 0
    assert search.ranked(docs, items.limit(0)).count() == 0
