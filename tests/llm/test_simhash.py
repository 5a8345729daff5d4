import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from firmroll.llm import simhash
from firmroll.llm.components import components


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(doc_id, fingerprint, component) by comparing all pairs."""
    prints = [(d, plain_fingerprint(t or "")) for d, t in rows]
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((-1 if d is None else d, f"{p:016x}", least.get(root(i))) for i, (d, p) in enumerate(prints))


def found(docs, **how):
    rows = simhash.near_duplicates(docs, **how).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, r.component_id) for r in rows)


def test_whole_table_against_brute_force(spark, sf_dir):
    from firmroll.llm import registry

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = registry.queries()["op3_simhash"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


@settings(deadline=None)
@given(st.text())
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@settings(deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=2))
def test_close_fingerprints_share_a_key(a, bits):
    b = a
    for bit in bits:
        b ^= 1 << bit
    row, key = simhash.keys_of(np.array([a, b], np.uint64))
    assert set(key[row == 0]) & set(key[row == 1])


@pytest.mark.parametrize("bucket", [0, 3, 32])
def test_planted_groups(documents, bucket):
    """Chains and dense groups, with buckets of every kind: bucket 0 takes the exact way for all."""
    rng = random.Random(1)
    base = [" ".join(f"w{rng.randrange(4000)}" for _ in range(150)) for _ in range(20)]
    rows = []
    for i in range(260):
        words = rng.choice(base).split()
        words[rng.randrange(150)] = f"v{rng.randrange(9)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(i, base[0]) for i in range(2000, 2030)]
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "one"), (None, "one"), (3004, "one TWO"), (3005, "One two")]
    assert found(documents(rows), bucket=bucket) == brute(rows)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    label = {n: n for e in edges for n in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(label.get(n) == r for n, r in got.items())
    assert {n for e in edges if e[0] != e[1] for n in e} <= got.keys()


def test_stage_columns_and_empty_table(spark):
    rows = [(1, "a b c d", "x", 1), (2, "a b c d", "y", 1), (2, "a b c d", "y", 1), (None, "q r s", "z", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print string, root int")
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted([(1, "a b c d", "x", 1), (None, "q r s", "z", 2)], key=str)
    assert simhash.without_near_copies(docs.limit(0)).count() == 0
