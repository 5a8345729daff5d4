import hashlib
from collections import Counter, defaultdict
from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from firmroll.llm import vector_codes
from firmroll.llm.vector_codes import Gnat

SCHEMA = "vec_id long, embedding array<float>, label int, code string, part int"


def test_query(same_as_sql):
    rows = same_as_sql("op13_vector_codes")
    assert sum(rows.values()) == 500


@settings(deadline=None, max_examples=150)
@given(st.integers(0, 10**6))
def test_tree_against_all_distances(seed):
    rng = np.random.default_rng(seed)
    span = int(rng.choice([2, 5, 300]))
    points = rng.integers(-span, span, (rng.integers(1, 90), rng.integers(1, 6)))
    queries = rng.integers(-span - 2, span + 2, (70, points.shape[1]))
    tree = Gnat.build(points, fanout=int(rng.integers(2, 9)), leaf=int(rng.integers(1, 9)))
    squares = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
    which, best, _ = tree.search(queries)
    assert (which == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()


def test_tree_leaves_subtrees_out(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").toPandas()
    parts = vector_codes._cut(np.floor(256 * np.stack(table["embedding"]).astype(float)).astype(np.int64), 16)
    measured = sum(Gnat.build(p[:64]).search(p)[2] for p in parts)
    assert measured < 0.6 * parts.shape[0] * parts.shape[1] * 64


def plain(rows, parts, entries, rounds):
    length = next((len(r[1]) for r in sorted((r for r in rows if usable(r[1], parts)), key=order)), 0)
    kept = sorted((r for r in rows if usable(r[1], parts) and len(r[1]) == length), key=order)
    width = length // parts
    cut = [[tuple(whole(x) for x in v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, piece):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for c in cut:
            for p, piece in enumerate(c):
                groups[p, nearest(p, piece)[1]].append(piece)
        for (p, i), pieces in groups.items():
            books[p][i] = tuple(sum(x) // len(pieces) for x in zip(*pieces, strict=True))
    final = [[nearest(p, piece) for p, piece in enumerate(c)] for c in cut]
    errors = [sum(d for d, _ in f) for f in final]
    labels = Counter()
    for r, e in zip(kept, errors, strict=True):
        labels[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter(
        (r[0], "".join(f"{i:02x}" for _, i in f), e, labels[r[2]], digest) for r, f, e in zip(kept, final, errors, strict=True)
    )


def order(row):
    return row[0] is None, row[0] or 0, row[1]


def usable(v, parts):
    return bool(v) and len(v) % parts == 0 and all(x is not None and isfinite(x) for x in v)


def whole(x):
    return max(-(1 << 24), min(1 << 24, floor(256 * x)))


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_vectors_ties_and_labels(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) / 8 for x in rng.integers(-9, 9, 8)], [1, 2, None][i % 3]) for i in range(120)]
    rows += [rows[3]] * 40  # copies, and a repeated id
    rows += [(200, None, 1), (201, [], 1), (202, [0.5] * 7, 1), (203, [0.5] * 16, 1), (204, [nan] + [0.5] * 7, 1)]
    rows += [(205, [0.5] * 7 + [inf], 2), (206, [None] + [0.5] * 7, 2), (None, [0.25] * 8, None), (207, [3e38, -3e38] * 4, 2)]
    table = spark.createDataFrame([(*r, "c", 0) for r in rows], SCHEMA).repartition(3)
    found = vector_codes.compress(table, parts=4, entries=10)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, found.collect())) == plain(rows, 4, 10, 2)


def test_few_and_no_vectors(spark):
    rows = [(5, [0.5, -0.1], 1, "", 0), (3, [0.2, 0.3], 1, "", 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = vector_codes.compress(table, parts=2, entries=64)
    assert Counter(map(tuple, found.collect())) == plain([r[:3] for r in rows], 2, 64, 2)
    for none in (table.limit(0), spark.createDataFrame([(1, None, 1, "", 0)], SCHEMA)):
        assert vector_codes.compress(none, parts=2).count() == 0
