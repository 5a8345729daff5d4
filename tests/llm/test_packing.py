import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from firmroll.llm import bpe, packing


def plain_best_fit(lengths, window):
    """Best-fit decreasing piece by piece: the sorted fills."""
    fills = []
    for length in sorted(lengths, reverse=True):
        fit = [i for i, f in enumerate(fills) if f + length <= window]
        if fit:
            fills[max(fit, key=lambda i: fills[i])] += length
        else:
            fills.append(length)
    return sorted(fills)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([7, 16, 50, 1024])
    lengths = [rng.choice([rng.randint(1, window), max(1, window // 3)]) for _ in range(300)]
    plan = packing.best_fit_decreasing(Counter(lengths), window)
    rows = sorted(plan.rows)
    fills, taken = defaultdict(int), []
    ends = {r: (rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == r[0] else Counter(lengths)[r[0]]) for i, r in enumerate(rows)}
    for length, rank, first, offset in rows:
        for k in range(ends[(length, rank, first, offset)] - rank):
            fills[first + k] += length
            taken.append((first + k, offset, length))
    assert sorted(fills.values()) == plain_best_fit(lengths, window)
    assert sorted(length for _, _, length in taken) == sorted(lengths)
    by_window = defaultdict(list)
    for w, offset, length in taken:
        by_window[w].append((offset, length))
    for parts in by_window.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:], strict=False))


def check(rows, docs, window):
    """rows: (doc_id, text). Every id lies in one piece; sequences have no gaps and as many as plain best fit needs."""
    pieces = packing.pack(docs, window=window).collect()
    expected = Counter()
    lengths = []
    for doc_id, text in rows:
        ids = np.array([*bpe.codec().encode(text or ""), 0], "<u4")
        for start in range(0, len(ids), window):
            part = ids[start : start + window]
            lengths.append(len(part))
            expected[(doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == expected
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    fills = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        fills.append(at)
    assert sorted(fills) == plain_best_fit(lengths, window)
    return fills


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fills = check([(r.doc_id, r.text) for r in docs.collect()], docs, 1024)
    assert sum(fills) > 0.97 * 1024 * len(fills)


def test_odd_rows(documents, spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b c"), (3, "word " * 5000), (4, "same text here")] + [(5, "x y z")] * 200
    check(rows, documents(rows).repartition(5), 16)
    docs = spark.createDataFrame([(1, "a", 2, 3)], "doc_id int, text string, task int, length int")
    assert [p.length for p in packing.pack(docs).collect()] == [2]
    assert packing.pack(docs.limit(0)).count() == 0
