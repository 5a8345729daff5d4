"""Packing token sequences into windows by best-fit decreasing.

Method: documents of more than a window are first cut into full windows; what remains of each goes, longest first,
into the tightest open window it fits. Lengths are whole numbers up to the window, so all pieces of a length are
placed together: the plan is made from the number of pieces per length alone, at most one row per length, whatever the
corpus. Open windows are kept in a segment tree indexed by remaining capacity, each leaf holding ranges of windows that
are filled alike. A placement says that the pieces of a length from one rank to another go to consecutive windows at
one offset. The result is the one of best-fit decreasing over all pieces, exactly.

Ranks need no sort: a piece is numbered within its task and length while it is cut, and the tasks' counts are summed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmroll.llm.bpe import VOCABULARY, codec
from firmroll.llm.common import stored, text_or_empty

WINDOW = 1024
END_ID = 0
_SLICE = 20_000


class OpenWindows:
    """Segment tree over remaining capacities; a leaf holds ranges (first window, number of windows)."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.counts = [0] * (2 * self.size)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, number: int) -> None:
        node = capacity + self.size
        while node:
            self.counts[node] += number
            node >>= 1

    def put(self, capacity: int, first: int, number: int) -> None:
        if number:
            self.ranges[capacity].append((first, number))
            self._add(capacity, number)

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        first, number = self.ranges[capacity].pop()
        taken = min(number, most)
        if taken < number:
            self.ranges[capacity].append((first + taken, number - taken))
        self._add(capacity, -taken)
        return first, taken

    def tightest(self, length: int) -> int | None:
        """The least capacity of at least ``length`` that some open window has."""
        node = length + self.size
        if self.counts[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.counts[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.counts[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


@dataclass
class Plan:
    """Placements as columns, ordered by length and first rank."""

    window: int
    rows: list[tuple[int, int, int, int]] = field(default_factory=list)  # length, first rank, first window, offset
    windows: int = 0

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        length, rank, first, offset = np.array(sorted(self.rows) or np.zeros((0, 4)), np.int64).T
        return length, rank, first, offset


def best_fit_decreasing(counts: Mapping[int, int], window: int = WINDOW) -> Plan:
    """Place ``counts[length]`` pieces of each length from 1 to ``window``."""
    plan, free = Plan(window), OpenWindows(window)
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = free.tightest(length)
            if capacity is not None:
                first, taken = free.take(capacity, left)
                plan.rows.append((length, rank, first, window - capacity))
                free.put(capacity - length, first, taken)
                rank, left = rank + taken, left - taken
                continue
            # Nothing fits: every new window takes pieces of this length until it is full, the last one the rest.
            each = window // length
            full, rest = divmod(left, each)
            for layer in range(each):
                number = full + (rest > layer)
                if number:
                    plan.rows.append((length, rank, plan.windows, layer * length))
                    rank += number
            free.put(window - each * length, plan.windows, full)
            free.put(window - rest * length, plan.windows + full, int(rest > 0))
            plan.windows += full + (rest > 0)
            left = 0
    return plan


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Encode, cut, and number the pieces of each length within the task."""
    task, one = TaskContext.get().partitionId(), codec(vocabulary)
    seen = [0] * (window + 1)
    columns: list[list] = [[] for _ in range(6)]

    def batch() -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"]
        arrays = [pa.array(c, pa.int64()) for c in columns]
        out = pa.RecordBatch.from_arrays([*arrays, pa.array([task] * len(columns[0]), pa.int64())], [*names, "task"])
        for c in columns:
            c.clear()
        return out

    for rows in batches:
        for row in range(rows.num_rows):  # one text at a time: a batch may hold many megabytes
            doc_id, text = rows.column(0)[row].as_py(), rows.column(1)[row].as_py()
            ids = np.array([*one.encode_tree(text), end_id], "<u4")
            for start in range(0, len(ids), window):
                piece = ids[start : start + window]
                length = len(piece)
                for c, v in zip(columns, (doc_id, start, length, zlib.crc32(piece), len(ids), seen[length]), strict=True):
                    c.append(v)
                seen[length] += 1
            if len(columns[0]) >= _SLICE:
                yield batch()
    if columns[0]:
        yield batch()


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each text is encoded whole and followed by ``end_id``; a null text counts as empty and is that id alone. Repeated
    rows are packed each. An empty table gives an empty result; other columns are ignored. Sequences are filled from
    offset 0 without gaps; all but the last few are nearly full.
    """
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long, task long"
    pieces = stored(texts.mapInArrow(lambda batches: _pieces(batches, vocabulary, window, end_id), schema), "pieces")
    counts = stored(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "counts")
    # At most one row per length.
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    length, first_rank, first_window, offset = best_fit_decreasing({r["length"]: r["n"] for r in totals}, window).arrays()
    order = length << 48 | first_rank

    @F.pandas_udf("sequence_id long, offset long")
    def placed(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(order, lengths.to_numpy() << 48 | ranks.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": first_window[at] + ranks.to_numpy() - first_rank[at], "offset": offset[at]})

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # The counts grow with the tasks and compress well, so their file size says little: no broadcast.
    ranked = pieces.join(before.hint("merge"), ["length", "task"])
    found = ranked.withColumn("p", placed(F.col("length"), F.col("before") + F.col("place")))
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "p.sequence_id", "p.offset")
