"""Vector code compression: product codes whose nearest entries are found in a GNAT over each part's entries.

Method: components become integers, vectors are cut into equal parts, and each part position has a codebook that a few
rounds of "assign, then average" improve. The nearest entry is searched in a geometric near-neighbour access tree: a
node has split points, every other entry below it belongs to its nearest split point, and for each pair of split points
the node stores the range of distances from the one to the points of the other. A query measures its distance to the
split points; by the triangle inequality a child whose range is further than the best distance so far is left out as a
whole. Ranges and distances are square roots rounded outwards to integers, and a child goes only if its bound is
strictly larger than the best distance, so no nearest entry and no tie is ever lost; the entry itself is decided by
exact integer distances, ties to the lower index. Each query first descends below its nearest split point.

Vectors never move: every round is one pass in which each task sums its parts per entry, so only ``parts x entries``
small sums per task are shuffled and that many entries come to the driver, whatever the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmroll.llm.common import small_batches, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Integers beyond this count as it, so that squared distances of up to 8,192 components fit 64 bits.
LARGEST = 1 << 24
FANOUT, LEAF = 8, 10


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, points x centres."""
    total = np.zeros((len(points), len(centres)), np.int64)
    for i in range(points.shape[1]):
        step = points[:, i, None] - centres[None, :, i]
        total += step * step
    return total


def _root_below(squares: np.ndarray) -> np.ndarray:
    """Largest integers whose squares are not above the given ones."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def _root_above(squares: np.ndarray) -> np.ndarray:
    root = _root_below(squares)
    return root + (root * root < squares)


@dataclass
class Gnat:
    """One node: entry numbers, the points of its splits (or of all its entries, if a leaf), children, ranges."""

    numbers: np.ndarray
    points: np.ndarray
    children: list[Gnat | None]
    nearest: np.ndarray
    furthest: np.ndarray

    @staticmethod
    def build(points: np.ndarray, numbers: np.ndarray | None = None, fanout: int = FANOUT, leaf: int = LEAF) -> Gnat:
        numbers = np.arange(len(points)) if numbers is None else numbers
        if len(numbers) <= max(leaf, fanout):
            return Gnat(numbers, points[numbers], [], *np.zeros((2, 0, 0), np.int64))
        own = points[numbers]
        chosen = [0]
        apart = _squares(own, own[:1])[:, 0]
        while len(chosen) < fanout and apart.max():
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, _squares(own, own[chosen[-1:]])[:, 0])
        if len(chosen) == 1:  # all entries are equal: no split tells them apart
            return Gnat(numbers, own, [], *np.zeros((2, 0, 0), np.int64))
        squares = _squares(own, own[chosen])
        home = squares.argmin(axis=1)
        home[chosen] = -1
        children: list[Gnat | None] = []
        nearest, furthest = np.zeros((2, len(chosen), len(chosen)), np.int64)
        for j in range(len(chosen)):
            members = np.flatnonzero(home == j)
            children.append(Gnat.build(points, numbers[members], fanout, leaf) if len(members) else None)
            if len(members):
                nearest[:, j] = _root_below(squares[members].min(axis=0))
                furthest[:, j] = _root_above(squares[members].max(axis=0))
        return Gnat(numbers[chosen], own[chosen], children, nearest, furthest)

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of each query's nearest entry, the squared distance to it, and how many distances were measured."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        which = np.full(len(queries), np.iinfo(np.int64).max)
        return which, best, self._visit(queries, np.arange(len(queries)), best, which)

    def _visit(self, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, which: np.ndarray) -> int:
        squares = _squares(queries[rows], self.points)
        low = squares.min(axis=1)
        number = np.where(squares == low[:, None], self.numbers, np.iinfo(np.int64).max).min(axis=1)
        better = (low < best[rows]) | ((low == best[rows]) & (number < which[rows]))
        best[rows[better]], which[rows[better]] = low[better], number[better]
        measured = squares.size
        if not self.children:
            return measured
        home = squares.argmin(axis=1)
        below, above = _root_below(squares), _root_above(squares)
        for own in (True, False):  # first the child of the nearest split point, then what that leaves possible
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                some = np.flatnonzero((home == j) == own)
                gap = np.maximum(self.nearest[:, j] - above[some], below[some] - self.furthest[:, j]).max(axis=1)
                some = some[(gap <= 0) | (gap * gap <= best[rows[some]])]
                if len(some):
                    measured += child._visit(queries, rows[some], best, which)
        return measured


def integers(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, rounded components) of those lists of doubles that have ``width`` finite components."""
    fits = pc.equal(pc.list_value_length(column), width).fill_null(False).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(fits)
    values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = values.reshape(len(rows), width)
    finite = np.isfinite(values).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(SCALE * values[finite]), -LARGEST, LARGEST)
    return rows[finite], scaled.astype(np.int64)


def _cut(values: np.ndarray, parts: int) -> np.ndarray:
    """vectors x components -> parts x vectors x components of a part."""
    return np.ascontiguousarray(values.reshape(len(values), parts, -1).transpose(1, 0, 2))


def _kept(vectors: DataFrame) -> DataFrame:
    """Rows whose vector may count; lengths are left to the caller."""
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec").isNotNull() & fine)


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Parts of the ``entries`` smallest kept ids (parts x entries x width); None if no vector can be cut.

    The vector with the smallest id of those that can be cut tells the length of all.
    """
    rows = _kept(vectors).where((F.size("vec") > 0) & (F.size("vec") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), F.col("vec")]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return None
    width = len(first[0]["vec"])
    few = rows.where(F.size("vec") == width).orderBy(*order).limit(entries).collect()  # bounded by ``entries``
    _, values = integers(pa.array([r["vec"] for r in few], pa.list_(pa.float64())), width)
    return _cut(values, parts)


def improved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: assign every part to its nearest entry, then replace each used entry by the rounded-down mean."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat.build(book) for book in books]
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            _, values = integers(batch.column("vec"), parts * width)
            for part, points in enumerate(_cut(values, parts)):
                which, _, _ = trees[part].search(points)
                np.add.at(total[part], which, points)
                count[part] += np.bincount(which, minlength=entries)
        part, entry = np.nonzero(count)
        columns = [part, entry, count[part, entry]]
        arrays = [pa.array(c.astype(np.int64)) for c in columns] + [pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "n", "total"])

    found = vectors.select("vec").mapInArrow(sums, "part long, entry long, n long, total array<long>")
    each = found.select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
    means = each.groupBy("part", "entry", "at").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")
    )
    out = books.copy()
    with small_batches(vectors.sparkSession):
        rows = means.collect()  # at most one row per component of the codebooks
    for r in rows:
        out[r["part"], r["entry"], r["at"]] = int(r["x"]) // r["n"]
    return out


def _encoder(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    parts, _, width = books.shape

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat.build(book) for book in books]
        for batch in batches:
            rows, values = integers(batch.column("vec"), parts * width)
            codes, error = np.zeros((len(rows), parts), np.int64), np.zeros(len(rows), np.int64)
            for part, points in enumerate(_cut(values, parts)):
                codes[:, part], squares, _ = trees[part].search(points)
                error += squares
            listed = ["".join(f"{c:02x}" for c in code) for code in codes.tolist()]
            kept = [batch.column(c).take(pa.array(rows)) for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(listed, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"]
            )

    return encode


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per vector that can be coded: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold a null or non-finite component are dropped, and so are those whose length differs from
    the one of the smallest id, since they cannot be cut alike. Components beyond ``LARGEST / SCALE`` count as that. Ids
    may repeat (each row is coded; ties among the first ids go to the lesser vector) or be null (last). Null labels are
    one label. Fewer vectors than ``entries`` give smaller codebooks; an empty table gives an empty result. Other columns
    are ignored. ``entries`` may be 256 at most, for two digits each.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits per part")
    vectors = table.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vec"),
    )
    books = first_codebooks(vectors, parts, entries)
    kind = dict(vectors.dtypes)["label"]
    if books is None:
        none = vectors.where(F.lit(False)).select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none.select("*", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    for _ in range(rounds):
        books = improved(vectors, books)
    coded = stored(vectors.mapInArrow(_encoder(books), f"vec_id long, label {kind}, code string, error long"), "codes")
    # Summed per task before the shuffle; both sides of the join are plain scans, so that a hot label is split.
    most = F.lit(int(np.iinfo(np.int64).max))
    by_label = coded.groupBy("label").agg(F.coalesce(F.try_sum("error"), most).alias("label_error"))
    sums = stored(by_label.select(F.col("label").alias("same"), "label_error"), "label-errors")
    rows = coded.join(sums, F.col("label").eqNullSafe(F.col("same")))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
