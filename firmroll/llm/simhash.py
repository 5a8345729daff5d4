"""Near duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

Method: a fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits. Two fingerprints that differ in at most
two bits agree in one whole segment (pigeonhole), and differ in at most two bits of the segment after it. That second
segment, padded to 23 bits, is decoded with the perfect binary Golay code: its keys are the indices of all codewords
within distance 4, one or six of them. Vectors at distance 2 or less always share such an index: they have a vector
between them at distance 1 or less from both, and that vector's codeword is at distance 3 or less from it. So a key is
(segment number, segment, index of the next one), 16 of them per fingerprint on average, and fingerprints that share a
key are compared.

Only distinct fingerprints are keyed. Buckets of up to ``BUCKET`` fingerprints are compared within one row. The
members of larger ones are linked exactly and without pairs: each is listed under itself and its 64 neighbours at one
bit; any two fingerprints at distance 2 or less meet at a neighbour, and all that meet are at distance 2 or less, so
each place links its members to the least one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmroll.llm.common import row_key, rows_that_stay, stored, text_or_empty
from firmroll.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 2
BUCKET = 32
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (shift, bits)
GOLAY_BITS, GOLAY_CHECK = 23, 11
GOLAY_POLYNOMIAL = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
_CHUNK = 1 << 16


def shingle_hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of the lower-cased words' shingles, repeated ones included, in chunks; a shorter text is one shingle."""
    words = text.encode().lower().split()  # bytes: ASCII letters and blanks only
    if not words:
        return
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), _CHUNK):
        places = zip(starts[i : i + _CHUNK].tolist(), ends[i : i + _CHUNK].tolist(), strict=True)
        yield np.array([digest(joined[a:b], SEED) for a, b in places], ">u8")


def fingerprint(text: str) -> int:
    """SimHash of the lower-cased words' shingles, as an unsigned number; 0 without words."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, SHINGLE):
        n += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


@cache
def _errors_by_syndrome() -> np.ndarray:
    """Syndrome -> the error patterns that lead to a codeword within distance 4: one and five more, or none (-1)."""
    found: list[list[int]] = [[] for _ in range(1 << GOLAY_CHECK)]
    for weight in range(5):
        for places in combinations(range(GOLAY_BITS), weight):
            error = sum(1 << p for p in places)
            found[int(_syndromes(np.array([error]))[0])].append(error)
    table = np.full((len(found), 6), -1, np.int64)
    for i, errors in enumerate(found):
        table[i, : len(errors)] = errors
    return table


def _syndromes(vectors: np.ndarray) -> np.ndarray:
    rest = vectors.astype(np.int64)
    for bit in range(GOLAY_BITS - 1, GOLAY_CHECK - 1, -1):
        rest ^= ((rest >> bit) & 1) * (GOLAY_POLYNOMIAL << (bit - GOLAY_CHECK))
    return rest


def golay_indices(vectors: np.ndarray) -> np.ndarray:
    """Indices of the codewords within distance 4 of each 23-bit vector, six columns, -1 where there are fewer."""
    errors = _errors_by_syndrome()[_syndromes(vectors)]
    return np.where(errors < 0, -1, (vectors[:, None] ^ errors) >> GOLAY_CHECK)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) of all keys of unsigned fingerprints."""
    parts = [((prints >> np.uint64(s)) & np.uint64((1 << b) - 1)).astype(np.int64) for s, b in SEGMENTS]
    rows, keys = [], []
    for i, exact in enumerate(parts):
        indices = golay_indices(parts[(i + 1) % len(parts)])
        row, column = np.nonzero(indices >= 0)
        rows.append(row)
        keys.append(((i << 22 | exact[row]) << 12) | indices[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints = batch["print"].to_numpy()
        row, key = keys_of(prints.view(np.uint64))
        yield pd.DataFrame({"key": key, "print": prints[row]})


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    for batch in batches:
        prints = batch["print"].to_numpy()
        places = (prints.view(np.uint64)[:, None] ^ flips[None, :]).view(np.int64)
        yield pd.DataFrame({"place": places.ravel(), "print": np.repeat(prints, len(flips))})


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Distinct fingerprints (column ``print``, signed) -> links (u, v) whose components are those of all close pairs."""
    keyed = stored(prints.mapInPandas(_keyed, "key long, print long"), "keys")
    sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    small = keyed.join(sizes.where(F.col("n") <= bucket), "key").groupBy("key").agg(F.collect_list("print").alias("p"))
    close = F.expr(
        f"flatten(transform(p, a -> transform(filter(p, b -> b < a and bit_count(a ^ b) <= {DISTANCE}),"
        " b -> struct(a as u, b as v))))"
    )
    pairs = small.select(F.explode(close).alias("e")).select("e.u", "e.v")

    crowded = keyed.join(sizes.where(F.col("n") > bucket), "key").select("print").distinct()
    places = stored(crowded.mapInPandas(_neighbours, "place long, print long"), "places")
    least = stored(
        places.groupBy("place").agg(F.min("print").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1"), "least"
    )
    stars = places.join(least, "place").where("print != v").select(F.col("print").alias("u"), "v")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Every row with its component: doc_id, row_key, fingerprint, component_id, keep_id, keep_key.

    ``component_id`` is the smallest doc_id that can be reached over links, the row's own included; null ones are
    passed over. ``keep_id`` and ``keep_key`` name the row of a component that stays, one with that doc_id. Null texts,
    empty texts and texts of blanks have fingerprint 0 and are linked like any other. An empty table gives an empty
    result; other columns count only for ``row_key``.
    """

    @F.pandas_udf("long")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(x) for x in texts], np.uint64).view(np.int64))

    rows = stored(
        docs.select(F.col("doc_id").cast("long"), row_key(docs).alias("row_key"), signed(text_or_empty()).alias("print")),
        "fingerprints",
    )
    prints = stored(rows.groupBy("print").agg(_best().alias("best")), "prints")
    roots = stored(components(links(prints.select("print"), bucket)), "roots")
    return _with_components(rows, prints, roots).select(
        "doc_id", "row_key", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id", "keep_id", "keep_key",
    )


def _best() -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_key"))


def _with_components(rows: DataFrame, prints: DataFrame, roots: DataFrame) -> DataFrame:
    """rows (doc_id, row_key, print), prints (print, best), roots (node, root) -> rows with their component's names."""
    joined = prints.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "best", F.coalesce("root", "print").alias("root")
    )
    groups = stored(joined.groupBy("root").agg(F.min("best").alias("keep")), "groups")
    kept = stored(joined.join(groups, "root").select("print", "keep"), "kept")
    return rows.join(kept, "print").select(
        "doc_id", "row_key", "print", F.col("keep.doc_id").alias("component_id"),
        F.col("keep.doc_id").alias("keep_id"), F.col("keep.row_key").alias("keep_key"),
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row per component of :func:`near_duplicates`, with its own columns; nulls, empties and ties as there.

    Of rows that are equal in all columns one stays. Texts of any length pass; an empty table stays empty.
    """
    kept = near_duplicates(docs).select(F.col("keep_id").alias("doc_id"), F.col("keep_key").alias("row_key"))
    return rows_that_stay(docs, kept.distinct())
