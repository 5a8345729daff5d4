"""Ranked lexical search of many items over all documents, by K2-treaps over blocks of the term-document grid.

One pass over the texts counts the terms that any item asks for: a narrow row per document, in the document's own
partition. From those rows come the statistics (documents, terms, documents per term), and then, without a shuffle, the
grids: every task cuts its documents into blocks, builds a K2-treap over (term, document) whose cells store impact
maxima, and lets each item's rows descend jointly, best first over document ranges (:mod:`firmroll.llm.k2_treap`). The
worst score that an item still needs passes from block to block of a task. Each task hands on at most ``places``
documents per item, which are merged in two steps, so that no task reads the hits of all others.

Items are handled in blocks of about ``ITEM_BYTES`` of distinct text, whose terms go to all tasks: more items mean more
passes, not a larger broadcast. The terms of a single item have to fit.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmroll.llm.common import stored
from firmroll.llm.k2_treap import K2Treap

PLACES = 50
ITEM_BYTES = 4 << 20
BLOCK_DOCUMENTS, BLOCK_POSTINGS = 16384, 4_000_000
# Fixed values of the score.
SCALE, TF_STEP, LENGTH_STEP, LENGTH_SHARE = 1_000_000_000, 1000, 20, 50
# In UTF-8 and after lower-casing A-Z: all but ASCII signs; bytes of other characters are above ASCII.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_CHUNK = 1 << 20
_SLOTS = 64
_POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text in lists of a bounded size; a term is never cut."""
    text = text.lower()
    at = 0
    while at < len(text):
        end = min(at + _CHUNK, len(text))
        if end < len(text):
            rest = _TERM.match(text, end)
            end = rest.end() if rest else end
        yield _TERM.findall(text, at, end)
        at = end


def weights(documents: int, frequencies: dict[int, int]) -> dict[int, int]:
    """Term number -> weight, for terms that some document holds."""
    return {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for t, df in frequencies.items() if df}


def impacts(counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term adds to a document's score per unit of weight; whole numbers, rounded down."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * documents) // total
    return (SCALE * counts) // (TF_STEP * counts + LENGTH_STEP * m)


def _count(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    number = vocabulary.get
    for batch in batches:
        ids, lengths, terms, counts = [], [], [], []
        for row in range(batch.num_rows):  # one text at a time: a batch may hold many megabytes
            n, seen = 0, Counter()
            for words in terms_of(batch.column("text")[row].as_py()):
                n += len(words)
                seen.update(map(number, words))
            if n:
                seen.pop(None, None)
                ids.append(batch.column("doc_id")[row].as_py())
                lengths.append(n)
                terms.append(list(seen.keys()))
                counts.append(list(seen.values()))
        small = pa.list_(pa.int32())
        arrays = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, small), pa.array(counts, small)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "counts"])


class _Best:
    """The best documents of every item so far. A null doc_id comes after all others."""

    def __init__(self, items: int, places: int) -> None:
        self.places = places
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(items)]

    def least(self, item: int) -> int:
        scores = self.found[item][0]
        return int(scores[-1]) if len(scores) == self.places else 1

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        merged = [np.concatenate(x) for x in zip(self.found[item], (scores, ids, missing), strict=True)]
        top = np.lexsort((merged[1], merged[2], -merged[0]))[: self.places]
        self.found[item] = tuple(x[top] for x in merged)


def _search_block(
    batches: list[pa.RecordBatch], items: list[np.ndarray], weight: np.ndarray, documents: int, total: int, best: _Best
) -> None:
    block = pa.Table.from_batches(batches).combine_chunks()
    missing = block["doc_id"].is_null().to_numpy()
    ids = block["doc_id"].fill_null(0).to_numpy()
    order = np.lexsort((ids, missing))  # columns of the grid stand in the order that breaks ties
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    terms = block["terms"].combine_chunks()
    sizes = np.diff(terms.offsets.to_numpy())
    rows, counts = (block[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "counts"))
    values = impacts(counts, np.repeat(block["n"].to_numpy(), sizes), documents, total)
    columns = np.repeat(column, sizes)
    some = (values > 0) & (weight[rows] > 0)
    treap = K2Treap(rows[some], columns[some], values[some])
    ids, missing = ids[order], missing[order]
    for i, wanted in enumerate(items):
        at, scores = treap.best(wanted, weight[wanted], best.places, best.least(i))
        best.add(i, scores, ids[at], missing[at])


def _hits(
    postings: DataFrame, items: list[np.ndarray], weight: np.ndarray, documents: int, total: int, places: int
) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, block, rows, size = _Best(len(items), places), [], 0, 0
        for batch in batches:
            block.append(batch)
            rows, size = rows + batch.num_rows, size + len(batch.column("terms").flatten())
            if rows >= BLOCK_DOCUMENTS or size >= BLOCK_POSTINGS:
                _search_block(block, items, weight, documents, total, best)
                block, rows, size = [], 0, 0
        if rows:
            _search_block(block, items, weight, documents, total, best)
        for i, (scores, ids, missing) in enumerate(best.found):
            if len(scores):
                arrays = [pa.array(np.full(len(scores), i)), pa.array(ids, mask=missing), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return postings.mapInArrow(search, "item long, doc_id long, score long")


def _first(hits: DataFrame, by: list[Column], places: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= places)


def _ranked_block(docs: DataFrame, texts: list[tuple[str, bytes]], places: int) -> DataFrame:
    """docs (doc_id, text as binary), texts (key, text) -> key, rank, doc_id, score."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    items = []
    for _, text in texts:
        own = {vocabulary.setdefault(w, len(vocabulary)) for words in terms_of(text) for w in words}
        items.append(np.array(sorted(own), np.int64))
    postings = stored(docs.mapInArrow(lambda batches: _count(batches, vocabulary), _POSTINGS), "postings")
    documents, total = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most one row per term of these items.
    holders = postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
    weight = np.zeros(len(vocabulary) + 1, np.int64)
    for term, w in weights(documents, {r["t"]: r["df"] for r in holders}).items():
        weight[term] = w
    items = [own[weight[own] > 0] for own in items]
    hits = stored(_hits(postings, items, weight, documents, total, places), "hits")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(_SLOTS))
    merged = _first(_first(hits, [F.col("item"), slot], places).drop("rank"), [F.col("item")], places)
    keys = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(texts)], "item long, key string")
    return stored(merged.join(keys, "item").select("key", "rank", "doc_id", "score"), "ranked")


def ranked(docs: DataFrame, items: DataFrame, places: int = PLACES, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``places`` best documents of every item: item_id, rank, doc_id, score.

    A null or empty text has no terms: as a document it is found by no item and does not count, as an item it has no
    rows. Every row of ``docs`` and ``items`` counts, repeated ones too. Equal scores rank by ascending doc_id, null
    ones last. Texts of any length are read whole, in chunks. Empty tables give an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    asked = stored(
        items.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).select(
            "item_id", F.sha2(F.col("text").cast("binary"), 256).alias("key"), F.col("text").cast("binary").alias("text")
        ),
        "items",
    )
    texts = stored(asked.select("key", "text").dropDuplicates(["key"]), "item-texts")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // item_bytes))
    source = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    found = []
    for block in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).collect()  # some ``item_bytes``
        if rows:
            found.append(_ranked_block(source, [(r["key"], bytes(r["text"])) for r in rows], places))
    if not found:
        found = [spark.createDataFrame([], "key string, rank int, doc_id long, score long")]
    best = reduce(DataFrame.unionByName, found)
    return best.join(asked.select("item_id", "key"), "key").select("item_id", "rank", "doc_id", "score")
