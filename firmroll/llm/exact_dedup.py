"""Exact deduplication by deterministic block naming.

Method: the text without blanks is cut into blocks of a fixed number of bytes. All blocks of the corpus are sorted and
equal ones get one integer name. Then adjacent names are paired, the pairs are named in the same way, and so on, until
each document has a single name. Names are given by comparing contents, never by a hash, so two documents have the
same last name exactly if their texts are equal.

Blocks are sorted by (hash, owner, place) over partitions and by content within them. The owner breaks ties, so the
copies of one block spread over as many tasks as their number asks for. A block whose copies span partitions has a
name in each; partitions therefore report the blocks of their first and last hash, at most two per partition but for
hash collisions, and those names are unified by content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmroll.llm.common import BLANKS, row_key, rows_that_stay, stored, text_or_empty

BLOCK_BYTES = 4096
_BLANKS = BLANKS.encode()
_ROW = "owner long, doc_id long, row_key long, length long, text_sha256 string"
_SLICE = 8 << 20


def _cut(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """One row per block, with what is known of its document."""
    names = ["owner", "doc_id", "row_key", "length", "text_sha256", "blocks", "place", "block"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        rows, size = [], 0
        for row in range(batch.num_rows):  # one text at a time: a batch may hold many megabytes
            owner, doc_id, key, text = (column[row].as_py() for column in batch.columns)
            normal = text.encode().translate(None, _BLANKS)
            digest = hashlib.sha256(normal).hexdigest()
            count = max(1, -(-len(normal) // block_bytes))
            for place in range(count):
                block = normal[place * block_bytes : (place + 1) * block_bytes]
                rows.append((owner, doc_id, key, len(text), digest, count, place, block))
                size += len(block)
                if size >= _SLICE:
                    yield _batch(rows, names, types)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _name_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal blocks in a sorted partition; report those of its first and last hash."""
    number = (TaskContext.get().partitionId() << 33) - 1
    before = first_hash = last_hash = None
    first: list[tuple[int, bytes]] = []
    last: list[tuple[int, bytes]] = []
    schema = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block, hashes = batch.column("block"), batch.column("hash").to_numpy()
        starts = np.ones(batch.num_rows, bool)
        starts[1:] = pc.not_equal(block.slice(1), block.slice(0, len(block) - 1)).to_numpy(zero_copy_only=False)
        starts[0] = before is None or block[0].as_py() != before
        names = number + np.cumsum(starts)
        number, before = int(names[-1]), block[len(block) - 1].as_py()
        if first_hash is None:
            first_hash = last_hash = int(hashes[0])
        first += [(int(names[i]), block[int(i)].as_py()) for i in np.flatnonzero(starts & (hashes == first_hash))]
        if int(hashes[-1]) != last_hash:
            last_hash, last = int(hashes[-1]), []
        last += [(int(names[i]), block[int(i)].as_py()) for i in np.flatnonzero(starts & (hashes == last_hash))]
        kept = [c for c in batch.schema.names if c not in ("block", "hash")]
        arrays = [batch.column(c) for c in kept] + [pa.array(names), pa.nulls(len(names), pa.binary())]
        out = pa.RecordBatch.from_arrays(arrays, [*kept, "name", "edge"])
        schema = out.schema
        yield out
    if schema is not None:
        edges = first + (last if last_hash != first_hash else [])
        arrays = [pa.nulls(len(edges), field.type) for field in schema][:-2]
        arrays += [pa.array([n for n, _ in edges], pa.int64()), pa.array([b for _, b in edges], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, schema.names)


def name_blocks(blocks: DataFrame) -> DataFrame:
    """Replace column ``block`` by ``name``, equal exactly for equal blocks; ``owner`` and ``place`` tell rows apart."""
    kept = [c for c in blocks.columns if c != "block"]
    dealt = (
        blocks.withColumn("hash", F.xxhash64("block"))
        .repartitionByRange("hash", "owner", "place")
        .sortWithinPartitions("hash", "block")
    )
    types = dict(blocks.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in kept] + ["name long", "edge binary"])
    runs = stored(dealt.mapInArrow(_name_runs, schema), "names")
    edges = runs.where(F.col("edge").isNotNull()).select(
        F.col("name").alias("_own"), F.min("name").over(Window.partitionBy("edge")).alias("_name")
    )
    # At most two names per partition, of which only those of split runs remain.
    split = edges.where("_own != _name")
    named = runs.where(F.col("owner").isNotNull()).join(F.broadcast(split), F.col("name") == F.col("_own"), "left")
    return named.select(*kept, F.coalesce("_name", "name").alias("name"))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: owner, doc_id, row_key, length, text_sha256, and its identity (level, name)."""
    source = docs.select(
        F.monotonically_increasing_id().alias("owner"), F.col("doc_id").cast("long"), row_key(docs).alias("row_key"),
        text_or_empty().alias("text"),
    )
    current = source.mapInArrow(
        lambda batches: _cut(batches, block_bytes), f"{_ROW}, blocks long, place long, block binary"
    )
    carried = ["doc_id", "row_key", "length", "text_sha256"]
    done, level = [], 0
    while True:
        named = stored(name_blocks(current), "level") if level == 0 else name_blocks(current)
        done.append(
            named.where("blocks = 1").select("owner", *carried, F.lit(level).alias("level"), "name")
        )
        rest = named.where("blocks > 1")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, done)
        pairs = rest.groupBy("owner", F.floor(F.col("place") / 2).alias("place")).agg(
            *[F.first(c).alias(c) for c in carried],
            F.first(F.ceil(F.col("blocks") / 2)).alias("blocks"),
            F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("place") % 2 == 1, F.col("name"))).alias("right"),
        )
        both = F.concat_ws(" ", "left", F.coalesce(F.col("right").cast("string"), F.lit("-")))
        current = pairs.select("owner", *carried, "blocks", "place", both.cast("binary").alias("block"))
        level += 1


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row with its group: doc_id, row_key, keep_id, group_size, kept, text_sha256.

    Of equal texts the longest original stays, then the smallest doc_id (a null one last); of rows that tie even there
    exactly one. A null text counts as empty; texts of blanks alone equal the empty one. An empty table gives an empty
    result; other columns count only for ``row_key``.
    """
    rows = stored(identities(docs, block_bytes), "identities")
    best = F.min(F.struct((-F.col("length")).alias("l"), F.col("doc_id").isNull().alias("n"), "doc_id", "owner"))
    groups = stored(
        rows.groupBy("level", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    # Both sides are plain scans: adaptive execution splits an identity that holds a large part of all rows.
    return rows.join(groups, ["level", "name"]).select(
        "doc_id", "row_key", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("owner") == F.col("best.owner")).alias("kept"), "text_sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    return rows_that_stay(docs, exact_duplicates(docs).where("kept"))
