"""WARC archives: a deterministic sharded writer, and a reader of what it committed.

Method: records are sorted by (page, payload digest, url digest) over ranges of equal bytes. The ranges are cut where
the running bytes of all rows, taken from a narrow table without payloads, pass multiples of a target, so they depend on
the data alone and no sample decides. Every task writes its records in order, each as a gzip member of its own, and
rolls to the next file at a compressed size. Headers and digests are made anew from the payload. Files are written under
temporary names that no other attempt uses; the rows that a successful task returns list them. Then they are renamed,
and last a manifest is written as a table. Readers follow the manifest only, so a lost executor, a second attempt or a
broken run leaves nothing that is read. The same pages give the same bytes.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the largest page is a response and the others
revisit it: they keep the HTTP headers and leave the payload out. What a record is, is decided on the narrow table; a
decision travels to its range beside the payload, which moves once. Full copies of one row that are more than a range
holds are cut into slices of their own and written from a single payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce
from typing import Any
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmroll.llm.common import stored

REVISIT_BYTES = 1000
ROLL_BYTES = 64 << 20
PARTITION_BYTES = 64 << 20
# The driver holds one cut per range, so there are never more; files are rolled by size whatever a range holds.
MOST_RANGES = 8192
# Bytes of a record besides its payload, and the part of all bytes above which copies of a payload are left out early.
HEAD_BYTES = 600
HEAVY_PART = 1024
# Full copies of a row are cut where they exceed this part of a range, which bounds what a range gets beyond its share.
SLICES = 4
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6d1f1f4e-6a0b-5c55-9f0a-2f2b8d6f6a10")
_PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))
MANIFEST = "name string, temporary string, records long, bytes long, sha256 string"
KEY = ["page_id", "digest", "place"]
_BATCH = 16 << 20


def _field(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def record_id(page_id: int | None, digest: str, url: str | None = None, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, repr((page_id, digest, url, copy)))}>"


def _record(fields: list[tuple[str, Any]], block: bytes) -> bytes:
    """One record as a gzip member; fields without a value are left out."""
    fields = [*fields, ("WARC-Block-Digest", _field(hashlib.sha1(block).hexdigest())), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(head.encode() + block + b"\r\n\r\n") + member.flush()


def page_record(row: dict[str, Any], copy: int) -> bytes:
    """``row``: page_id, url, html (bytes, none for a revisit), size, digest, kind, refers_to, refers_url."""
    revisit = row["kind"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    url, target = (None if u is None else quote(u, safe=_PRINTABLE) for u in (row["url"], row["refers_url"]))
    fields = [
        ("WARC-Type", row["kind"]),
        ("WARC-Record-ID", record_id(row["page_id"], row["digest"], row["url"], copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("Page-ID", row["page_id"]),
        ("WARC-Payload-Digest", _field(row["digest"])),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(row["refers_to"], row["digest"], row["refers_url"]) if revisit else None),
        ("WARC-Refers-To-Target-URI", target if revisit else None),
        ("Refers-To-Page-ID", row["refers_to"] if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _record(fields, http if revisit else http + row["html"])


class _Roll:
    """The files of one task, one after the other."""

    def __init__(self, root: str, part: int, roll_bytes: int) -> None:
        self.system, self.root = fs.FileSystem.from_uri(root)
        self.part, self.roll_bytes, self.number = part, roll_bytes, 0
        self.listed: list[tuple] = []
        self.file = None

    def _open(self) -> None:
        self.name = f"pages-{self.part:05d}-{self.number:05d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
        self.file = self.system.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
        self.sum, self.size, self.records = hashlib.sha256(), 0, 0
        info = b"software: firmroll\r\nformat: WARC File Format 1.1\r\n"
        fields = [
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, self.name)}>"),
            ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"),
        ]
        self._put(_record(fields, info))

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.sum.update(data)
        self.size += len(data)

    def write(self, data: bytes) -> None:
        if self.file is None:
            self._open()
        self._put(data)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.listed.append((self.name, self.temporary, self.records, self.size, self.sum.hexdigest()))
            self.file, self.number = None, self.number + 1


def _write(batches: Iterator[pa.RecordBatch], root: str, roll_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: a group's decision first, then its payloads, or a decision that holds all of a slice."""
    roll = _Roll(root, TaskContext.get().partitionId(), roll_bytes)
    group: dict[str, Any] = {}
    copy = 0
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"]:
                group, copy = row, row["first"]
                rows = row["copies"]
            else:
                rows = 1
            for _ in range(rows):
                record = group | {"html": row["html"]}
                if copy and group["size"] >= REVISIT_BYTES:
                    record |= {"kind": "revisit"}
                roll.write(page_record(record, copy))
                copy += 1
    roll.close()
    names = ["name", "temporary", "records", "bytes", "sha256"]
    columns = zip(*roll.listed, strict=True) if roll.listed else [[]] * 5
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def _rename(batches: Iterator[pd.DataFrame], root: str) -> Iterator[pd.DataFrame]:
    """Move files to their names. A file that another attempt has moved already is left."""
    system, path = fs.FileSystem.from_uri(root)
    for batch in batches:
        for temporary, name in zip(batch["temporary"], batch["name"], strict=True):
            if system.get_file_info(f"{path}/{temporary}").type != fs.FileType.NotFound:
                system.move(f"{path}/{temporary}", f"{path}/{name}")
        yield batch


def _keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html (bytes), size, digest, place (the url's digest: a short key for any url)."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url"), html.alias("html"))
    return rows.select(
        "*",
        F.octet_length("html").cast("long").alias("size"),
        F.sha1("html").alias("digest"),
        F.sha1(F.col("url").cast("binary")).alias("place"),
    )


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in columns])


def classified(rows: DataFrame) -> DataFrame:
    """Groups of equal rows: KEY, url, size, n, kind, refers_to, refers_url, payload_rows. No payload is held or moved.

    ``kind`` is that of the group's first record; further ones of at least ``REVISIT_BYTES`` revisit it, or what it
    revisits. ``payload_rows`` counts the rows with the same payload.
    """
    alike = [F.first("url").alias("url"), F.first("size").alias("size")]
    groups = stored(rows.groupBy(*KEY).agg(*alike, F.count(F.lit(1)).alias("n")), "pages")
    repeated = (
        groups.where(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.sum("n").alias("payload_rows"), F.max(F.struct("page_id", "place", "url")).alias("best"))
        .where("payload_rows > 1")
    )
    again = F.col("best").isNotNull()
    first = F.col("page_id").eqNullSafe(F.col("best.page_id")) & F.col("place").eqNullSafe(F.col("best.place"))
    return groups.join(repeated, "digest", "left").select(
        *KEY, "url", "size", "n",
        F.when(again & ~first, "revisit").otherwise("response").alias("kind"),
        F.when(again, F.col("best.page_id")).alias("refers_to"),
        F.when(again, F.col("best.url")).alias("refers_url"),
        F.coalesce("payload_rows", "n").alias("payload_rows"),
    )


def ranged(groups: DataFrame, parts: int, target: float) -> DataFrame:
    """Add ``part``, from 0: the running ``weight`` in key order over ``target``. Rows of a slice are in order, too.

    Rows are ranged and summed per range first, so no task holds more than a range; the sums, one per shuffle
    partition, come to the driver. The result does not depend on how the rows were ranged.
    """
    order = [F.col(c).asc_nulls_first() for c in [*KEY, "slice"]]
    dealt = groups.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    sums = sorted((r[0], r[1]) for r in dealt.groupBy("range").agg(F.sum("weight")).collect())
    before, top = [], 0
    for number, weight in sums:
        before += [F.lit(number), F.lit(top)]
        top += weight
    start = F.element_at(F.create_map(*before), F.col("range")) if before else F.lit(0)
    earlier = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = F.sum("weight").over(earlier)
    part = F.floor((start + F.coalesce(running, F.lit(0))) / F.lit(float(target)))
    return dealt.withColumn("part", F.least(part, F.lit(parts - 1)).cast("int")).drop("range")


def _sort_key(page_id: int | None, digest: str, place: str | None, number: int = 0) -> tuple:
    return (page_id is not None, page_id or 0, digest, place is not None, place or "", number)


def planned(pages: DataFrame, partition_bytes: int = PARTITION_BYTES) -> tuple[DataFrame, int]:
    """All rows that the writer gets, each with its ``part``, and the number of parts.

    Decisions have a ``kind``; payloads have none. A group with more than a ``SLICES``-th of a part's bytes is cut into
    slices, which need no payload rows: there are fewer such groups than ``SLICES`` times the parts. Payloads of which
    copies hold more than a ``HEAVY_PART``-th of all bytes, fewer than ``HEAVY_PART``, leave the copies' bytes where
    they are read.
    """
    rows = _keyed(pages)
    groups = stored(classified(rows), "records")
    weight = F.col("size") + HEAD_BYTES
    total = groups.agg(F.sum(F.col("n") * weight)).first()[0] or 0
    parts = min(max(1, -(-total // partition_bytes)), MOST_RANGES)
    target = max(1.0, total / parts)

    heavy = groups.where(
        (F.col("size") >= REVISIT_BYTES) & (F.col("payload_rows") > 1)
        & (F.col("payload_rows") * F.col("size") * HEAVY_PART > total) & (F.col("kind") == "response")
    ).select(*KEY)
    hot = groups.where((F.col("n") > 1) & (F.col("n") * weight > target / SLICES))
    hot_keys = stored(hot.select(*KEY), "hot")
    found = rows.join(F.broadcast(hot_keys), _same(rows, hot_keys, KEY), "left_semi")
    single = stored(found.groupBy(*KEY).agg(F.first("html").alias("html")), "hot-payloads")
    heavy = stored(heavy.select("digest", F.struct("page_id", "place").alias("kept")), "heavy")

    # Slices of hot groups; every other group is one decision.
    whole = F.col("size") < REVISIT_BYTES
    each = F.when(whole, weight).otherwise(HEAD_BYTES)
    most = F.greatest(F.lit(1), F.floor(F.lit(target / SLICES) / each)).cast("long")
    cut = hot.withColumn("most", most).select("*", F.explode(F.expr("sequence(0L, (n - 1) div most)")).alias("slice"))
    cut = cut.withColumn("first", F.col("slice") * F.col("most"))
    cut = cut.withColumn("copies", F.least(F.col("most"), F.col("n") - F.col("first")))
    single_payload = F.when(~whole & (F.col("kind") == "response") & (F.col("slice") == 0), F.col("size")).otherwise(0)
    cut = cut.withColumn("weight", F.col("copies") * each + single_payload)
    others = groups.join(F.broadcast(hot_keys), _same(groups, hot_keys, KEY), "left_anti")
    others = others.join(F.broadcast(heavy), "digest", "left")
    early = F.col("kept").isNotNull() & (F.col("kind") == "revisit")
    one = others.select(
        *KEY, "url", "size", "kind", "refers_to", "refers_url", F.lit(0).cast("long").alias("slice"),
        F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("copies"),
        (F.col("n") * F.when(early, HEAD_BYTES).otherwise(weight)).alias("weight"),
    )
    decisions = ranged(one.unionByName(cut.select(one.columns)), parts, target).drop("weight")
    decisions = stored(decisions, "decisions")

    cuts = sorted(
        (_sort_key(r.least.page_id, r.least.digest, r.least.place, r.least.slice), r.part)
        for r in decisions.groupBy("part").agg(F.min(F.struct(*KEY, "slice")).alias("least")).collect()
    )
    keys, numbers = [k for k, _ in cuts], [n for _, n in cuts]

    @F.pandas_udf("int")
    def part_of(known: pd.Series, ids: pd.Series, digests: pd.Series, places: pd.Series) -> pd.Series:
        found = [
            numbers[bisect_right(keys, _sort_key(i if k else None, d, p)) - 1]
            for k, i, d, p in zip(known.tolist(), ids.tolist(), digests, places, strict=True)
        ]
        return pd.Series(found, dtype="int32")

    # Payloads: not those of hot groups, and no bytes for copies of heavy ones.
    bare = rows.join(F.broadcast(hot_keys), _same(rows, hot_keys, KEY), "left_anti")
    bare = bare.join(F.broadcast(heavy), "digest", "left")
    own = F.col("page_id").eqNullSafe(F.col("kept.page_id")) & F.col("place").eqNullSafe(F.col("kept.place"))
    payloads = bare.select(
        *KEY, F.lit(0).cast("long").alias("slice"), F.when(F.col("kept").isNull() | own, F.col("html")).alias("html"),
        part_of(F.col("page_id").isNotNull(), F.coalesce("page_id", F.lit(0)), "digest", "place").alias("part"),
    )
    told = decisions.join(single, _same(decisions, single, KEY) & (decisions["copies"] > 0), "left")
    html = F.when((F.col("kind") == "response") & (whole | (F.col("slice") == 0)), single["html"])
    told = told.select(*[decisions[c] for c in decisions.columns], html.alias("html"))
    return told.unionByName(payloads, allowMissingColumns=True), parts


def write_warc(
    pages: DataFrame, root: str, roll_bytes: int = ROLL_BYTES, partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """Write all pages below ``root``, a folder that every executor reaches; returns the committed manifest.

    A null html is an empty payload; null pages come first and null urls have no target field; repeated rows are
    records of their own, of which one at most is a long response. An empty table gives an empty manifest. Characters
    that a header field cannot hold are percent-encoded in urls.
    """
    spark = pages.sparkSession
    rows, parts = planned(pages.select("page_id", "url", "html"), partition_bytes)
    system, path = fs.FileSystem.from_uri(root)
    system.create_dir(f"{path}/_temporary", recursive=True)
    dealt = rows.repartitionById(parts, "part").drop("part")
    ordered = dealt.sortWithinPartitions(*KEY, "slice", F.col("kind").isNull())
    written = stored(ordered.mapInArrow(lambda b: _write(b, root, roll_bytes), MANIFEST), "warc-written")
    moved = stored(written.mapInPandas(lambda b: _rename(b, root), MANIFEST), "warc-moved")
    moved.orderBy("name").write.mode("errorifexists").parquet(f"{root}/manifest")
    return spark.read.parquet(f"{root}/manifest")


RECORD = (
    "file string, page_id long, url string, record_id string, record_type string, refers_to long,"
    " payload_bytes long, payload_digest string, payload binary"
)


def records_in(stream: Any) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of an archive, read piece by piece."""
    with gzip.GzipFile(fileobj=stream) as archive:
        while True:
            line = archive.readline()
            if not line:
                return
            if line in (b"\r\n", b"\n"):
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record starts with {line[:40]!r}")
            fields = {}
            while (line := archive.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                fields[name] = value
            block = archive.read(int(fields["Content-Length"]))
            if _field(hashlib.sha1(block).hexdigest()) != fields["WARC-Block-Digest"]:
                raise ValueError(f"damaged block of {fields['WARC-Record-ID']}")
            yield fields, block


def _read(batches: Iterator[pd.DataFrame], root: str) -> Iterator[pd.DataFrame]:
    system, path = fs.FileSystem.from_uri(root)
    names = [column.split()[0] for column in RECORD.split(", ")]
    for batch in batches:
        for name in batch["name"]:
            rows, size = [], 0
            with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                for fields, block in records_in(stream):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex()
                    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
                    ids = [int(fields[f]) if f in fields else None for f in ("Page-ID", "Refers-To-Page-ID")]
                    rows.append(
                        (name, ids[0], fields.get("WARC-Target-URI"), fields["WARC-Record-ID"], kind, ids[1],
                         length, digest, payload if kind == "response" else None)
                    )
                    size += len(payload)
                    if size >= _BATCH or len(rows) >= 5000:
                        yield _frame(rows, names)
                        rows, size = [], 0
            if rows:
                yield _frame(rows, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    columns = dict(zip(names, zip(*rows, strict=True), strict=True))
    whole = {"page_id", "refers_to"}  # nullable whole numbers, which pandas would make floats
    return pd.DataFrame({n: pd.Series(c, dtype="Int64" if n in whole else None) for n, c in columns.items()})


def read_warc(spark: SparkSession, root: str) -> DataFrame:
    """All records that the manifest of ``root`` lists, one file at a time per task; digests are verified."""
    manifest = spark.read.parquet(f"{root}/manifest").select("name")
    files = manifest.count()
    return manifest.repartition(max(1, files), "name").mapInPandas(lambda b: _read(b, root), RECORD)
