import gzip
import hashlib
from collections import Counter, defaultdict
from pathlib import Path

from firmroll.llm import warc

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    out = Counter()
    for html, ids in groups.items():
        raw = html.encode()
        ids = sorted(ids, key=lambda i: (i is None, -(i or 0)))
        for n, page_id in enumerate(ids):
            again = len(raw) >= 1000 and n > 0
            out[(page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", ids[0] if again else None)] += 1
    return out


def read(spark, root):
    found = warc.read_warc(spark, root)
    return Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()
    )


def test_query(same_as_sql):
    same_as_sql("op8_warc")


ROWS = (
    [(i, f"http://a.org/{i}", f"<p>{i % 40}</p>" * (200 if i % 3 else 20)) for i in range(300)]
    + [(1000 + i, "http://a.org/é\r\nX: y", "same page " * 300) for i in range(150)]
    + [(2000, None, None), (2001, "", ""), (None, "u", "z" * 2000), (None, "u", "z" * 2000), (7, "u", "z" * 2000)]
    + [(3000, "v", "w" * 1500)] * 3
    + [((1 << 62) + 1, "v", "q" * 1200), ((1 << 62) + 3, "v", "q" * 1200)]
    + [(4000, "v", "\r\n\r\nWARC/1.1\r\n" * 100), (4001, "v", "x" * 3_000_000)]
)


def test_rows_come_back(spark, tmp_path):
    pages = spark.createDataFrame([(*r, 1, "x") for r in ROWS], SCHEMA + ", digest long, kind string").repartition(6)
    manifest = warc.write_warc(pages, str(tmp_path / "a"), roll_bytes=2000, partition_bytes=20_000)
    names = [r.name for r in manifest.collect()]
    assert len(names) > 10 and len(set(names)) == len(names)
    assert read(spark, str(tmp_path / "a")) == expected(ROWS)
    payloads = {r.page_id: r.payload for r in warc.read_warc(spark, str(tmp_path / "a")).where("payload is not null").collect()}
    assert payloads[4000] == b"\r\n\r\nWARC/1.1\r\n" * 100
    order = []
    for name in sorted(names):
        with (tmp_path / "a" / name).open("rb") as file:
            order += [int(f["Page-ID"]) for f, _ in warc.records_in(file) if "Page-ID" in f]
    assert order == sorted(order)


def test_same_pages_same_bytes(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    one = warc.write_warc(pages.repartition(3), str(tmp_path / "a"), partition_bytes=20_000).drop("temporary").collect()
    two = warc.write_warc(pages.repartition(7), str(tmp_path / "b"), partition_bytes=20_000).drop("temporary").collect()
    assert sorted(one) == sorted(two)
    for row in one:
        data = Path(tmp_path / "a" / row.name).read_bytes()
        assert hashlib.sha256(data).hexdigest() == row.sha256 and len(data) == row.bytes
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_only_committed_files_are_read(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    root = str(tmp_path / "a")
    warc.write_warc(pages, root)
    (tmp_path / "a" / "pages-99999-00000.warc.gz").write_bytes(b"broken")
    (tmp_path / "a" / "_temporary" / "left.over").write_bytes(b"broken")
    assert read(spark, root) == expected(ROWS)


def test_empty_table(spark, tmp_path):
    root = str(tmp_path / "a")
    assert warc.write_warc(spark.createDataFrame([], SCHEMA), root).count() == 0
    assert warc.read_warc(spark, root).count() == 0


def test_null_pages_and_copies_are_spread(spark, tmp_path):
    """A third of the rows without a page, a third full copies of one short and one long row: no task gets them all."""
    rows = (
        [(None, f"u{i % 300}", f"null {i} " * 30) for i in range(600)]
        + [(5, "same", "short")] * 300
        + [(6, None, "long " * 400)] * 300
        + [(100 + i, "v", f"{i}" * 150) for i in range(600)]
    )
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    planned, parts = warc.planned(pages, 60_000)
    sizes = Counter()
    for r in planned.collect():
        sizes[r.part] += (warc.HEAD_BYTES * (r.copies or 1) if r.kind is None or r.copies else 0) + len(r.html or b"")
    assert parts > 15 and len(sizes) > 12
    assert max(sizes.values()) < 1.5 * 60_000
    root = str(tmp_path / "a")
    warc.write_warc(pages, root, partition_bytes=60_000)
    assert read(spark, root) == expected(rows)
    ids = [r.record_id for r in warc.read_warc(spark, root).collect()]
    assert len(set(ids)) == len(ids) == len(rows)


def test_ranges_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "MOST_RANGES", 7)
    pages = spark.createDataFrame([(i, "u", "x" * 500 + str(i)) for i in range(2000)], SCHEMA)
    rows, parts = warc.planned(pages, 1000)
    assert parts == 7 and rows.select("part").distinct().count() == 7


def test_heavy_payload_moves_once(spark):
    rows = [(i, "u", "same " * 1000) for i in range(300)] + [(1000 + i, "u", f"{i} " * 300) for i in range(100)]
    planned, _ = warc.planned(spark.createDataFrame(rows, SCHEMA), 1 << 20)
    moved = [r.page_id for r in planned.where("kind is null and html is not null").collect()]
    assert sorted(moved) == [299, *range(1000, 1100)]
