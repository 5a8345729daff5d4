import pytest
from pyspark.sql import functions as F

from firmroll.plans.ingest import bucket_count, ingest_feed, ingest_marked, repaired_rows
from firmroll.sources.feeds import read_processed, read_raw, shard_glob, write_processed
from firmroll.sources.listing import compact_period, latest_period, latest_period_in_pages, require_period
from firmroll.sources.schemas import feed_schema

LINES = [
    b'"1";"A;B";"x"',
    b'"2";"S\xc3O \\ PAULO";""',
    b'"3"',
    b'"4";"p";"q";"r";"s";"t";"u";"extra"',
    b'"5";"\xa0nb\xa0";" t "',
]


def write_lines(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(b"\n".join(lines) + b"\n")


def by_first(df):
    return {row[0].strip('"'): tuple(row) for row in df.collect()}


def test_raw_scan_without_quotes(spark, tmp_path):
    write_lines(tmp_path, "Empresas0.csv", LINES)
    rows = by_first(read_raw(spark, "empresas", str(tmp_path)))
    assert rows["1"][:4] == ('"1"', '"A', 'B"', '"x"')
    assert rows["2"][:4] == ('"2"', '"SÃO \\ PAULO"', '""', None)
    assert rows["3"] == ('"3"',) + (None,) * 6
    assert rows["4"] == ('"4"', '"p"', '"q"', '"r"', '"s"', '"t"', '"u"')
    assert rows["5"][1:3] == ('" nb "', '" t "')


def test_raw_scan_with_quotes(spark, tmp_path):
    write_lines(tmp_path, "Simples.csv", LINES)
    rows = by_first(read_raw(spark, "simples", str(tmp_path)))
    assert rows["1"][:3] == ("1", "A;B", "x")
    assert rows["2"][:2] == ("2", "SÃO \\ PAULO")
    assert rows["4"] == ("4", "p", "q", "r", "s", "t", "u")
    asked = by_first(read_raw(spark, "empresas", str(tmp_path), quote='"'))
    assert asked["1"][:3] == ("1", "A;B", "x")


def test_rows_of_the_wrong_width_are_marked(spark, tmp_path):
    write_lines(tmp_path / "2026-03", "Empresas0.csv", LINES)
    write_lines(tmp_path / "2026-03", "Empresas1.csv", [b'"6";"a";"b";"c";"d";"e";"f"', b'"7";"a"', b'"8";"a"', b""])
    write_lines(tmp_path / "2026-03", "Simples.csv", [b'"1";"A;B";"x;";"";"";"";""', b'"2";"S;S;S;S;S;S;S"', b'"3";;;;;;;";"'])
    rows = ingest_marked(spark, "empresas", shard_glob(str(tmp_path), "2026-03", "empresas"))
    marks = {r["cnpj_basico"]: (r["width_repair"], r["repaired_in"]) for r in rows.collect()}
    assert marks["4"] == ("cut", "Empresas0.csv") and marks["6"] == (None, None) and marks["8"] == ("padded", "Empresas1.csv")
    plain = ingest_feed(spark, "empresas", shard_glob(str(tmp_path), "2026-03", "empresas"))
    assert rows.drop("width_repair", "repaired_in").collect() == plain.collect()
    rows.write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    counts = {(r["shard"], r["repair"]): r["n"] for r in repaired_rows(staged).collect()}
    assert counts == {("Empresas0.csv", "cut"): 1, ("Empresas0.csv", "padded"): 4, ("Empresas1.csv", "padded"): 2}
    quoted = ingest_marked(spark, "simples", shard_glob(str(tmp_path), "2026-03", "simples"))
    assert {r["cnpj_basico"]: r["width_repair"] for r in quoted.collect()} == {"1": None, "2": "padded", "3": "cut"}


def test_shards_of_a_period_are_read_together(spark, tmp_path):
    for shard in range(3):
        write_lines(tmp_path / "2026-03", f"Empresas{shard}.csv", [b'"%d";" NOME %d "' % (shard, shard)])
    write_lines(tmp_path / "2026-03", "Socios0.csv", [b'"9";"1"'])
    glob = shard_glob(str(tmp_path), "2026-03", "empresas")
    rows = ingest_feed(spark, "empresas", glob).collect()
    assert sorted((row["cnpj_basico"], row["razao_social"]) for row in rows) == [
        ("0", "NOME"), ("1", "NOME"), ("2", "NOME"),
    ]


def test_buckets_follow_the_largest_feed(spark, tmp_path):
    write_lines(tmp_path / "2026-03", "Socios0.csv", [b"x" * 1000])
    write_lines(tmp_path / "2026-03", "Empresas0.csv", [b"x" * 3000])
    write_lines(tmp_path / "2026-03", "Empresas1.csv", [b"x" * 4000])
    assert bucket_count(spark, str(tmp_path), "2026-03", 1000) == 8
    assert bucket_count(spark, str(tmp_path), "2026-03", 4000) == 2
    assert bucket_count(spark, str(tmp_path), "2026-03") == 1


def test_ingest_cleans_every_field(spark, tmp_path):
    write_lines(tmp_path, "Empresas0.csv", LINES)
    rows = by_first(ingest_feed(spark, "empresas", str(tmp_path)))
    assert rows["2"] == ("2", "SÃO  PAULO", "", "", "", "", "")
    assert rows["5"] == ("5", "nb", "t", "", "", "", "")


def test_export_reads_back(spark, tmp_path):
    values = [("1", "SÃO \\ X", " keep ", "", "a'b", "", "z"), ("2", "", "", "", "", "", "")]
    df = spark.createDataFrame(values, feed_schema("empresas"))
    path = str(tmp_path / "out")
    write_processed(df.repartition(2), path)
    text = b"".join(file.read_bytes() for file in (tmp_path / "out").glob("part-*"))
    assert b"S\xc3O" in text and b'""' not in text
    back = by_first(read_processed(spark, "empresas", path))
    assert back["1"] == ("1", "SÃO \\ X", " keep ", "", "a'b", "", "z")
    assert back["2"] == ("2", "", "", "", "", "", "")


def test_export_of_separators_and_quotes(spark, tmp_path):
    values = [("1", "a;b", 'say "x"; y', '"', "c\\", ";", "z"), ("2", "p", "", "", "", "", "q")]
    df = spark.createDataFrame(values, feed_schema("empresas"))
    write_processed(df.coalesce(1), str(tmp_path / "out"))
    text = b"".join(file.read_bytes() for file in (tmp_path / "out").glob("part-*")).splitlines()
    assert text[1] == b'1;"a;b";"say ""x""; y";"""";c\\;";";z' and text[2] == b"2;p;;;;;q"
    assert by_first(read_processed(spark, "empresas", str(tmp_path / "out"))) == {v[0]: v for v in values}
    broken = df.selectExpr("*").withColumn("razao_social", F.lit("two\nlines"))
    with pytest.raises(Exception, match="line break"):
        write_processed(broken, str(tmp_path / "bad"))


def test_export_of_short_and_long_rows(spark, tmp_path):
    write_lines(tmp_path, "e.csv", [b"a;b;c", b"1;x", b"2;1;2;3;4;5;6;7"])
    rows = by_first(read_processed(spark, "empresas", str(tmp_path)))
    assert rows["1"] == ("1", "x", "", "", "", "", "")
    assert rows["2"] == ("2", "1", "2", "3", "4", "5", "6")


def test_unknown_feed(spark):
    with pytest.raises(ValueError):
        feed_schema("x")


def test_latest_period(spark):
    paths = ["/a/2025-12/", "/a/2026-01", "/a/2026-13/", "/a/2027-05/x", "/temp/"]
    listing = spark.createDataFrame([(path,) for path in paths], "path string")
    assert require_period(latest_period(listing, "path")) == "2026-01"
    with pytest.raises(ValueError):
        require_period(latest_period(listing.where("path = '/temp/'"), "path"))


def test_latest_period_in_pages(spark):
    linked = '<a href="2026-01/">2026-09/</a><a href="2025-11/">x</a>'
    shown = "<td>2026-02/</td><td>2026-03/</td>"
    both = spark.createDataFrame([(linked,), (shown,)], "page string")
    assert require_period(latest_period_in_pages(both, "page")) == "2026-01"
    assert require_period(latest_period_in_pages(both.where("page like '<td>%'"), "page")) == "2026-03"


def test_compact_period():
    assert compact_period("2026-03") == "202603"
    assert compact_period("202603") == "202603"
