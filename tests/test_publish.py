import datetime as dt
import threading
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from firmroll.__main__ import main, parser
from firmroll.checks.fixtures import AS_OF, lookups, view
from firmroll.fixed_values import FEED_COLUMNS, FEED_FILE_PREFIX, NO_QUOTE
from firmroll.plans import monthly
from firmroll.plans.enrich import Feeds
from firmroll.plans.ingest import bucket_count
from firmroll.plans.metrics import snapshot_metrics
from firmroll.plans.publish import archive_name, publish_snapshot, recover, write_snapshot
from firmroll.sources import switch
from firmroll.sources.feeds import write_processed
from firmroll.sources.storage import MOST_BUCKETS, clear_scratch, materialise, read_snapshot, write_staging

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(spark, tag):
    columns = "'SP' as uf, '1' as cnpj_basico, '1' as cnpj_ordem, '1' as cnpj_dv, 'SP' as uf_geo"
    return spark.sql(f"select {columns}, '{tag}' as tag")


def tags(spark, table):
    return [row["tag"] for row in spark.table(table).collect()]


def tables(spark, database):
    """Names without the versioned tables that they stand for."""
    return {table.name for table in spark.catalog.listTables(database) if "__" not in table.name}


def snapshots(spark, database):
    return len([t for t in spark.catalog.listTables(database) if "__" in t.name])


def state(spark, database):
    return {name: tags(spark, f"{database}.{name}") for name in tables(spark, database)}


class Died(BaseException):
    """What no handler of errors catches."""


@pytest.fixture
def fail_at(monkeypatch):
    """Let one step fail: the writing of rows, or the first or second switch of a name."""

    def fail(step, error):
        calls = []
        real = switch.point

        def point(session, name, table):
            calls.append(name)
            if len(calls) == {"archive": 1, "live": 2}.get(step):
                raise error
            real(session, name, table)

        monkeypatch.setattr(switch, "point", point)
        if step == "write":
            monkeypatch.setattr("firmroll.plans.publish.write_snapshot", lambda *_: (_ for _ in ()).throw(error))

    return fail


def test_archive_name():
    assert archive_name("d.live", "2026-03", "2026-02") == "d.live_202602"
    assert archive_name("d.live", "202603") == "d.live_202603_bkp"


def test_first_publish_archives_nothing(spark, database):
    live = f"{database}.live"
    assert publish_snapshot(rows(spark, "a"), live, "2026-03") is None
    assert tags(spark, live) == ["a"] and tables(spark, database) == {"live"}


def test_publish_archives_the_previous_month(spark, database):
    live = f"{database}.live"
    publish_snapshot(rows(spark, "feb"), live, "2026-02")
    assert publish_snapshot(rows(spark, "mar"), live, "2026-03", "2026-02") == f"{live}_202602"
    assert tags(spark, live) == ["mar"] and tags(spark, f"{live}_202602") == ["feb"]
    assert publish_snapshot(rows(spark, "mar2"), live, "2026-03", "2026-02") == f"{live}_202602"
    assert tags(spark, live) == ["mar2"] and tags(spark, f"{live}_202602") == ["mar"]
    assert tables(spark, database) == {"live", "live_202602"}


@pytest.mark.parametrize("stale_archive", [False, True])
@pytest.mark.parametrize("step", ["write", "archive", "live"])
def test_failure_leaves_everything_as_it_was(spark, database, fail_at, stale_archive, step):
    live = f"{database}.live"
    publish_snapshot(rows(spark, "old"), live, "2026-01")
    if stale_archive:
        publish_snapshot(rows(spark, "good"), live, "2026-03")
    before, kept = state(spark, database), snapshots(spark, database)
    fail_at(step, RuntimeError("no such step"))
    with pytest.raises(RuntimeError, match="no such step"):
        publish_snapshot(rows(spark, "new"), live, "2026-03")
    assert state(spark, database) == before and snapshots(spark, database) == kept
    assert recover(spark, live) is None


def test_failing_rows_leave_the_live_table(spark, database):
    live = f"{database}.live"
    publish_snapshot(rows(spark, "old"), live, "2026-01")
    with pytest.raises(Exception, match="no rows"):
        publish_snapshot(rows(spark, "new").selectExpr("*", "raise_error('no rows') as x"), live, "2026-03")
    assert state(spark, database) == {"live": ["old"]}


@pytest.mark.parametrize("first", [False, True])
@pytest.mark.parametrize("step", ["write", "archive", "live"])
def test_a_dead_process_is_cleared_up(spark, database, monkeypatch, fail_at, first, step):
    live = f"{database}.live"
    if not first:
        publish_snapshot(rows(spark, "jan"), live, "2026-01")
        publish_snapshot(rows(spark, "feb"), live, "2026-02", "2026-01")
        publish_snapshot(rows(spark, "feb2"), live, "2026-03", "2026-02")
    before, kept = state(spark, database), snapshots(spark, database)
    with monkeypatch.context() as dying:
        fail_at(step if not first or step != "live" else "archive", Died())
        with pytest.raises(Died):
            publish_snapshot(rows(spark, "new"), live, "2026-03", "2026-02")
        dying.undo()
    monkeypatch.undo()
    assert recover(spark, live) == "undone" and recover(spark, live) is None
    assert state(spark, database) == before and snapshots(spark, database) == kept
    publish_snapshot(rows(spark, "new"), live, "2026-03", "2026-02")
    assert tags(spark, live) == ["new"]


def test_a_process_that_died_after_the_switch_is_finished(spark, database, monkeypatch):
    live = f"{database}.live"
    publish_snapshot(rows(spark, "feb"), live, "2026-02")
    publish_snapshot(rows(spark, "mar"), live, "2026-03", "2026-02")
    kept = snapshots(spark, database)
    with monkeypatch.context() as dying:
        dying.setattr("firmroll.plans.publish.Publication.finish", lambda *_: (_ for _ in ()).throw(Died()))
        with pytest.raises(Died):
            publish_snapshot(rows(spark, "mar2"), live, "2026-03", "2026-02")
    assert recover(spark, live) == "finished"
    assert state(spark, database) == {"live": ["mar2"], "live_202602": ["mar"]} and snapshots(spark, database) == kept


def test_a_reader_finds_the_live_table_at_any_time(spark, database):
    live, seen, stop = f"{database}.live", [], threading.Event()
    publish_snapshot(rows(spark, "m0"), live, "2026-01")

    def poll():
        while not stop.is_set():
            try:
                seen.append(tags(spark, live)[0])
            except Exception as error:
                seen.append(error)

    reader = threading.Thread(target=poll)
    reader.start()
    for month in range(1, 6):
        publish_snapshot(rows(spark, f"m{month}"), live, f"2026-0{month + 1}", f"2026-0{month}")
    stop.set()
    reader.join()
    assert all(isinstance(tag, str) for tag in seen), seen[-1]
    assert seen == sorted(seen) and len(set(seen)) > 2


def test_a_plain_table_becomes_a_switched_name(spark, database, tmp_path, fail_at, monkeypatch):
    live = f"{database}.live"
    write_snapshot(rows(spark, "old"), live, str(tmp_path / "old"))
    with monkeypatch.context():
        fail_at("live", Died())  # the first switch adopts the table
        with pytest.raises(Died):
            publish_snapshot(rows(spark, "new"), live, "2026-02", "2026-01")
    monkeypatch.undo()
    assert recover(spark, live) == "undone" and state(spark, database) == {"live": ["old"]}
    publish_snapshot(rows(spark, "new"), live, "2026-02", "2026-01")
    assert state(spark, database) == {"live": ["new"], "live_202601": ["old"]}


def test_blank_state_survives_the_partitioned_table(spark, database):
    blank = rows(spark, "a").selectExpr("'' as uf", "'nao informado' as uf_geo", "cnpj_basico", "cnpj_ordem", "cnpj_dv")
    publish_snapshot(blank, f"{database}.live", "2026-03")
    assert spark.table(f"{database}.live").where("uf_geo = 'nao informado'").first()["uf"] == ""


def test_staging_table_is_replaced_bucketed_and_whole(spark, database):
    table = f"{database}.socios_202603"
    partners = view(spark, SMALL, "socios")
    write_staging(rows(spark, "a"), table, buckets=4)
    write_staging(partners, table, buckets=4)
    assert sorted(spark.table(table).collect()) == sorted(partners.collect())
    behind = switch.target(spark, table)
    described = {row["col_name"]: row["data_type"] for row in spark.sql(f"describe extended {behind}").collect()}
    assert described["Num Buckets"] == "4" and described["Bucket Columns"] == "[`cnpj_basico`]"
    assert described["Sort Columns"] == "[`cnpj_basico`]"


def test_a_failing_load_keeps_the_one_before(spark, database, monkeypatch):
    table = f"{database}.socios_202603"
    write_staging(rows(spark, "a"), table, buckets=2)
    reader = spark.table(table)
    with pytest.raises(Exception, match="bad feed"):
        write_staging(rows(spark, "b").selectExpr("*", "raise_error('bad feed') as x"), table, buckets=2)
    assert tags(spark, table) == ["a"] and snapshots(spark, database) == 1
    with monkeypatch.context() as broken:
        broken.setattr(switch, "point", lambda *_: (_ for _ in ()).throw(RuntimeError("no switch")))
        with pytest.raises(RuntimeError):
            write_staging(rows(spark, "b"), table, buckets=2)
    assert tags(spark, table) == ["a"] and snapshots(spark, database) == 1
    write_staging(rows(spark, "b"), table, buckets=3)
    assert [r["tag"] for r in reader.collect()] == ["a"] and tags(spark, table) == ["b"]
    write_staging(rows(spark, "c"), table, buckets=2)
    assert tags(spark, table) == ["c"] and snapshots(spark, database) == 2


def test_a_plain_staging_table_is_replaced(spark, database):
    table = f"{database}.socios_202603"
    rows(spark, "a").write.saveAsTable(table)
    write_staging(rows(spark, "b"), table, buckets=2)
    assert tags(spark, table) == ["b"]


def test_buckets_stay_within_the_session_limit(spark, database, tmp_path):
    (tmp_path / "2026-03").mkdir()
    (tmp_path / "2026-03" / "Socios0.csv").write_bytes(b"x" * 5000)
    assert bucket_count(spark, str(tmp_path), "2026-03", 1) == 5000
    spark.conf.set(MOST_BUCKETS, "6")
    try:
        buckets = bucket_count(spark, str(tmp_path), "2026-03", 1)
        assert buckets == 6
        write_staging(rows(spark, "a"), f"{database}.socios_202603", buckets)
        with pytest.raises(ValueError, match="7 buckets"):
            write_staging(rows(spark, "b"), f"{database}.socios_202603", 7)
    finally:
        spark.conf.unset(MOST_BUCKETS)
    assert tags(spark, f"{database}.socios_202603") == ["a"]


def test_staging_spreads_a_company_with_a_third_of_all_rows(spark, database):
    table = f"{database}.socios_202604"
    df = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'big' else concat('k', id) end as cnpj_basico", "id"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        write_staging(df.repartition(20), table, buckets=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.table(table).count() == 3000
    behind = spark.table(switch.target(spark, table))
    files = behind.where("cnpj_basico = 'big'").select("_metadata.file_path").distinct().count()
    assert files > 1
    assert spark.table(table).groupBy("cnpj_basico").count().where("count > 1").first()["count"] == 1000


def test_month_from_raw_files_to_live_table(spark, database, tmp_path):
    raw = tmp_path / "raw"
    for feed in FEED_COLUMNS:
        write_processed(view(spark, SMALL, f"raw_{feed}").repartition(2), str(tmp_path / feed), header=False, quote=NO_QUOTE)
        (raw / "2003-06").mkdir(parents=True, exist_ok=True)
        for i, part in enumerate(sorted((tmp_path / feed).glob("part-*"))):
            (raw / "2003-06" / f"{FEED_FILE_PREFIX[feed]}{i}.csv").write_bytes(part.read_bytes())
    with (raw / "2003-06" / "Empresas1.csv").open("ab") as file:
        file.write(b"99999998\n99999997;a;b;c;d;e;f;g\n99999996;a\n")
    staged = monthly.stage_month(spark, str(raw), "2003-06", database)
    assert staged["empresas"] == f"{database}.empresas_200306"
    live = f"{database}.live"
    counts = monthly.publish_month(spark, "2003-06", lookups(spark, SMALL), AS_OF, live, database=database)
    found = {(row["metric"], row["item"]): row["n"] for row in counts.collect()}
    establishments = view(spark, SMALL, "estabelecimentos")
    assert found["loaded_rows", "estabelecimentos"] == establishments.count()
    assert found["dropped_rows", "ZZ"] == establishments.where("situacao_cadastral = '02' and uf = 'ZZ'").count()
    assert found["published_total", None] == read_snapshot(spark, live).count() > 0
    assert found["padded_rows", "empresas/Empresas1.csv"] == 2 and found["cut_rows", "empresas/Empresas1.csv"] == 1
    assert sum(metric in ("padded_rows", "cut_rows") for metric, _ in found) == 2
    assert found["unreadable_capital", None] == view(spark, SMALL, "empresas").where("capital_social = 'n/d'").count() + 1


def test_counts_of_hundreds_of_unknown_states(spark):
    feeds = [view(spark, SMALL, name) for name in ("estabelecimentos", "empresas", "socios", "simples", "empresa_faixas_opt")]
    unknown = feeds[0].limit(1).withColumn("situacao_cadastral", F.lit("02"))
    many = unknown.crossJoin(spark.range(300)).withColumn("uf", F.concat(F.lit("state "), "id")).drop("id")
    missing = unknown.withColumn("uf", F.lit(None).cast("string"))
    inputs = Feeds(feeds[0].unionByName(many).unionByName(missing), *feeds[1:])
    found = snapshot_metrics(inputs, missing.unionByName(missing))
    rows = {(r["metric"], r["item"]): r["n"] for r in found.collect()}
    assert sum(m == "dropped_rows" and i.startswith("state ") for m, i in rows) == 300
    assert rows["loaded_rows", "estabelecimentos"] == inputs.establishments.count()
    # Rows without a state are no second total.
    assert rows["published_total", None] == 2 and rows["published_rows", None] == 2
    empty = snapshot_metrics(Feeds(*[f.limit(0) for f in feeds]), feeds[0].limit(0)).collect()
    assert {(r["metric"], r["item"]): r["n"] for r in empty}["published_total", None] == 0


def test_stage_command(spark, database, tmp_path, capsys):
    (tmp_path / "2026-03").mkdir()
    (tmp_path / "2026-03" / "Simples.csv").write_bytes(b'"1";"S";"20070701";"00000000";"N";"0";""\n')
    main(["stage", "2026-03", "Simples", "--raw-root", str(tmp_path), "--database", database, "--buckets", "2"])
    table = capsys.readouterr().out.strip().splitlines()[-1]
    assert table == f"{database}.simples_202603"
    assert [tuple(row) for row in spark.table(table).collect()] == [("1", "S", "20070701", "", "N", "", "", None, None)]


def test_scratch_is_cleared(spark):
    kept = materialise(spark.range(3).toDF("x"), "kept")
    assert kept.count() == 3
    folder = Path(kept.inputFiles()[0].removeprefix("file:")).parent
    assert folder.exists()
    clear_scratch(spark)
    assert not folder.exists()


def test_command_line_arguments():
    args = parser().parse_args(["publish", "202603", "202602", "--table", "d.live", "--as-of", "2026-03-31"])
    assert (args.period, args.old_period, args.table, args.as_of) == ("202603", "202602", "d.live", dt.date(2026, 3, 31))
    with pytest.raises(SystemExit):
        parser().parse_args(["stage", "2026-03", "unknown", "--raw-root", "/x"])
