"""The physical plans that make the jobs scale."""

import re
import uuid
from pathlib import Path

import pytest
from plan_text import explained, operators
from pyspark.sql import functions as F

from firmroll.checks.fixtures import AS_OF, lookups, view
from firmroll.fixed_values import FEED_COLUMNS, NO_QUOTE, SIZE_OVERRIDE_TABLE
from firmroll.functions.cleaning import clean_feed
from firmroll.operators import lookups as lookup_module
from firmroll.operators.numbering import range_bounds, range_number
from firmroll.operators.partners import top_partners
from firmroll.plans import enrich as plan
from firmroll.plans.ingest import buckets_for, ingest_marked
from firmroll.plans.monthly import staged_feeds
from firmroll.sources.feeds import write_processed
from firmroll.sources.storage import staging_name, write_staging

SMALL = "/root/testdata/sf0.001"


def count(df, name):
    return sum(operator.startswith(name) for operator in operators(df))


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    database = f"p_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path_factory.mktemp('plans')}/{database}'")
    for feed in FEED_COLUMNS:
        write_staging(view(spark, SMALL, feed), staging_name(feed, "2003-06", database), buckets=8)
    return staged_feeds(spark, "2003-06", view(spark, SMALL, SIZE_OVERRIDE_TABLE), database)


@pytest.fixture
def no_automatic_broadcast(spark):
    """Plan as for tables far above the broadcast threshold; only asked-for broadcasts remain."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_partners_cut_groups_before_their_only_shuffle(spark):
    df = top_partners(view(spark, SMALL, "socios"))
    assert count(df, "Exchange") == 1
    names = operators(df)
    limits = [i for i, name in enumerate(names) if name.startswith("WindowGroupLimit")]
    shuffle = names.index("Exchange")
    assert len(limits) == 2 and limits[0] < shuffle < limits[1]


def test_the_pivot_has_one_aggregate_per_slot(spark):
    """Not one per slot and column: each of them goes through every row."""
    final = next(x for x in explained(top_partners(view(spark, SMALL, "socios"), hot=[]), "simple").splitlines() if "Aggregate" in x)
    assert final.count("max(") == 3


def test_buckets_grow_with_the_rows_of_the_largest_feed(spark):
    feeds = [spark.range(10), spark.range(25)]
    assert [buckets_for(spark, feeds, bucket_rows=n) for n in (5, 10, 100)] == [5, 3, 1]
    assert buckets_for(spark, feeds, least=8, bucket_rows=10) == 8
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "4")
    try:
        assert buckets_for(spark, feeds, bucket_rows=5) == 4
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")


def test_top_partners_read_only_shown_columns(spark, staged):
    schema = re.search(r"ReadSchema: (.*)", explained(top_partners(staged.partners))).group(1)
    assert "representante_legal:" not in schema.replace("qualificacao_representante_legal:", "")
    assert "pais:" not in schema


@pytest.mark.usefixtures("no_automatic_broadcast")
def test_each_side_is_shuffled_once(spark):
    from firmroll.checks.queries import feeds

    df = plan.joined(feeds(spark, SMALL), plan.measured(lookups(spark, SMALL)), hot=[])
    names = operators(df)
    assert count(df, "SortMergeJoin") == 4
    assert sum(name == "Exchange" for name in names) == 5
    assert count(df, "BroadcastHashJoin") == 7 and count(df, "BroadcastNestedLoopJoin") == 0
    assert count(df, "CartesianProduct") == 0


@pytest.mark.usefixtures("no_automatic_broadcast")
def test_staged_tables_join_without_shuffle(spark, staged):
    df = plan.joined(staged, plan.measured(lookups(spark, SMALL)), hot=[])
    assert count(df, "SortMergeJoin") == 4
    # Only the size override, which is not a staged feed, moves.
    assert sum(name == "Exchange" for name in operators(df)) == 1


@pytest.mark.usefixtures("no_automatic_broadcast")
def test_a_hot_company_leaves_the_other_rows_without_shuffle(spark, staged):
    df = plan.joined(staged, plan.measured(lookups(spark, SMALL)), hot=["00000007"])
    text = explained(df)
    tree = text.split("\n\n")[0].split("Union")[1].splitlines()
    # The two branches of the union start at the same depth; the second one is the salted one.
    first = tree[1].index("-")
    second = next(i for i, line in enumerate(tree) if i > 1 and line.find("-") == first)
    end = next((i for i, line in enumerate(tree) if i > second and 0 <= line.find("-") < first), len(tree))
    others, hot = tree[1:second], tree[second:end]
    assert sum("- Exchange" in line for line in others) == 1
    assert sum("- Exchange" in line for line in hot) >= 5
    assert sum("SortMergeJoin" in line for line in others) == 4
    # Each branch tells the scans which keys it wants.
    assert "EqualTo(cnpj_basico,00000007)" in text
    assert "Not(EqualTo(cnpj_basico,00000007))" in text


def test_a_company_with_many_partners_is_cut_in_slices(spark, staged):
    assert count(top_partners(staged.partners, hot=[]), "Exchange") == 0
    names = operators(top_partners(staged.partners, hot=["00000007"]))
    assert names.count("Exchange") == 2 and names.count("WindowGroupLimit") >= 3


@pytest.mark.usefixtures("no_automatic_broadcast")
def test_whole_target_has_no_python_and_no_cross_join(spark, staged):
    text = explained(plan.conform(plan.joined(staged, plan.measured(lookups(spark, SMALL)), hot=[]), plan.target_values(AS_OF)))
    for slow in ("Python", "Pandas", "Cartesian", "NestedLoop"):
        assert slow not in text


def test_status_and_state_filters_reach_the_scan(spark, staged):
    text = explained(plan.active_establishments(staged.establishments))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "EqualTo(situacao_cadastral,02)" in pushed and "In(uf" in pushed


def test_unused_columns_are_not_read(spark, staged):
    df = plan.active_establishments(staged.establishments).groupBy("uf").agg(F.count(F.lit(1)))
    schema = re.search(r"ReadSchema: (.*)", explained(df)).group(1)
    assert schema == "struct<situacao_cadastral:string,uf:string>"


def test_rows_move_once_to_be_numbered(spark, staged):
    """One shuffle of the rows and one of the counts; the rows are sorted once, in the published order."""
    rows = plan.active_establishments(staged.establishments).withColumn("uf_geo", F.col("uf"))
    tree = explained(plan.number_by_uf(rows), "simple")
    above_join, side = tree.split("BroadcastHashJoin", 1)
    probe, build = side.split("BroadcastExchange", 1)
    assert "Exchange" not in above_join and "Window" not in above_join
    assert probe.count("Exchange") == 1 and probe.count("Window") == 1 and probe.count("Sort") == 1
    assert "SinglePartition" not in tree and "Python" not in tree
    order = re.search(r"Sort \[([^\]]*)\]", probe).group(1)
    assert re.sub(r"#\d+", "", order).replace(" ASC NULLS FIRST", "").split(", ")[:4] == [
        "uf_geo", "uf", "_range", "cnpj_basico",
    ]
    narrow = re.search(r"ReadSchema: (.*)", explained(plan.number_by_uf(rows)).split("BroadcastExchange")[-1])
    assert narrow is None or "nome_fantasia" not in narrow.group(1)


@pytest.mark.usefixtures("no_automatic_broadcast")
def test_publishing_sorts_the_wide_rows_once_and_stores_them_once(spark, staged, tmp_path_factory):
    """No scratch table between the joins and the published one."""
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.rglob("*.parquet")) if shared.exists() else set()
    rows = plan.enrich(staged, lookups(spark, SMALL), AS_OF)
    names = operators(rows)
    assert names.count("Window") <= 3 and "SinglePartition" not in explained(rows)
    assert (set(shared.rglob("*.parquet")) if shared.exists() else set()) == before


@pytest.mark.usefixtures("no_automatic_broadcast")
@pytest.mark.parametrize("repeat", [False, True])
def test_large_dictionaries_read_every_table_once(spark, staged, monkeypatch, repeat):
    """Also if codes repeat: no plan is doubled per dictionary."""
    monkeypatch.setattr(lookup_module, "BROADCAST_LIMIT_BYTES", 0)
    tables = lookups(spark, SMALL)
    if repeat:
        tables = {name: df.unionAll(df) if name.startswith("dict_") else df for name, df in tables.items()}
    df = plan.joined(staged, plan.measured(tables), hot=[])
    text = explained(df, "simple")
    for feed, column in (("socios", "faixa_etaria"), ("estabelecimentos", "nome_fantasia"), ("simples", "opcao_mei")):
        scans = [line for line in text.splitlines() if "Scan parquet" in line and f"{feed}_200306" in line]
        assert len(scans) == 1, (feed, column)


@pytest.mark.parametrize("n", [1, 5, 40])
def test_ranges_follow_the_order(spark, n):
    rows = spark.range(500).selectExpr("cast(id % 7 as string) as a", "cast(id * 7919 % 1000 as string) as b")
    bounds = range_bounds(rows, ["a", "b"], n)
    assert len(bounds) <= n - 1
    found = rows.withColumn("r", range_number(["a", "b"], bounds)).collect()
    assert all(r["r"] == sum(b <= (r["a"], r["b"]) for b in bounds) for r in found)


@pytest.mark.parametrize("feed", sorted(FEED_COLUMNS))
def test_cleaning_is_small_enough_to_be_compiled(spark, feed, tmp_path):
    """Above 8,000 bytes of code the JVM only interprets a method."""
    view(spark, SMALL, f"raw_{feed}").write.parquet(str(tmp_path / feed))
    query = clean_feed(spark.read.parquet(str(tmp_path / feed)), feed)._jdf.queryExecution()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", query.explainString(mode))
    assert sizes and max(map(int, sizes)) < 8000
    write_processed(view(spark, SMALL, f"raw_{feed}"), str(tmp_path / "raw"), header=False, quote=NO_QUOTE)
    marked = ingest_marked(spark, feed, str(tmp_path / "raw" / "*.csv"))._jdf.queryExecution()
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", marked.explainString(mode))
    assert sizes and max(map(int, sizes)) < 8000
