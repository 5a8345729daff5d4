"""Counts that describe a run."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmroll.fixed_values import ACTIVE_STATUS, PUBLISHED_UFS
from firmroll.functions.derive import blank_to_null, parse_capital
from firmroll.plans.enrich import Feeds, active
from firmroll.plans.ingest import repaired_rows


def _rolled_up(rows: DataFrame) -> DataFrame:
    """``uf``, ``n`` and ``is_total``, which tells the total from rows without a state."""
    return rows.rollup("uf").agg(F.count(F.lit(1)).alias("n"), (F.grouping_id() > 0).alias("is_total"))


def count_by_uf(rows: DataFrame) -> DataFrame:
    """Rows per state and in total, a row whose ``uf`` is NULL; one pass."""
    return _rolled_up(rows).select("uf", "n")


def companies_with_partners(partners: DataFrame) -> DataFrame:
    return partners.agg(F.countDistinct("cnpj_basico").alias("n"))


def loaded_rows(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """One row per feed: ``feed``, ``n``."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(feed).alias("feed"), "n") for feed, df in feeds.items()]
    return reduce(DataFrame.unionByName, counts)


def dropped_by_uf(establishments: DataFrame) -> DataFrame:
    """Active establishments that are not published because of their state, per state."""
    left_out = active(establishments).where(~F.col("uf").isin(PUBLISHED_UFS))
    return left_out.groupBy("uf").agg(F.count(F.lit(1)).alias("n"))


def _unreadable() -> Column:
    capital = F.col("capital_social")
    return blank_to_null(capital).isNotNull() & parse_capital(capital).isNull()


def unreadable_capital(companies: DataFrame) -> DataFrame:
    """Companies whose capital is given but is not a number that fits; it is published as NULL."""
    return companies.agg(F.count(F.when(_unreadable(), F.lit(1))).alias("n"))


def _counts(*parts: tuple[str, Column | None, Column]) -> Column:
    """An array of (metric, item, n)."""
    return F.array(*[
        F.struct(
            F.lit(metric).alias("metric"),
            (F.lit(None) if item is None else item).cast("string").alias("item"),
            n.cast("long").alias("n"),
        )
        for metric, item, n in parts
    ])


def snapshot_metrics(
    feeds: Feeds, published: DataFrame, marked: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """All counts of a run in long form: ``metric``, ``item``, ``n``. Every table is aggregated once.

    ``marked`` has staged feeds whose repaired rows are counted too, as ``padded_rows`` and ``cut_rows`` per
    ``<feed>/<shard>``; of those tables only the marks are read.
    """
    one, n = F.count(F.lit(1)), F.col("n")
    dropped = (F.col("situacao_cadastral") == ACTIVE_STATUS) & ~F.col("uf").isin(PUBLISHED_UFS)
    establishments = feeds.establishments.groupBy(
        F.coalesce(dropped, F.lit(False)).alias("dropped"), F.when(dropped, F.col("uf")).alias("uf")
    ).agg(one.alias("n"))
    companies = feeds.companies.agg(one.alias("n"), F.count(F.when(_unreadable(), F.lit(1))).alias("bad"))
    partners = feeds.partners.agg(one.alias("n"), F.countDistinct("cnpj_basico").alias("companies"))

    def loaded(feed: str) -> tuple[str, Column, Column]:
        return "loaded_rows", F.lit(feed), n

    parts = [
        establishments.select(
            F.when(F.col("dropped"), _counts(loaded("estabelecimentos"), ("dropped_rows", F.col("uf"), n)))
            .otherwise(_counts(loaded("estabelecimentos"))).alias("c")
        ),
        companies.select(_counts(loaded("empresas"), ("unreadable_capital", None, F.col("bad"))).alias("c")),
        partners.select(_counts(loaded("socios"), ("companies_with_partners", None, F.col("companies"))).alias("c")),
        feeds.tax_status.agg(one.alias("n")).select(_counts(loaded("simples")).alias("c")),
        _rolled_up(published).select(
            F.when(F.col("is_total"), _counts(("published_total", None, n)))
            .otherwise(_counts(("published_rows", F.col("uf"), n))).alias("c")
        ),
        # Totals that are there even if a table is empty.
        feeds.tax_status.sparkSession.range(1).select(
            _counts(("loaded_rows", F.lit("estabelecimentos"), F.lit(0)), ("published_total", None, F.lit(0))).alias("c")
        ),
    ]
    for feed, rows in (marked or {}).items():
        metric, item = F.concat("repair", F.lit("_rows")), F.concat(F.lit(f"{feed}/"), F.col("shard"))
        parts.append(repaired_rows(rows).select(F.array(F.struct(metric.alias("metric"), item.alias("item"), "n")).alias("c")))
    rows = reduce(DataFrame.unionByName, parts).select(F.inline("c"))
    return rows.groupBy("metric", "item").agg(F.sum("n").alias("n"))
