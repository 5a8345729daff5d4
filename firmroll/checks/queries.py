"""Every operator as a query over the test tables: name -> function of (spark, folder of the tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmroll.checks.fixtures import AS_OF, lookups, view, views
from firmroll.fixed_values import (
    FEED_COLUMNS,
    FILE_ENCODING,
    LOOKUP_COLUMNS,
    NO_QUOTE,
    PIVOT_SOURCES,
    SIZE_OVERRIDE_TABLE,
)
from firmroll.functions import cleaning, derive
from firmroll.functions.dates import parse_date_any
from firmroll.operators.lookups import Lookup, describe, measure_lookups
from firmroll.operators.partners import partner_rank, top_partners
from firmroll.operators.skew import left_join_all
from firmroll.plans import metrics
from firmroll.plans.enrich import (
    Feeds,
    active_establishments,
    company_side,
    enrich,
    enriched_rows,
    number_by_uf,
    override_side,
)
from firmroll.plans.ingest import buckets_for, ingest_feed, ingest_marked
from firmroll.plans.publish import Publication, journal_of, publish_snapshot, recover, snapshot_root
from firmroll.sources.feeds import REPAIRED_IN, read_processed, write_processed
from firmroll.sources.listing import compact_period, latest_period, latest_period_in_pages
from firmroll.sources.storage import read_snapshot, scratch_path, staging_name, write_staging

Query = Callable[[SparkSession, str], DataFrame]
# Expressions are built only when a query runs: building one needs a running session.
Columns = Callable[[], dict[str, Column]]
KEY = "cnpj_basico"
# Companies that the queries of the salted ways split, whatever their size; the last one has no rows.
LISTED_KEYS = ["00000001", "00000007", "00000034", "99999999"]


def named(columns: Columns) -> list[Column]:
    return [value.alias(name) for name, value in columns().items()]


def feeds(spark: SparkSession, sf_dir: str) -> Feeds:
    return Feeds(*views(spark, sf_dir, "estabelecimentos", "empresas", "socios", "simples", SIZE_OVERRIDE_TABLE))


def clean(feed: str) -> Query:
    return lambda spark, sf_dir: cleaning.clean_feed(view(spark, sf_dir, f"raw_{feed}"), feed)


def derived(source: str, key: list[str], columns: Columns) -> Query:
    """Key columns and derived columns of one view."""
    return lambda spark, sf_dir: view(spark, sf_dir, source).select(*key, *named(columns))


def establishment(columns: Columns, *keep: str) -> Query:
    return derived("estabelecimentos", ["nome_fantasia", *keep], columns)


def company(columns: Columns, *keep: str) -> Query:
    return derived("empresas", [KEY, *keep], columns)


def company_with_tax(columns: Columns) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        companies, tax, override = views(spark, sf_dir, "empresas", "simples", SIZE_OVERRIDE_TABLE)
        rows = left_join_all(company_side(companies), [tax, override_side(override)], KEY)
        return rows.select(KEY, *named(columns))

    return run


def joined_to(
    side: Callable[[SparkSession, str], DataFrame], *columns: str, hot: Sequence[str] | None = None
) -> Query:
    """Active establishments left-joined to one company-keyed table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = active_establishments(view(spark, sf_dir, "estabelecimentos"))
        return left_join_all(rows, [side(spark, sf_dir)], KEY, hot).select("nome_fantasia", *columns)

    return run


def measured(spark: SparkSession, sf_dir: str, name: str, source: str | None = None, limit: int | None = None) -> Lookup:
    """A dictionary, read from view ``source`` if that has another name."""
    return measure_lookups({name: (view(spark, sf_dir, source or name), *LOOKUP_COLUMNS[name])}, limit)[name]


def described(source: str, key: str, code: str, dictionary: str, out: str, limit: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = view(spark, sf_dir, source)
        rows = active_establishments(rows) if source == "estabelecimentos" else rows
        found = describe(rows.select(key, code), measured(spark, sf_dir, dictionary, limit=limit), code, out)
        return found.select(key, F.col(code).alias("codigo"), out)

    return run


def partner_roles(source: str | None = None, limit: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        roles = measured(spark, sf_dir, "dict_qualificacao_socio", source, limit)
        pivot = top_partners(view(spark, sf_dir, "socios"), roles=roles)
        names = ("desc_qualificacao_socio", "desc_qualificacao_representante")
        return pivot.select(KEY, *[f"{name}_{slot}" for slot in (1, 2, 3) for name in names])

    return run


def join_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key that a third of all rows share is the missing one; it is found, not given."""
    rows, companies = views(spark, sf_dir, "estabelecimentos_sem_chave", "empresas")
    return left_join_all(rows, [company_side(companies)], KEY).select("nome_fantasia", KEY, "razao_social")


def lookup_age_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    pivot = top_partners(view(spark, sf_dir, "socios"), ages=measured(spark, sf_dir, "dict_faixa_etaria"))
    return pivot.select(KEY, *[f"desc_faixa_etaria_{slot}" for slot in (1, 2, 3)])


def row_number_by_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = active_establishments(view(spark, sf_dir, "estabelecimentos"))
    numbered = number_by_uf(rows.select("uf", KEY, "cnpj_ordem", "cnpj_dv", "nome_fantasia"))
    return numbered.select("nome_fantasia", "uf", "linha_unica")


def count_by_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_by_uf(active_establishments(view(spark, sf_dir, "estabelecimentos")))


def loaded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.loaded_rows({feed: view(spark, sf_dir, feed) for feed in FEED_COLUMNS})


def snapshot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = feeds(spark, sf_dir)
    return metrics.snapshot_metrics(inputs, active_establishments(inputs.establishments))


def region_age_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active establishments, their companies and partners by region and age band."""
    inputs = feeds(spark, sf_dir)
    partners = top_partners(inputs.partners).select(KEY, F.lit(1).alias("has_partners"))
    companies = company_side(inputs.companies).withColumn("has_company", F.lit(1))
    rows = left_join_all(active_establishments(inputs.establishments), [companies, partners], KEY)
    return rows.groupBy(
        derive.macro_region(F.col("uf")).alias("regiao_geo"),
        derive.age_band(derive.parse_date(F.col("data_inicio_atividade")), AS_OF).alias("faixa_idade_empresa"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("has_company").alias("n_with_company"),
        F.count("has_partners").alias("n_with_partners"),
        F.sum(derive.parse_capital(F.col("capital_social"))).alias("capital"),
    )


def enriched_unnumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_rows(feeds(spark, sf_dir), lookups(spark, sf_dir), AS_OF)


def enriched_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(feeds(spark, sf_dir), lookups(spark, sf_dir), AS_OF)


def raw_csv(feed: str, source: str | None = None, quote: str | None = None) -> Query:
    """Raw files without header -> scan by position -> clean -> export -> scan of the export."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, processed = scratch_path(spark, f"raw-{feed}"), scratch_path(spark, f"processed-{feed}")
        write_processed(view(spark, sf_dir, source or f"raw_{feed}"), raw, header=False, quote=quote or NO_QUOTE)
        write_processed(ingest_feed(spark, feed, f"{raw}/*.csv", quote), processed)
        return read_processed(spark, feed, processed)

    return run


def width_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of which some lack their last fields or have more -> clean rows with what was done to them."""
    raw = scratch_path(spark, "raw-uneven")
    fields = [F.coalesce(name, F.lit("")) for name in FEED_COLUMNS["empresas"]]
    size = F.coalesce(F.length("razao_social"), F.lit(1))
    line = (
        F.when(size % 7 == 0, F.concat_ws(";", *fields[:-3]))
        .when(size % 11 == 0, F.concat_ws(";", *fields, F.lit("one"), F.lit("more")))
        .otherwise(F.concat_ws(";", *fields))
    )
    lines = view(spark, sf_dir, "raw_empresas").select(line.alias("line"))
    # One field per line, so that the separators in it are written as they are.
    lines.write.option("sep", "\u0001").option("quote", NO_QUOTE).option("encoding", FILE_ENCODING).csv(raw)
    return ingest_marked(spark, "empresas", f"{raw}/*.csv").drop(REPAIRED_IN)


def scratch_database(spark: SparkSession) -> str:
    name = f"firmroll_check_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def failed_with(message: str, run: Callable[[], object]) -> None:
    try:
        run()
    except Exception as error:  # Spark wraps the error of a task in more than one type
        if message not in str(error):
            raise
    else:
        raise AssertionError(f"should have failed with: {message}")


def staging_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = staging_name("estabelecimentos", "2003-06", scratch_database(spark))
    write_staging(clean("estabelecimentos")(spark, sf_dir), table, buckets=8)
    return spark.table(table)


def staging_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage a feed, fail while staging it again, read the staging table."""
    table, rows = staging_name("estabelecimentos", "2003-06", scratch_database(spark)), clean("estabelecimentos")(spark, sf_dir)
    write_staging(rows, table, buckets=8)
    broken = F.when(F.col("uf") == "SP", F.raise_error(F.lit("no such feed"))).otherwise(F.col("bairro"))
    failed_with("no such feed", lambda: write_staging(rows.withColumn("bairro", broken.cast("string")), table, buckets=8))
    return spark.table(table)


def publish_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish two months, stop a third between its steps, clear up, read the live table and the archive."""
    rows = active_establishments(view(spark, sf_dir, "estabelecimentos"))
    rows, live = rows.withColumn("uf_geo", derive.uf_label(F.col("uf"))), f"{scratch_database(spark)}.live"
    publish_snapshot(rows, live, "2003-05")
    publish_snapshot(rows, live, "2003-06", old_period="2003-05")
    stopped = Publication.planned(spark, live, "2003-07", "2003-05", snapshot_root(spark, live))
    journal_of(spark, live).write(asdict(stopped))
    stopped.write(rows.withColumn("cnpj_dv", F.lit("xx")))
    stopped.keep_previous(spark)
    recover(spark, live)
    columns = [KEY, "cnpj_ordem", "cnpj_dv", "uf"]
    both = [spark.table(name).select(F.lit(name.split(".")[1]).alias("tabela"), *columns) for name in (live, stopped.archive)]
    return both[0].unionByName(both[1])


def publish_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a month, fail while publishing the next one over it, read the live table."""
    rows = active_establishments(view(spark, sf_dir, "estabelecimentos"))
    rows, live = rows.withColumn("uf_geo", derive.uf_label(F.col("uf"))), f"{scratch_database(spark)}.live"
    publish_snapshot(rows, live, "2003-05")
    broken = F.when(F.col("uf") == "SP", F.raise_error(F.lit("no such month"))).otherwise(F.col("bairro"))
    bad = rows.withColumn("bairro", broken.cast("string"))
    failed_with("no such month", lambda: publish_snapshot(bad, live, "2003-06", old_period="2003-05"))
    return spark.table(live)


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage all feeds, enrich, publish a month, publish the next one over it, read the live table."""
    database = scratch_database(spark)
    staged, buckets = {}, buckets_for(spark, views(spark, sf_dir, *FEED_COLUMNS), least=8)
    for feed in FEED_COLUMNS:
        staged[feed] = staging_name(feed, "2003-06", database)
        write_staging(clean(feed)(spark, sf_dir), staged[feed], buckets)
    inputs = Feeds(
        *[spark.table(staged[feed]) for feed in ("estabelecimentos", "empresas", "socios", "simples")],
        view(spark, sf_dir, SIZE_OVERRIDE_TABLE),
    )
    rows, live = enrich(inputs, lookups(spark, sf_dir), AS_OF), f"{database}.live"
    publish_snapshot(rows, live, "2003-05")
    publish_snapshot(rows, live, "2003-06", old_period="2003-05")
    return read_snapshot(spark, live)


def queries() -> dict[str, Query]:
    col = F.col
    return {
        "clean_companies": clean("empresas"),
        "clean_establishments": clean("estabelecimentos"),
        "clean_partners": clean("socios"),
        "clean_tax_status": clean("simples"),
        "strip_trailing_document": company(
            lambda: {"nome": cleaning.drop_trailing_document(cleaning.trim_blanks(col("razao_social")))}, "razao_social"
        ),
        "void_dates": establishment(lambda: {"data": cleaning.void_date_to_blank(col("data_inicio_atividade"))}),
        "activity_code_filter": establishment(
            lambda: {"codigos": cleaning.activity_digits(col("cnae_fiscal_secundaria"))}, "cnae_fiscal_secundaria"
        ),
        "latest_period": lambda spark, sf_dir: latest_period(view(spark, sf_dir, "listagem"), "caminho"),
        "latest_period_linked": lambda spark, sf_dir: latest_period_in_pages(
            view(spark, sf_dir, "pagina_com_links"), "texto"
        ),
        "latest_period_shown": lambda spark, sf_dir: latest_period_in_pages(
            view(spark, sf_dir, "pagina_sem_links"), "texto"
        ),
        "period_normalise": derived(
            "periodos", ["periodo", "n"], lambda: {"compacto": compact_period(col("periodo"))}
        ),
        "full_key": establishment(
            lambda: {"cnpj": derive.full_key(col(KEY), col("cnpj_ordem"), col("cnpj_dv"))}
        ),
        "parse_dates": establishment(
            lambda: {
                name: derive.parse_date(col(name))
                for name in ("data_inicio_atividade", "data_situacao_cadastral", "data_situacao_especial")
            }
        ),
        "parse_dates_any": derived("datas", ["o_orderkey", "data"], lambda: {"lida": parse_date_any(col("data"))}),
        "parse_capital": company(lambda: {"capital": derive.parse_capital(col("capital_social"))}),
        "hq_branch_label": establishment(lambda: {"rotulo": derive.branch_label(col("identificador_matriz_filial"))}),
        "status_label": establishment(lambda: {"rotulo": derive.status_label(col("situacao_cadastral"))}),
        "size_label": company(lambda: {"rotulo": derive.size_label(col("porte_empresa"))}, "porte_empresa"),
        "partner_kind_label": derived(
            "socios",
            [KEY, "cpf_cnpj_socio"],
            lambda: {"rotulo": derive.partner_kind_label(col("identificador_socio"))},
        ),
        "tax_regime": company_with_tax(
            lambda: {"regime": derive.tax_regime(col("opcao_mei"), col("opcao_simples"))}
        ),
        "corrected_size": company_with_tax(
            lambda: {
                "rotulo": derive.corrected_size(col("opcao_mei"), col("porte")),
                "porte_empresa": F.coalesce("porte_opt", "porte"),
            }
        ),
        "revenue_band": company_with_tax(lambda: {"faixa": derive.revenue_band(col("opcao_mei"), col("porte"))}),
        "age_band": establishment(
            lambda: {"faixa": derive.age_band(derive.parse_date(col("data_inicio_atividade")), AS_OF)}
        ),
        "macro_region": establishment(lambda: {"regiao": derive.macro_region(col("uf"))}, "uf"),
        "uf_label": establishment(lambda: {"rotulo": derive.uf_label(col("uf"))}),
        "active_establishments": lambda spark, sf_dir: active_establishments(view(spark, sf_dir, "estabelecimentos")),
        "partner_rank": lambda spark, sf_dir: partner_rank(view(spark, sf_dir, "socios")),
        "top_partners_pivot": lambda spark, sf_dir: top_partners(view(spark, sf_dir, "socios")),
        "companies_with_partners": lambda spark, sf_dir: metrics.companies_with_partners(
            view(spark, sf_dir, "socios")
        ),
        "join_company": joined_to(
            lambda spark, sf_dir: company_side(view(spark, sf_dir, "empresas")),
            KEY, "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte",
            "ente_federativo_responsavel",
        ),
        "join_partner_pivot": joined_to(
            lambda spark, sf_dir: top_partners(view(spark, sf_dir, "socios"), blank=False),
            *[f"{name}_{slot}" for slot in (1, 2, 3) for name in PIVOT_SOURCES],
        ),
        "join_tax_status": joined_to(lambda spark, sf_dir: view(spark, sf_dir, "simples"), *FEED_COLUMNS["simples"][1:]),
        "join_size_override": joined_to(
            lambda spark, sf_dir: override_side(view(spark, sf_dir, SIZE_OVERRIDE_TABLE)), "porte_opt"
        ),
        "lookup_activity": described(
            "estabelecimentos", "nome_fantasia", "cnae_fiscal_principal", "dict_cnae", "desc_cnae_principal"
        ),
        "lookup_city": described("estabelecimentos", "nome_fantasia", "municipio", "dict_municipios", "desc_municipio"),
        "lookup_legal_nature": described(
            "empresas", KEY, "natureza_juridica", "dict_naturezas", "desc_natureza_juridica"
        ),
        "lookup_officer_role": described(
            "empresas", KEY, "qualificacao_responsavel", "dict_qualificacoes", "desc_qualificacao_responsavel"
        ),
        "lookup_partner_roles": partner_roles(),
        "lookup_partner_roles_repeated": partner_roles("dict_qualificacao_socio_repetida", limit=0),
        "lookup_activity_large": described(
            "estabelecimentos", "nome_fantasia", "cnae_fiscal_principal", "dict_cnae", "desc_cnae_principal", limit=0
        ),
        "join_company_salted": joined_to(
            lambda spark, sf_dir: company_side(view(spark, sf_dir, "empresas")),
            KEY, "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte",
            "ente_federativo_responsavel", hot=LISTED_KEYS,
        ),
        "join_null_key": join_null_key,
        "partner_rank_split": lambda spark, sf_dir: partner_rank(view(spark, sf_dir, "socios"), LISTED_KEYS),
        "top_partners_sliced": lambda spark, sf_dir: top_partners(view(spark, sf_dir, "socios"), hot=LISTED_KEYS),
        "lookup_age_group": lookup_age_group,
        "row_number_by_uf": row_number_by_uf,
        "count_by_uf": count_by_uf,
        "loaded_rows": loaded_rows,
        "dropped_by_uf": lambda spark, sf_dir: metrics.dropped_by_uf(view(spark, sf_dir, "estabelecimentos")),
        "unreadable_capital": lambda spark, sf_dir: metrics.unreadable_capital(view(spark, sf_dir, "empresas")),
        "snapshot_metrics": snapshot_metrics,
        "region_age_profile": region_age_profile,
        "enriched_rows": enriched_unnumbered,
        "enriched_full": enriched_full,
        "raw_csv_roundtrip": raw_csv("empresas"),
        "raw_csv_establishments": raw_csv("estabelecimentos"),
        "raw_csv_partners": raw_csv("socios"),
        "raw_csv_tax_status": raw_csv("simples"),
        "raw_csv_quoted": raw_csv("empresas", "raw_empresas_com_separador", '"'),
        "width_repairs": width_repairs,
        "staging_roundtrip": staging_roundtrip,
        "staging_rollback": staging_rollback,
        "publish_rollback": publish_rollback,
        "publish_recovery": publish_recovery,
        "snapshot_roundtrip": snapshot_roundtrip,
    }
