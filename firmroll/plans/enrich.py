"""The wide table: one row per active establishment with everything known about it.

Feeds are expected as :func:`firmroll.plans.ingest.ingest_feed` leaves them: text, trimmed, never NULL. Keys are
therefore joined bare, which keeps bucketed tables shuffle-free.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmroll.fixed_values import (
    ACTIVE_STATUS,
    LOOKUP_COLUMNS,
    PARTNER_COLUMNS,
    PARTNER_SLOTS,
    PIVOT_SOURCES,
    PUBLISHED_UFS,
)
from firmroll.functions import derive
from firmroll.operators.lookups import Lookup, describe, measure_lookups
from firmroll.operators.numbering import number_ranged
from firmroll.operators.partners import top_partners
from firmroll.operators.skew import Hot, hot_keys, left_join_all
from firmroll.sources.schemas import TARGET_SCHEMA

KEY = "cnpj_basico"
ROW_NUMBER = "linha_unica"
PARTITION = "uf_geo"
LAYOUT = ["uf", "cnpj_basico", "cnpj_ordem", "cnpj_dv"]

# Code column -> its dictionary and the column for the description.
ESTABLISHMENT_CODES = {
    "cnae_fiscal_principal": ("dict_cnae", "desc_cnae_principal"),
    "municipio": ("dict_municipios", "desc_municipio"),
}
COMPANY_CODES = {
    "natureza_juridica": ("dict_naturezas", "desc_natureza_juridica"),
    "qualificacao_responsavel": ("dict_qualificacoes", "desc_qualificacao_responsavel"),
}


@dataclass(frozen=True)
class Feeds:
    """The four clean feeds and the size override, which is not a feed but is keyed like one."""

    establishments: DataFrame
    companies: DataFrame
    partners: DataFrame
    tax_status: DataFrame
    size_override: DataFrame


def active(establishments: DataFrame) -> DataFrame:
    return establishments.where(F.col("situacao_cadastral") == ACTIVE_STATUS)


def active_establishments(establishments: DataFrame) -> DataFrame:
    """Active establishments with a published state; both conditions reach the Parquet scan."""
    return active(establishments).where(F.col("uf").isin(PUBLISHED_UFS))


def measured(lookups: Mapping[str, DataFrame]) -> dict[str, Lookup]:
    """Measure the six dictionaries, given by their table names."""
    return measure_lookups({name: (lookups[name], *columns) for name, columns in LOOKUP_COLUMNS.items()})


def company_side(companies: DataFrame) -> DataFrame:
    return companies.select(
        KEY, "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social",
        F.col("porte_empresa").alias("porte"), "ente_federativo_responsavel",
    )


def override_side(size_override: DataFrame) -> DataFrame:
    return size_override.select(F.trim(KEY).alias(KEY), F.col("porte_empresa").alias("porte_opt"))


def partner_side(partners: DataFrame, roles: Lookup, ages: Lookup) -> DataFrame:
    """The partner pivot with its descriptions."""
    return top_partners(partners, roles, ages, blank=False)


def _describe_all(
    df: DataFrame, lookups: Mapping[str, Lookup], codes: Mapping[str, tuple[str, str]], small: bool
) -> DataFrame:
    """Describe the codes whose dictionaries are small, or those whose dictionaries are not."""
    out = df
    for code, (name, description) in codes.items():
        if lookups[name].small == small:
            out = describe(out, lookups[name], code, description, () if small else hot_keys(df, code))
    return out


def joined(feeds: Feeds, lookups: Mapping[str, Lookup], hot: Hot | None = None) -> DataFrame:
    """All joins: four on the company key sharing one shuffle, then the small dictionaries by broadcast.

    A dictionary too large to broadcast is joined before that, on the feed that holds its code, where the codes that
    many rows share show in a plain scan.
    """
    establishments = active_establishments(feeds.establishments)
    if hot is None:
        hot = hot_keys(establishments, KEY)
    rows = left_join_all(
        _describe_all(establishments, lookups, ESTABLISHMENT_CODES, small=False),
        [
            _describe_all(company_side(feeds.companies), lookups, COMPANY_CODES, small=False),
            partner_side(feeds.partners, lookups["dict_qualificacao_socio"], lookups["dict_faixa_etaria"]),
            feeds.tax_status,
            override_side(feeds.size_override),
        ],
        KEY,
        hot,
        scan=all(lookups[name].small for name, _ in ESTABLISHMENT_CODES.values()),
    )
    return _describe_all(rows, lookups, ESTABLISHMENT_CODES | COMPANY_CODES, small=True)


def _partner_values(slot: int, date: Callable[[Column], Column]) -> dict[str, Column]:
    values = {f"{name}_{slot}": F.col(f"{name}_{slot}") for name in PARTNER_COLUMNS if name in PIVOT_SOURCES}
    for name in ("qualificacao_socio", "faixa_etaria", "qualificacao_representante"):
        values[f"desc_{name}_{slot}"] = F.col(f"desc_{name}_{slot}")
    values[f"desc_identificador_socio_{slot}"] = derive.partner_kind_label(F.col(f"identificador_socio_{slot}"))
    values[f"data_entrada_sociedade_{slot}"] = date(F.col(f"data_entrada_sociedade_{slot}"))
    return values


def target_values(as_of: dt.date, date: Callable[[Column], Column] = derive.parse_date) -> dict[str, Column]:
    """Those target columns that are not simply the joined column of the same name.

    ``date`` reads dates; :func:`firmroll.functions.dates.parse_date_any` takes other shapes than the feeds' own.
    """
    started = date(F.col("data_inicio_atividade"))
    mei, simples = F.col("opcao_mei"), F.col("opcao_simples")
    values = {
        "cnpj": derive.full_key(F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv")),
        "matriz_filial": F.col("identificador_matriz_filial"),
        "desc_matriz_filial": derive.branch_label(F.col("identificador_matriz_filial")),
        "desc_situacao_cadastral": derive.status_label(F.col("situacao_cadastral")),
        "cidade_exterior": F.col("nome_cidade_exterior"),
        "data_inicio_atividade": started,
        "cnae_principal": F.col("cnae_fiscal_principal"),
        "cnae_secundario": F.col("cnae_fiscal_secundaria"),
        "email": F.col("correio_eletronico"),
        "latitude": F.lit(None).cast("float"),
        "longitude": F.lit(None).cast("float"),
        "capital_social": derive.parse_capital(F.col("capital_social")),
        "desc_porte": derive.size_label(F.col("porte")),
        "tipo_simples_mei": derive.tax_regime(mei, simples),
        "porte_empresa": F.coalesce("porte_opt", "porte"),
        "desc_porteempresa_corrigido": derive.corrected_size(mei, F.col("porte")),
        "faixa_faturamento_anual_ajustada": derive.revenue_band(mei, F.col("porte")),
        "faixa_idade_empresa": derive.age_band(started, as_of),
        "regiao_geo": derive.macro_region(F.col("uf")),
        "uf_geo": derive.uf_label(F.col("uf")),
    }
    for name in (
        "data_situacao_cadastral", "data_situacao_especial", "data_opcao_simples", "data_exclusao_simples",
        "data_opcao_mei", "data_exclusao_mei",
    ):
        values[name] = date(F.col(name))
    for slot in PARTNER_SLOTS:
        values.update(_partner_values(slot, date))
    return values


def conform(df: DataFrame, values: Mapping[str, Column] | None = None) -> DataFrame:
    """Bring rows into the contract: names, order, types, and blanks where the contract has no NULL.

    The row number is left out if the input does not have it yet.
    """
    values = values or {}
    out = []
    for field in TARGET_SCHEMA:
        if field.name == ROW_NUMBER and ROW_NUMBER not in df.columns:
            continue
        value = values.get(field.name, F.col(field.name)).cast(field.dataType)
        if field.name != ROW_NUMBER and not field.nullable:
            value = F.coalesce(value, F.lit(""))
        out.append(value.alias(field.name))
    return df.select(out)


def enriched_rows(
    feeds: Feeds, lookups: Mapping[str, DataFrame], as_of: dt.date, hot: Hot | None = None,
    date: Callable[[Column], Column] = derive.parse_date,
) -> DataFrame:
    """The target without its row number. ``as_of`` is the day that ages are counted to, ``date`` reads dates."""
    return conform(joined(feeds, measured(lookups), hot), target_values(as_of, date))


def number_by_uf(rows: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Add ``linha_unica``: 1..n within each state, in the order of the company and establishment key.

    ``keys`` is a narrow scan with the key columns of ``rows``, by default ``rows``. Rows leave sorted by state label,
    if they have one, and key, as the published table stores them.
    """
    first = [PARTITION] if PARTITION in rows.columns else []
    return number_ranged(rows, rows if keys is None else keys, LAYOUT[:1], LAYOUT[1:], ROW_NUMBER, first)


def enrich(
    feeds: Feeds, lookups: Mapping[str, DataFrame], as_of: dt.date, hot: Hot | None = None,
    date: Callable[[Column], Column] = derive.parse_date,
) -> DataFrame:
    """The whole target, 96 columns. The wide rows are made once and move once after the joins."""
    keys = active_establishments(feeds.establishments).select(LAYOUT)
    return number_by_uf(enriched_rows(feeds, lookups, as_of, hot, date), keys).select(TARGET_SCHEMA.names)
