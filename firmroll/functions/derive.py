"""Derived columns: parsing, labels and bands."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmroll.fixed_values import (
    AGE_BANDS,
    BRANCH_LABELS,
    CORRECTED_SIZE_LABELS,
    DATE_FORMAT,
    MEI_REVENUE_BAND,
    MEI_SIZE_LABEL,
    OLDEST_AGE_BAND,
    PARTNER_KIND_LABELS,
    REGIME_MEI,
    REGIME_OTHER,
    REGIME_SIMPLES,
    REGION_UNKNOWN,
    REGIONS,
    REVENUE_BANDS,
    SIZE_LABELS,
    STATUS_LABELS,
    UF_UNKNOWN,
    YES,
)
from firmroll.functions.cleaning import decimal_point


def first_match(rules: Iterable[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds; a rule that is NULL does not hold."""
    chain = None
    for condition, label in rules:
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    return F.lit(default) if chain is None else chain.otherwise(default)


def label_of(code: Column, labels: Mapping[str, str], default: str = "") -> Column:
    return first_match([(code == key, label) for key, label in labels.items()], default)


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def full_key(base: Column, order: Column, check: Column) -> Column:
    return F.concat(base, order, check)


def parse_date(value: Column) -> Column:
    """Text date to a zone-free timestamp; anything that is not a real date gives NULL.

    The way leads over DATE, not over TIMESTAMP: a local midnight that a clock change skipped would move by an hour
    in sessions whose time zone is not UTC.
    """
    return F.try_to_date(blank_to_null(value), DATE_FORMAT).cast("timestamp_ntz")


def parse_capital(value: Column) -> Column:
    return blank_to_null(decimal_point(value)).try_cast("decimal(18,2)")


def branch_label(code: Column) -> Column:
    return label_of(code, BRANCH_LABELS)


def status_label(code: Column) -> Column:
    return label_of(code, STATUS_LABELS)


def size_label(code: Column) -> Column:
    return label_of(code, SIZE_LABELS)


def partner_kind_label(code: Column) -> Column:
    return label_of(code, PARTNER_KIND_LABELS)


def tax_regime(mei: Column, simples: Column) -> Column:
    return first_match([(mei == YES, REGIME_MEI), (simples == YES, REGIME_SIMPLES)], REGIME_OTHER)


def _unless_mei(mei: Column, mei_label: str, size: Column, labels: Mapping[str, str]) -> Column:
    return first_match([(mei == YES, mei_label)] + [(size == key, label) for key, label in labels.items()], "")


def corrected_size(mei: Column, size: Column) -> Column:
    return _unless_mei(mei, MEI_SIZE_LABEL, size, CORRECTED_SIZE_LABELS)


def revenue_band(mei: Column, size: Column) -> Column:
    return _unless_mei(mei, MEI_REVENUE_BAND, size, REVENUE_BANDS)


def age_band(start: Column, as_of: dt.date) -> Column:
    """Band of the number of year boundaries between ``start`` (a date or timestamp) and ``as_of``."""
    years = F.lit(as_of.year) - F.year(start)
    return first_match(
        [(years <= top, label) for top, label in AGE_BANDS] + [(start.isNotNull(), OLDEST_AGE_BAND)], ""
    )


def macro_region(uf: Column) -> Column:
    return first_match([(uf.isin(members), region) for region, members in REGIONS.items()], REGION_UNKNOWN)


def uf_label(uf: Column) -> Column:
    return F.when(uf != "", uf).otherwise(UF_UNKNOWN)
