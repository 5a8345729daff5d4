import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from firmroll.functions import derive
from firmroll.functions.dates import parse_date_any


def value(spark, column, *row):
    df = spark.createDataFrame([row], ", ".join(f"c{i} string" for i in range(len(row))))
    return df.select(column(*[F.col(name) for name in df.columns])).first()[0]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("20251231", dt.datetime(2025, 12, 31)),
        ("19660102", dt.datetime(1966, 1, 2)),
        ("20240229", dt.datetime(2024, 2, 29)),
        ("20230229", None),
        ("20251345", None),
        ("00000000", None),
        ("", None),
        (None, None),
        ("2025", None),
        ("x", None),
    ],
)
def test_parse_date(spark, text, expected):
    assert value(spark, derive.parse_date, text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("20251231", dt.datetime(2025, 12, 31)),
        ("20240229", dt.datetime(2024, 2, 29)),
        ("20230229", None),
        ("2024-1-5", dt.datetime(2024, 1, 5)),
        ("5/1/2024", dt.datetime(2024, 1, 5)),
        ("10/23/2024", dt.datetime(2024, 10, 23)),
        ("23.10.24", dt.datetime(2024, 10, 23)),
        ("1-2-70", dt.datetime(1970, 2, 1)),
        ("1-2-69", dt.datetime(2069, 2, 1)),
        ("2024/13/05", None),
        ("202402", dt.datetime(2024, 2, 1)),
        ("2024", dt.datetime(2024, 1, 1)),
        ("20240205101112", dt.datetime(2024, 2, 5, 10, 11, 12)),
        ("2024-02-05T10:11:12.345Z", dt.datetime(2024, 2, 5, 10, 11, 12)),
        ("2024-02-05 9:05", dt.datetime(2024, 2, 5, 9, 5)),
        ("5 Feb 2024", dt.datetime(2024, 2, 5)),
        ("Sat, 18 Aug 2018 07:22:16 GMT", dt.datetime(2018, 8, 18, 7, 22, 16)),
        ("February 5, 2024", dt.datetime(2024, 2, 5)),
        ("5 Anf 2024", None),
        ("1700000000", dt.datetime(2023, 11, 14, 22, 13, 20)),
        ("2024-02-05 25:00", None),
        ("2024-02-05 10:61:00", None),
        ("00000000", None),
        ("0", None),
        ("", None),
        (None, None),
        ("x", None),
        ("2024-02-05 x", None),
        (" 2024-02-05 ", dt.datetime(2024, 2, 5)),
    ],
)
def test_parse_date_any(spark, text, expected):
    assert value(spark, parse_date_any, text) == expected


def test_parse_date_keeps_a_midnight_that_a_clock_change_skipped(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert value(spark, derive.parse_date, "20181104") == dt.datetime(2018, 11, 4)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "text,expected",
    [
        ("1000,50", Decimal("1000.50")),
        ("1000.5", Decimal("1000.50")),
        ("1.235", Decimal("1.24")),
        ("-1", Decimal("-1.00")),
        ("1.000,50", None),
        ("n/d", None),
        ("99999999999999999", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_capital(spark, text, expected):
    assert value(spark, derive.parse_capital, text) == expected


@pytest.mark.parametrize(
    "start,band",
    [
        ("20260101", "0-2 ANOS"),
        ("20251231", "0-2 ANOS"),
        ("20240101", "0-2 ANOS"),
        ("20231231", "2-5 ANOS"),
        ("20210101", "2-5 ANOS"),
        ("20201231", "5-10 ANOS"),
        ("20160101", "5-10 ANOS"),
        ("20151231", "ACIMA DE 10 ANOS"),
        ("20990101", "0-2 ANOS"),
        ("", ""),
        ("20251345", ""),
    ],
)
def test_age_band_counts_year_boundaries(spark, start, band):
    as_of = dt.date(2026, 1, 1)
    assert value(spark, lambda c: derive.age_band(derive.parse_date(c), as_of), start) == band


@pytest.mark.parametrize(
    "function,code,label",
    [
        (derive.branch_label, "1", "Matriz"),
        (derive.branch_label, "2", "Filial"),
        (derive.branch_label, "", ""),
        (derive.branch_label, None, ""),
        (derive.status_label, "01", "Nula"),
        (derive.status_label, "03", "Suspensa"),
        (derive.status_label, "1", ""),
        (derive.size_label, "00", "Nao informado"),
        (derive.size_label, "02", ""),
        (derive.partner_kind_label, "3", "Estrangeiro"),
        (derive.partner_kind_label, "4", ""),
        (derive.macro_region, "SP", "Sudeste"),
        (derive.macro_region, "DF", "Centro-Oeste"),
        (derive.macro_region, "EX", "Exterior"),
        (derive.macro_region, "", "Nao Informado"),
        (derive.macro_region, "ZZ", "Nao Informado"),
        (derive.uf_label, "SP", "SP"),
        (derive.uf_label, "", "nao informado"),
    ],
)
def test_labels(spark, function, code, label):
    assert value(spark, function, code) == label


@pytest.mark.parametrize(
    "mei,simples,size,regime,corrected,revenue",
    [
        ("S", "S", "05", "MEI", "MICRO EMPRESA", "ATE R$ 81.000"),
        ("N", "S", "01", "SIMPLES", "ME - Microempresa", "ATE R$ 360.000"),
        ("", "N", "03", "OUTROS", "EPP - Empresa de Pequeno Porte", "R$ 360.000 A R$ 4.800.000"),
        (None, None, "05", "OUTROS", "Demais (Medio/Grande Porte)", "ACIMA DE R$ 4.800.000"),
        (None, None, "00", "OUTROS", "Nao se aplica", ""),
        (None, None, None, "OUTROS", "", ""),
    ],
)
def test_regime_and_bands(spark, mei, simples, size, regime, corrected, revenue):
    assert value(spark, lambda m, s, _: derive.tax_regime(m, s), mei, simples, size) == regime
    assert value(spark, lambda m, _, p: derive.corrected_size(m, p), mei, simples, size) == corrected
    assert value(spark, lambda m, _, p: derive.revenue_band(m, p), mei, simples, size) == revenue
