"""Explicit schemas: raw feeds are all text, the published table is typed."""

from __future__ import annotations

from pyspark.sql import types as T

from firmroll.fixed_values import (
    ESTABLISHMENT_AND_COMPANY_COLUMNS,
    FEED_COLUMNS,
    NULLABLE_TEXT_COLUMNS,
    PARTNER_COLUMNS,
    PARTNER_SLOTS,
    REGIME_AND_BAND_COLUMNS,
)


def feed_schema(feed: str) -> T.StructType:
    """All-text schema of a raw feed; the files carry no header, so position decides."""
    if feed not in FEED_COLUMNS:
        raise ValueError(f"unknown feed {feed!r}; expected one of {sorted(FEED_COLUMNS)}")
    return T.StructType([T.StructField(name, T.StringType()) for name in FEED_COLUMNS[feed]])


def _target_field(name: str) -> T.StructField:
    if name.startswith("data_"):
        return T.StructField(name, T.TimestampNTZType(), True)
    if name in ("latitude", "longitude"):
        return T.StructField(name, T.FloatType(), True)
    if name == "capital_social":
        return T.StructField(name, T.DecimalType(18, 2), True)
    if name == "linha_unica":
        return T.StructField(name, T.LongType(), False)
    return T.StructField(name, T.StringType(), name in NULLABLE_TEXT_COLUMNS)


TARGET_COLUMNS = (
    ESTABLISHMENT_AND_COMPANY_COLUMNS
    + [f"{name}_{slot}" for slot in PARTNER_SLOTS for name in PARTNER_COLUMNS]
    + REGIME_AND_BAND_COLUMNS
)

TARGET_SCHEMA = T.StructType([_target_field(name) for name in TARGET_COLUMNS])
