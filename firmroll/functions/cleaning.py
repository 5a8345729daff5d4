"""Field cleaning as built-in column expressions, so that it stays inside whole-stage code generation.

The order of the steps matters and is fixed in :func:`clean_field`. Character-set trims are used instead of regular
expressions wherever they mean the same, because they only look at the ends of a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmroll.fixed_values import (
    ACTIVITY_COLUMNS,
    BLANK_CHARACTERS,
    DATE_COLUMNS,
    DOCUMENT_CHARACTERS,
    FEED_COLUMNS,
    MONEY_COLUMNS,
    NAME_COLUMNS,
    NOT_ACTIVITY_PATTERN,
    VOID_DATES,
)


def strip_quotes(value: Column) -> Column:
    return F.replace(value, F.lit('"'), F.lit(""))


def strip_marks(value: Column) -> Column:
    """Remove double quotes and backslashes anywhere in the value."""
    return F.replace(strip_quotes(value), F.lit("\\"), F.lit(""))


def trim_blanks(value: Column) -> Column:
    """Trim every blank of the files' character set, no-break space included."""
    return F.trim(value, F.lit(BLANK_CHARACTERS))


def drop_trailing_document(value: Column) -> Column:
    """Drop a document number glued to the end of a name: the last run of digits, dots, slashes and dashes.

    A final full stop or a year is dropped too. The value must already be trimmed.
    """
    return trim_blanks(F.rtrim(value, F.lit(DOCUMENT_CHARACTERS)))


def void_date_to_blank(value: Column) -> Column:
    return F.when(value.isin(VOID_DATES), F.lit("")).otherwise(value)


def decimal_point(value: Column) -> Column:
    return F.replace(value, F.lit(","), F.lit("."))


def activity_digits(value: Column) -> Column:
    """Keep only digits and commas."""
    return F.regexp_replace(value, NOT_ACTIVITY_PATTERN, "")


def blank_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def clean_field(name: str, value: Column | None = None) -> Column:
    """The whole cleaning of one feed column, by its name; never NULL.

    NULL becomes blank first, so that no later step needs code for it: the projection of the widest feed then stays
    below the size up to which the JVM compiles a method.
    """
    out = trim_blanks(strip_marks(blank_if_null(F.col(name) if value is None else value)))
    if name in NAME_COLUMNS:
        out = drop_trailing_document(out)
    if name in DATE_COLUMNS:
        out = void_date_to_blank(out)
    if name in MONEY_COLUMNS:
        out = decimal_point(out)
    if name in ACTIVITY_COLUMNS:
        out = activity_digits(out)
    return out.alias(name)


def clean_feed(raw: DataFrame, feed: str) -> DataFrame:
    """Clean every column of a feed in one narrow projection."""
    return raw.select([clean_field(name) for name in FEED_COLUMNS[feed]])
