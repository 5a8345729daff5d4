"""Choosing the period to process from a listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How periods appear in a listing. Months are limited to 01-12.
PERIOD_AT_END = r"(\d{4}-(?:0[1-9]|1[0-2]))/?$"
PERIOD_IN_LINK = r'href="(\d{4}-(?:0[1-9]|1[0-2]))/"'
PERIOD_IN_TEXT = r">(\d{4}-(?:0[1-9]|1[0-2]))/<"


def latest_period(listing: DataFrame, path: str) -> DataFrame:
    """One row ``period``: the greatest month at the end of the listed paths, NULL if there is none."""
    found = F.nullif(F.regexp_extract(F.col(path), PERIOD_AT_END, 1), F.lit(""))
    return listing.agg(F.max(found).alias("period"))


def latest_period_in_pages(pages: DataFrame, text: str) -> DataFrame:
    """One row ``period``: the greatest month linked from the pages, else the greatest one shown as text.

    The fallback counts only if no page holds a link at all; both are found in one pass.
    """

    def greatest(pattern: str) -> Column:
        return F.max(F.array_max(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))))

    return pages.agg(F.coalesce(greatest(PERIOD_IN_LINK), greatest(PERIOD_IN_TEXT)).alias("period"))


def require_period(found: DataFrame) -> str:
    """The period of a one-row result; an empty listing is an error."""
    period = found.first()["period"]
    if period is None:
        raise ValueError("no period of the form YYYY-MM in the listing")
    return period


def compact_period(period: Column | str) -> Column | str:
    """``2026-03`` to ``202603``; takes a column or a plain string."""
    if isinstance(period, str):
        return period.replace("-", "")
    return F.replace(period, F.lit("-"), F.lit(""))
