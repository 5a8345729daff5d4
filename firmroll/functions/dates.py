"""Dates in any common shape.

A value's shape, its text with every digit replaced by one mark, tells where year, month, day and time stand. So each
value goes to the one parser of its shape: no format is tried after another, and all of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Y year, M month, D day; numbers are written in full here, a single digit in a value counts as such with a zero.
DATE_SHAPES = (
    "YYYYMMDD", "YYYY-MM-DD", "YYYY/MM/DD", "YYYY.MM.DD", "DD/MM/YYYY", "DD-MM-YYYY", "DD.MM.YYYY",
    "DD/MM/YY", "DD-MM-YY", "DD.MM.YY", "YYYY-MM", "YYYY/MM", "YYYYMM", "YYYY",
)
TIME_SHAPES = ("hh:mm:ss", "hh:mm")
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
TWO_DIGIT_YEARS_FROM = 1970
_NAMED = r"(?i)^0?(\d{1,2})[ -]([a-z]{3})[a-z]*\.?,?[ -](\d{4})$"
_NAME_FIRST = r"(?i)^([a-z]{3})[a-z]*\.? 0?(\d{1,2}),? (\d{4})$"


def _number(text: Column, shape: str, mark: str) -> Column:
    """The number under a mark of the shape; 1 for a month or day and 0 for a part of the time that it has not."""
    if mark not in shape:
        return F.lit(1 if mark in "MD" else 0)
    return F.substring(text, shape.index(mark) + 1, shape.count(mark)).try_cast("int")


def _marked(shape: str) -> str:
    return "".join("9" if c.isalpha() else c for c in shape)


def _date(year: Column, month: Column, day: Column) -> Column:
    """A real date or NULL. The first of two numbers is the day, unless the second one can only be that."""
    swapped = (month > 12) & (day <= 12)
    return F.try_make_timestamp_ntz(
        year, F.when(swapped, day).otherwise(month), F.when(swapped, month).otherwise(day), F.lit(0), F.lit(0), F.lit(0)
    )


def _by_shape(text: Column) -> Column:
    marked = F.regexp_replace(text, "[0-9]", "9")
    chain = None
    for shape in DATE_SHAPES:
        year = _number(text, shape, "Y")
        if "YYYY" not in shape:
            year = year + F.when(year + 1900 >= TWO_DIGIT_YEARS_FROM, 1900).otherwise(2000)
        month, day = _number(text, shape, "M"), _number(text, shape, "D")
        if shape.startswith("D"):
            date = _date(year, month, day)
        else:
            date = F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0))
        found = marked == _marked(shape)
        chain = F.when(found, date) if chain is None else chain.when(found, date)
    return chain


def _by_name(text: Column) -> Column:
    """``15 Jan 2003``, ``15-January-2003``, ``Jan 15, 2003``."""
    day_first = F.regexp_extract(text, _NAMED, 1) != ""
    day = F.when(day_first, F.regexp_extract(text, _NAMED, 1)).otherwise(F.regexp_extract(text, _NAME_FIRST, 2))
    name = F.when(day_first, F.regexp_extract(text, _NAMED, 2)).otherwise(F.regexp_extract(text, _NAME_FIRST, 1))
    year = F.when(day_first, F.regexp_extract(text, _NAMED, 3)).otherwise(F.regexp_extract(text, _NAME_FIRST, 3))
    at = F.instr(F.lit(MONTHS), F.lower(name))
    month = F.when((name != "") & (at % 3 == 1), ((at + 2) / 3).cast("int"))
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(year.try_cast("int"), month, day.try_cast("int"), zero, zero, zero)


def _seconds(text: Column) -> Column:
    """Seconds of a time of day; 0 if there is none, NULL if it is not one."""
    text = F.regexp_replace(text, r"(\.\d+)?\s*(Z|z|UTC|GMT)?$", "")
    marked = F.regexp_replace(text, "[0-9]", "9")
    chain = F.when(text == "", 0)
    for shape in TIME_SHAPES:
        hour, minute, second = (_number(text, shape, mark) for mark in "hms")
        real = (hour < 24) & (minute < 60) & (second < 60)
        chain = chain.when((marked == _marked(shape)) & real, hour * 3600 + minute * 60 + second)
    return chain


def parse_date_any(value: Column) -> Column:
    """Text in any of the shapes above to a zone-free timestamp; whatever is not a real date gives NULL.

    A time may follow after a blank or a T, with fractions, which are cut, and with Z, UTC or GMT: times are kept as
    written. ``YYYYMMDDhhmmss`` and nine or ten digits, seconds since 1970, are read too. Between two digits and two
    digits the first is the day, unless the other one is above 12. Two-digit years lie between 1970 and 2069.
    """
    text = F.trim(value)
    text = F.regexp_replace(text, r"^(?i)(mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +", "")
    text = F.regexp_replace(text, r"(?<![0-9.])([0-9])(?![0-9])", "0$1")
    compact = F.regexp_replace(text, r"^([0-9]{8})([0-9]{2})([0-9]{2})([0-9]{2})$", "$1 $2:$3:$4")
    time = r"^(.*[0-9])(?:[Tt]|,? +)([0-9]{2}:[0-9]{2}.*)$"
    has_time = compact.rlike(time)
    date_text = F.when(has_time, F.regexp_extract(compact, time, 1)).otherwise(compact)
    time_text = F.when(has_time, F.regexp_extract(compact, time, 2)).otherwise(F.lit(""))
    date = F.coalesce(_by_shape(date_text), _by_name(date_text))
    since = F.when(text.rlike("^[0-9]{9,10}$"), text.try_cast("long"))
    start = F.when(since.isNotNull(), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).otherwise(date)
    seconds = F.coalesce(since, _seconds(time_text))
    return start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
