"""Reading and writing the registry's delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmroll.fixed_values import FEED_FILE_PREFIX, FEED_QUOTE, FIELD_SEPARATOR, FILE_ENCODING, NO_QUOTE
from firmroll.functions.cleaning import blank_if_null
from firmroll.sources.schemas import feed_schema

# What was done to a row of the wrong width, and the shard that it is in; NULL for all other rows.
REPAIR, REPAIRED_IN = "width_repair", "repaired_in"
PADDED, CUT = "padded", "cut"


def shard_glob(raw_root: str, period: str, feed: str) -> str:
    """All shards of one feed and month, e.g. ``<root>/2026-03/Empresas*.csv``."""
    return f"{raw_root.rstrip('/')}/{period}/{FEED_FILE_PREFIX[feed]}*.csv"


def read_raw(
    spark: SparkSession, feed: str, paths: str | Sequence[str], quote: str | None = None, line: str | None = None
) -> DataFrame:
    """Scan raw files without a header, by position.

    Lines stay splittable (no multi-line fields), so a file of any size is read in parallel. Short rows are padded
    with NULL and long rows cut. By default only the tax-status feed honours quotes; with quotes off, a separator
    inside quotes splits the field, as the files' own layout rules have it. Pass ``quote='"'`` to honour them.
    ``line`` names a column that has the whole line where a row was padded or cut, else NULL.
    """
    schema = feed_schema(feed)
    reader = spark.read
    if line:
        schema = T.StructType([*schema.fields, T.StructField(line, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", line)
    return (
        reader.schema(schema)
        .option("header", False)
        .option("sep", FIELD_SEPARATOR)
        .option("quote", FEED_QUOTE[feed] if quote is None else quote)
        .option("encoding", FILE_ENCODING)
        .option("mode", "PERMISSIVE")
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def width_repair(line: Column, feed: str, quote: str | None = None) -> Column:
    """``PADDED`` or ``CUT``, from the whole line of a row of the wrong width; NULL without one."""
    mark = FEED_QUOTE[feed] if quote is None else quote
    plain = line if mark == NO_QUOTE else F.regexp_replace(line, rf"{mark}(?:[^{mark}\\]|\\.)*{mark}", "")
    fields = F.length(plain) - F.length(F.replace(plain, F.lit(FIELD_SEPARATOR), F.lit(""))) + 1
    short = fields < len(feed_schema(feed))
    return F.when(line.isNotNull(), F.when(short, F.lit(PADDED)).otherwise(F.lit(CUT)))


def read_processed(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """Scan a normalised export (one header per part file); every missing field is blank."""
    loaded = (
        spark.read.schema(feed_schema(feed))
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", FIELD_SEPARATOR)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", FILE_ENCODING)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return loaded.select([blank_if_null(loaded[name]).alias(name) for name in loaded.columns])


def _one_line(name: str) -> Column:
    value = F.col(name)
    message = F.lit(f"a line break in {name}: the files hold one row per line")
    return F.when(value.rlike("[\r\n]"), F.raise_error(message)).otherwise(value).alias(name)


def write_processed(df: DataFrame, path: str, header: bool = True, quote: str = '"') -> None:
    """Export as ``;``-separated Latin-1, in as many part files as there are partitions.

    A field that holds the separator or a quote is quoted, with its quotes doubled; all others are written as they are.
    A line break fails the export, since readers split files at lines. ``NO_QUOTE`` writes every field as it is.
    """
    (
        df.select([_one_line(name) for name in df.columns])
        .write.mode("overwrite")
        .option("header", header)
        .option("sep", FIELD_SEPARATOR)
        .option("quote", quote)
        .option("escape", '"')
        .option("encoding", FILE_ENCODING)
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
