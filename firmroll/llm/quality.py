"""Quality rules with thresholds that adapt to language and source.

Method: every document gets a few integer ratios. Per language and source, each ratio is summarised by a mergeable
quantile sketch: a histogram whose bins keep the five highest binary digits of a value, so that a quantile is at most
1/32 too low. Sketches merge by adding counts, in any order and with the same result. A ratio beyond the outer fence of
its group (three interquartile ranges past the quartile, or a minimal slack where the group hardly varies) rejects a
document; groups with few documents use the merged sketch of their language, or of everything. Thresholds are joined
back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmroll.llm.common import BLANKS, free_name, stored, text_or_empty

# Fixed values of the base rule.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

# Repeated words have no fence: the slack that clean documents need lies beyond the base rule's own bound.
# Parameters of the method: ratio -> (least distance of the lower fence, of the upper fence); None: no fence.
FENCES: dict[str, tuple[int | None, int | None]] = {
    "word_length": (400, 400),  # hundredths of a character
    "symbols": (None, 80),  # per thousand words
    "dup_lines": (None, 400),  # per thousand lines
    "capitals": (None, 200),  # per thousand characters in words
}
SPREADS = 3
MIN_GROUP = 200
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_lines", "n_capitals"]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more, the first time included.

    Words, then ever longer windows, get whole numbers as names, equal for equal contents, so a text of any length takes
    a few arrays of 8 bytes a word, and no two windows are mistaken for each other.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    names = np.fromiter((known.setdefault(word, len(known)) for word in words), np.int64, len(words))
    count, grams, bound = len(known), names, len(known)
    if count == len(words):
        return 0
    for length in range(2, window + 1):
        if bound * count >= 1 << 62:
            different, grams = np.unique(grams, return_inverse=True)
            bound = len(different)
        grams = grams[:-1] * count + names[length - 1 :]
        bound *= count
    order = np.argsort(grams, kind="stable")
    same = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if not len(same):
        return 0
    twice = np.zeros(n, bool)
    twice[order[same]] = twice[order[same + 1]] = True
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : i + n] |= twice
    return int(covered.sum())


def measures(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word), n_capitals."""
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the six ASCII blanks
    seen, lines, repeated = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            repeated += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        repeated,
        repeated_words(words),
        lines,
        len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    )


def measured(docs: DataFrame, name: str = "m") -> DataFrame:
    """Add a struct of the counts of :func:`measures`; a null text counts as empty."""

    @F.pandas_udf(", ".join(f"{count} long" for count in COUNTS))
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([measures(x) for x in texts], columns=COUNTS)

    return docs.withColumn(name, measure(text_or_empty()))


def ratios(m: str = "m") -> dict[str, Column]:
    """The ratios as whole numbers; 0 for a text without words."""

    def per(part: Column | str, whole: str, scale: int) -> Column:
        part = F.col(f"{m}.{part}") if isinstance(part, str) else part
        return F.expr(f"if(`{m}`.{whole} = 0, 0L, 1L)") * F.floor(
            scale * part / F.greatest(F.col(f"{m}.{whole}"), F.lit(1))
        ).cast("long")

    return {
        "word_length": per("word_chars", "n_words", 100),
        "symbols": per("n_symbols", "n_words", 1000),
        "dup_lines": per("n_dup_lines", "n_lines", 1000),
        "capitals": per("n_capitals", "word_chars", 1000),
    }


def sketches(docs: DataFrame, m: str = "m") -> DataFrame:
    """Sketch per language, source and ratio, as rows (lang, source, ratio, bin, n). Null names count as empty."""
    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("ratio"), v.alias("v")) for k, v in ratios(m).items()])
        ).alias("r"),
    ).select("lang", "source", "r.ratio", "r.v")
    return rows.groupBy(
        "lang", "source", "ratio", F.expr("v - v % shiftleft(1L, greatest(length(bin(v)) - 5, 0))").alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Merge sketches to a coarser level by adding their counts."""
    return sketch.groupBy(*by, "ratio", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """Quartiles and outer fences per group and ratio, with the number of documents."""
    group = Window.partitionBy(*by, "ratio")
    ranked = sketch.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
    quartiles = ranked.groupBy(*by, "ratio").agg(
        F.max("all").alias("docs"),
        F.min(F.when(F.col("upto") * 4 >= F.col("all"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("all") * 3, F.col("bin"))).alias("q3"),
    )

    def slack(side: int) -> Column:
        return F.coalesce(*[F.when(F.col("ratio") == k, F.lit(v[side])) for k, v in FENCES.items()])

    spread = SPREADS * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        *by, "ratio", "docs",
        (F.col("q1") - F.greatest(spread, slack(0)) * F.when(slack(0).isNotNull(), 1)).cast("long").alias("low"),
        (F.col("q3") + F.greatest(spread, slack(1))).cast("long").alias("high"),
    )


def thresholds(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per language and source with the columns ``low_<ratio>`` and ``high_<ratio>``."""
    own = fences(sketch, "lang", "source")
    wide = fences(merged(sketch, "lang"), "lang").select(
        "lang", "ratio", *[F.col(c).alias(f"lang_{c}") for c in ("docs", "low", "high")]
    )
    most = fences(merged(sketch)).select("ratio", *[F.col(c).alias(f"all_{c}") for c in ("low", "high")])
    rows = own.join(wide, ["lang", "ratio"]).join(most, "ratio")

    def chosen(side: str) -> Column:
        return (
            F.when(F.col("docs") >= min_group, F.col(side))
            .when(F.col("lang_docs") >= min_group, F.col(f"lang_{side}"))
            .otherwise(F.col(f"all_{side}"))
        )

    return rows.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("ratio") == k, chosen(side))).alias(f"{side}_{k}") for k in FENCES for side in ("low", "high")]
    )


def base_failed(m: str = "m") -> Column:
    words, repeated = F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def judged(docs: DataFrame, limits: DataFrame, m: str = "m", out: str = "kept") -> DataFrame:
    """Join the thresholds and add ``out``: neither the base rule nor a fence rejects the document.

    ``limits`` has one row per language and source. Written tables have a known size, so Spark broadcasts a small one;
    beyond its limit adaptive execution splits the sources that hold many documents.
    """
    names = {name: free_name(docs, f"limit_{name}") for name in limits.columns}
    limits = limits.select(*[F.col(name).alias(free) for name, free in names.items()])
    rows = docs.join(
        limits,
        (F.coalesce(docs["lang"], F.lit("")) == F.col(names["lang"]))
        & (F.coalesce(docs["source"], F.lit("")) == F.col(names["source"])),
        "left",
    )
    fine = ~base_failed(m)
    for name, value in ratios(m).items():
        low, high = (F.col(names[f"{side}_{name}"]) for side in ("low", "high"))
        for bound, wrong in zip(FENCES[name], (value < low, value > high), strict=True):
            if bound is not None:
                fine = fine & ~F.coalesce(wrong, F.lit(False))
    return rows.select(*docs.columns, fine.alias(out))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Verdict for every row: doc_id, the base counts, base_failed and kept.

    Texts are read once; the narrow counts are stored, sketched and joined with the thresholds. A null or empty text
    has no words and fails the base rule; repeated rows are judged alike; a very long text is measured whole
    in one task; an empty table gives an empty result; other columns are ignored.
    """
    counts = stored(measured(docs.select("doc_id", "lang", "source", "text")).drop("text"), "quality")
    limits = stored(thresholds(sketches(counts)), "thresholds")
    rows = judged(counts, limits)
    return rows.select(
        "doc_id", *[F.col(f"m.{name}") for name in BASE], base_failed().alias("base_failed"), "kept"
    )


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns. Texts do not move: the counts are made in place.

    A null or empty text fails; repeated rows pass or fail alike; a very long text is measured whole in one task; an
    empty table gives an empty result.
    """
    m = free_name(docs, "m")
    kept = free_name(docs, "kept")
    counts = measured(docs.select("lang", "source", "text"), m)
    limits = stored(thresholds(sketches(counts, m)), "thresholds")
    return judged(measured(docs, m), limits, m, kept).where(F.col(kept)).select(docs.columns)
