"""Language identification by words first, and by ever shorter character n-grams for words that are not known.

Method: every language has relative frequencies of words and of the n-grams of 5 to 1 characters of its blank-padded
words. A word of a text that the model knows costs each language the negative logarithm of its frequency there, a
penalty where the language lacks it. For any other word the longest n-grams of which the model knows at least one are
taken, and the word costs the mean of those known; shorter ones are tried only if none is known. The language of the
least total cost wins. Costs are whole thousandths, so sums do not depend on their order.

What is learned is bounded: at most ``LANGUAGES`` labels (the most frequent), a sample of ``FIT_ROWS`` labelled rows dealt
evenly to them (all rows of a label that has no more), and of each table of a language only the entries with at least a
share of 1/V, of which there can be no more than V; V is such that all tables together have ``MODEL_ENTRIES`` at most.
Counting is map-side combined and summed by Spark; prediction is one pass over the texts in which nothing moves.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmroll.llm.common import stored

LANGUAGES = 256
FIT_ROWS = 8_000
MODEL_ENTRIES = 400_000
LONGEST = 5
UNIT = 1000  # of natural logarithms
UNKNOWN = 2 * UNIT  # what a missing entry costs beyond the rarest one
UNDETERMINED = "und"
WORD = r"\p{L}[\p{L}\p{M}]*"
_WORD, _REST = regex.compile(WORD), regex.compile(r"[\p{L}\p{M}]*")
_CHUNK, _FLUSH, _CELLS = 1 << 20, 200_000, 1 << 19


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-cased words in lists of a bounded size; a word is never cut."""
    at = 0
    while at < len(text):
        end = min(at + _CHUNK, len(text))
        if end < len(text):
            end = _REST.match(text, end).end()
        yield _WORD.findall(text[at:end].lower())
        at = end


def counted(text: str) -> Counter[str]:
    words: Counter[str] = Counter()
    for some in words_of(text):
        words.update(some)
    return words


def grams(word: str, size: int) -> list[str]:
    """n-grams of the word between two blanks; a blank alone is none."""
    padded = f" {word} " if size > 1 else word
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


def remainder() -> Column:
    """crc32 of the doc_id as text, modulo 4; NULL for a null doc_id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, size, gram, n); size 0 stands for whole words."""
    words: dict[str, Counter[str]] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for lang, found in words.items():
            tables: list[dict[str, int]] = [found] + [{} for _ in range(LONGEST)]
            for word, n in found.items():
                for size in range(1, LONGEST + 1):
                    table = tables[size]
                    for gram in grams(word, size):
                        table[gram] = table.get(gram, 0) + n
            for size, table in enumerate(tables):
                constant = pa.array([lang] * len(table), pa.string()), pa.array([size] * len(table), pa.int32())
                arrays = [*constant, pa.array(table.keys(), pa.string()), pa.array(table.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "size", "gram", "n"])
        words.clear()

    for batch in batches:
        for row in range(batch.num_rows):  # one text at a time: a batch may hold many megabytes
            own = words.setdefault(batch.column("lang")[row].as_py(), Counter())
            for some in words_of(batch.column("text")[row].as_py()):
                own.update(some)
                if sum(map(len, words.values())) > _FLUSH:
                    yield from flushed()
                    own = words.setdefault(batch.column("lang")[row].as_py(), Counter())
    yield from flushed()


class Model:
    """Costs of words (table 0) and n-grams (tables 1 to ``LONGEST``) per language."""

    def __init__(self, languages: list[str], tables: list[dict[str, int]], costs: list[np.ndarray]) -> None:
        self.languages, self.tables, self.costs = languages, tables, costs
        self.seen: dict[str, int] = {}
        self.vectors = np.empty((_CELLS // max(1, len(languages)), len(languages)), np.int64)

    def cost(self, word: str) -> np.ndarray:
        """What a word costs each language; nothing if the model knows not even its letters."""
        row = self.tables[0].get(word)
        if row is not None:
            return self.costs[0][row]
        for size in range(LONGEST, 0, -1):
            known = [i for g in grams(word, size) if (i := self.tables[size].get(g)) is not None]
            if known:
                return self.costs[size][known].sum(axis=0) // len(known)
        return np.zeros(len(self.languages), np.int64)

    def totals(self, texts: list[Counter[str]]) -> np.ndarray:
        """Costs of texts, texts x languages. The vectors of words met are kept, up to a bounded number."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        seen, vectors = self.seen, self.vectors
        for i, words in enumerate(texts):
            listed = list(words.items())
            for at in range(0, len(listed), len(vectors)):
                part = dict(listed[at : at + len(vectors)])
                new = [word for word in part if word not in seen]
                if len(seen) + len(new) > len(vectors):
                    seen.clear()
                    new = list(part)
                for word in new:
                    vectors[len(seen)] = self.cost(word)
                    seen[word] = len(seen)
                rows = np.fromiter(map(seen.__getitem__, part), np.int64, len(part))
                out[i] += np.fromiter(part.values(), np.int64, len(part)) @ vectors[rows]
        return out


def fit(
    docs: DataFrame, languages: int = LANGUAGES, fit_rows: int = FIT_ROWS, entries: int = MODEL_ENTRIES
) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text, lang) that have a lang, a text, and a remainder that is not 2."""
    known = docs.where((remainder() != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    names = sorted(r["lang"] for r in sizes)
    if not names:
        return Model([], [{} for _ in range(LONGEST + 1)], [np.zeros((0, 0), np.int64)] * (LONGEST + 1))
    quota = max(1, fit_rows // len(names))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, quota / r["n"]))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.where(place < share[F.col("lang")]).select("lang", "text")
    each = sample.mapInArrow(_count, "lang string, size int, gram string, n long")
    counts = stored(each.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")), "gram-counts")
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    most = max(1, entries // (len(names) * (LONGEST + 1)))
    # At most ``entries`` rows: no more than ``most`` of a table have a share of 1/most.
    rows = counts.join(totals, ["lang", "size"]).where(F.col("n") * most >= F.col("total")).collect()
    tables: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    for r in sorted(rows, key=lambda r: (r["size"], r["gram"])):
        tables[r["size"]].setdefault(r["gram"], len(tables[r["size"]]))
    missing = round(UNIT * math.log(most)) + UNKNOWN
    costs = [np.full((len(table), len(names)), missing, np.int64) for table in tables]
    number = {name: i for i, name in enumerate(names)}
    for r in rows:
        size = r["size"]
        costs[size][tables[size][r["gram"]], number[r["lang"]]] = round(-UNIT * math.log(r["n"] / r["total"]))
    return Model(names, tables, costs)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """docs (doc_id, held_out, text) -> doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.tables, model.costs))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            texts = (t.as_py() for t in batch.column("text"))  # one text at a time
            words = [counted(t or "") for t in texts]
            names, scores = [], []
            for found, total in zip(words, own.totals(words), strict=True):
                if found and own.languages:
                    best = int(total.argmin())
                    names.append(own.languages[best])
                    scores.append(round(float(1 / np.exp((total[best] - total) / UNIT).sum()), 6))
                else:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
            arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    return docs.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, **how: int) -> DataFrame:
    """Language of every row: doc_id, held_out, lang_pred, score.

    The score is the posterior probability of the language among those learned, with equal priors and independent words.
    A null text and one without a letter are ``und`` with score 0, as is everything if nothing was learned; a text whose
    words are all unknown down to their letters gets the first label by name. Equal costs go to the first label too.
    A null doc_id is neither held out nor learned from. Texts of any length are read whole, in chunks. Repeated rows are
    predicted each; an empty table gives an empty result; lang only teaches, and other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang")
    model = fit(rows, **how)
    held_out = F.coalesce(remainder() == 2, F.lit(False)).alias("held_out")
    return stored(predicted(rows.select("doc_id", held_out, "text"), model), "languages")
