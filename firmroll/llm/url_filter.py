"""URL filter: host and path rules first, a weighted vocabulary for the rest.

Method: an Aho-Corasick automaton finds all strict and soft terms in one pass over the url. A hit counts only if no
ASCII letter or digit touches it on either side. One strict hit, or several distinct soft ones whose weights reach a sum,
rejects a page. The vocabulary may be a table, see :func:`vocabulary`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmroll.llm.common import LOWER, UPPER, free_name

# Fixed values: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# The default vocabulary, a small one; production lists come from a table.
STRICT_TERMS = ("porn", "xxx", "hentai", "viagra", "warez", "escort")
SOFT_TERMS = ("sex", "adult", "casino", "bet", "poker", "pills", "loan", "nude", "dating", "free")
SOFT_NEEDED = 2
SOFT_DISTINCT = 2
# The automaton is in every Python worker: some 0.1 KB a term.
MAX_TERMS = 200_000

_LOWER = str.maketrans(UPPER, LOWER)
_WORD = frozenset(LOWER + "0123456789")


@dataclass(frozen=True)
class UrlFilter:
    """Rules and vocabulary. Terms are lower-case ASCII; a term in both lists is strict.

    Soft terms weigh what ``weights`` says, or 1. Soft hits reject if at least ``soft_distinct`` different terms weigh
    ``soft_needed`` or more together.
    """

    rules: Sequence[tuple[str, str, str]] = RULES
    strict: Sequence[str] = STRICT_TERMS
    soft: Sequence[str] = SOFT_TERMS
    soft_needed: int = SOFT_NEEDED
    soft_distinct: int = SOFT_DISTINCT
    weights: Sequence[tuple[str, int]] = ()

    def __post_init__(self) -> None:
        for name in ("rules", "strict", "soft", "weights"):
            object.__setattr__(self, name, tuple(getattr(self, name)))

    def soft_weights(self) -> dict[str, int]:
        weights = dict(self.weights)
        return {term: weights.get(term, 1) for term in set(self.soft) - set(self.strict)}

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term in {*self.strict, *self.soft} - {""}:
            found.add_word(term, term)
        if len(found):
            found.make_automaton()
        return found

    def by_host(self) -> dict[str, list[tuple[int, str, str, str]]]:
        """host -> its rules as (length, path, rule, verdict)."""
        hosts: dict[str, list[tuple[int, str, str, str]]] = {}
        for host, path, verdict in self.rules:
            hosts.setdefault(host, []).append((len(host) + len(path), path, host + path, verdict))
        return hosts


def vocabulary(terms: DataFrame, max_terms: int = MAX_TERMS, **settings: object) -> UrlFilter:
    """A filter with the terms of a table (term, kind, weight): kind ``strict`` or ``soft``, a whole weight (null: 1).

    Letters A-Z are lower-cased. Of repeated terms the largest weight counts, and strict wins; null and empty terms are
    passed over. A table of more than ``max_terms`` different terms is refused, as each worker holds them all.
    """
    term = F.translate("term", UPPER, LOWER).alias("term")
    known = terms.select(term, "kind", "weight").where((F.col("term") != "") & F.col("kind").isin("strict", "soft"))
    rows = known.groupBy("term").agg(
        F.max((F.col("kind") == "strict").cast("int")).alias("strict"),
        F.max(F.coalesce(F.col("weight").cast("long"), F.lit(1))).alias("weight"),
    ).limit(max_terms + 1).collect()
    if len(rows) > max_terms:
        raise ValueError(f"the vocabulary has more than {max_terms} terms")
    rows.sort()
    soft = [(r["term"], r["weight"]) for r in rows if not r["strict"]]
    return UrlFilter(
        strict=[r["term"] for r in rows if r["strict"]], soft=[term for term, _ in soft], weights=soft, **settings
    )


@lru_cache(maxsize=4)
def _prepared(settings: UrlFilter) -> tuple[ahocorasick.Automaton, dict, frozenset, dict[str, int]]:
    """Built once in a Python worker, which Spark uses for many tasks."""
    return settings.automaton(), settings.by_host(), frozenset(settings.strict), settings.soft_weights()


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty for a null or without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in (rest.find(c) for c in "?#") if i >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    return (rest.translate(_LOWER), "") if slash < 0 else (rest[:slash].translate(_LOWER), rest[slash:])


def _judge_host(hosts: dict, host: str, path: str) -> tuple[int, str, str] | None:
    """The longest rule that fits a host or a domain above it."""
    best, start = None, 0
    while True:
        for length, prefix, rule, verdict in hosts.get(host[start:], ()):
            if path.startswith(prefix) and (best is None or length > best[0]):
                best = (length, rule, verdict)
        dot = host.find(".", start)
        if dot < 0:
            return best
        start = dot + 1


def _hits(automaton: ahocorasick.Automaton, url: str) -> set[str]:
    if not len(automaton):
        return set()
    text, found = url.translate(_LOWER), set()
    for last, term in automaton.iter(text):
        first = last - len(term) + 1
        if (first == 0 or text[first - 1] not in _WORD) and (last + 1 == len(text) or text[last + 1] not in _WORD):
            found.add(term)
    return found


def judge_urls(
    pages: DataFrame, url: str = "url", settings: UrlFilter | None = None, out: str = "judged"
) -> DataFrame:
    """Add struct ``out`` (host, path, rule, verdict, n_strict, n_soft, soft_weight) to every row; nothing is shuffled.

    A null or empty url has an empty host and path, no rule and no hit, and is allowed. A very long url is read whole,
    in one pass. Repeated rows are judged alike; an empty table gives an empty result. A column that is named like ``out`` already is replaced.
    """
    settings = settings or UrlFilter()
    names = ["host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight"]

    @F.pandas_udf("host string, path string, rule string, verdict string, n_strict long, n_soft long, soft_weight long")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton, hosts, strict, weights = _prepared(settings)
        for urls in batches:
            rows = []
            for value in urls:
                host, path = split_url(value)
                hits = _hits(automaton, value or "")
                soft = hits - strict
                weight = sum(weights[term] for term in soft)
                bad = len(soft) < len(hits) or (len(soft) >= settings.soft_distinct and weight >= settings.soft_needed)
                ruled = _judge_host(hosts, host, path)
                rule, verdict = ruled[1:] if ruled else (None, "block" if bad else "allow")
                rows.append((host, path, rule, verdict, len(hits) - len(soft), len(soft), weight))
            yield pd.DataFrame(rows, columns=names)

    return pages.withColumn(out, judge(F.col(url)))


def allowed_pages(pages: DataFrame, url: str = "url", settings: UrlFilter | None = None) -> DataFrame:
    """The rows of ``pages`` that are not blocked, with their own columns."""
    out = free_name(pages, "judged")
    judged = judge_urls(pages, url, settings, out)
    return judged.where(F.col(f"{out}.verdict") == "allow").select(pages.columns)
