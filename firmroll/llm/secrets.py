"""Secret scan: fixed patterns, and a battery of randomness tests for strings that no pattern knows.

Method: every run of at least ``MIN_LENGTH`` token characters outside the base spans is a candidate. '=' only pads its
end: a run is cut at any other, so that the value of NAME=value is tested by itself. A part that mixes '+' or '/' with
'_' or '-' fits no alphabet; its longest runs without the ones, without the others and without both are candidates
instead, and of discoveries that lie within each other the longest counts. A candidate's encoding is inferred from the
characters it has. Under "uniform over that alphabet" three tests are made: chi-squared on the
symbols' counts, a runs test on the halves of the alphabet, and lag-1 serial correlation; Fisher's method combines them,
and a candidate that they reject is no secret. Whether the rest are secrets is tested against "written by people": how
much likelier the characters are under the uniform alphabet than in ordinary writing, where letters have very unequal
shares and upper case, lower case, digits and separators follow their own kind. That the ratio exceeds some value by
chance has at most its inverse as probability, whatever the length, so it serves as evidence, and grows with length.
Benjamini-Hochberg controls the false discoveries over all different candidates of the corpus, in each length class
(powers of two) on its own, so that the many short ones cannot crowd out the few long ones.

Everything is DataFrame and SQL functions, row by row: texts never move. For false-discovery control the evidence is
kept in tenths of a decimal exponent, so the corpus is summarised by counts per (length class, tenth), and one limit
per class is applied to the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmroll.llm.common import LOWER, UPPER, free_name, stored, text_or_empty

# Kind -> (pattern, group, least length of the group). Leftmost, non-overlapping.
PATTERNS = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
    ),
    "access": ("AKIA[A-Z0-9]+", 0, 18),
    # Runs of these characters are maximal, so a shorter one can be passed over by the pattern itself.
    "hex": ("[0-9a-f]{16,}", 0, 16),
}
KINDS = list(PATTERNS)
RANDOM = "random"

# Parameters of the method.
MIN_LENGTH = 20
TOKEN = f"[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}"
# Maximal runs without '=', and the '=' that end a whole token.
RUN = f"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}(?:=+(?![A-Za-z0-9+/_=-]))?"
FALSE_DISCOVERIES = 0.01
LEAST_RANDOM = 0.001
# Encodings in the order they are tried: name, pattern, alphabet.
DIGITS = "0123456789"
ENCODINGS = (
    ("hex_upper", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("lower", "^[a-z]+$", LOWER),
    ("upper", "^[A-Z]+$", UPPER),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("lower_alnum", "^[a-z0-9]+$", LOWER + DIGITS),
    ("letters", "^[A-Za-z]+$", UPPER + LOWER),
    ("alnum", "^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("base64", "^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "_-"),
)
# Ordinary writing: shares of the letters a to z in European languages, per mille, none taken below 8; chances that a
# character of the row's kind is followed by one of the column's (upper case, lower case, digit, separator).
LETTERS = (85, 13, 32, 42, 135, 12, 16, 28, 75, 8, 8, 45, 28, 80, 62, 24, 8, 66, 70, 66, 45, 12, 9, 8, 8, 8)
FOLLOWS = ((0.30, 0.60, 0.05, 0.05), (0.04, 0.86, 0.03, 0.07), (0.05, 0.07, 0.80, 0.08), (0.20, 0.55, 0.20, 0.05))
SYMBOLS = (UPPER, LOWER, DIGITS, "+/_-")
MASK = "<SECRET>"


def exponent(chance: float) -> int:
    """Thousandths of a decimal exponent: whole numbers add up to the same sum in any order."""
    return round(-1000 * math.log10(chance))


def written() -> tuple[list[int], list[int]]:
    """Exponents of each symbol within its kind, in the order of ``SYMBOLS``, and of each pair of kinds."""
    letters = [exponent(share / sum(LETTERS)) for share in LETTERS]
    alone = [*letters, *letters, *[exponent(1 / 10)] * 10, *[exponent(1 / 4)] * 4]
    return alone, [exponent(chance) for row in FOLLOWS for chance in row]


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def running(values: str, step: str) -> str:
    """SQL: running results of ``step`` (of ``top`` and ``v``) over an array of bigint, which are not negative.

    Appending to an array copies it, so it is done in blocks of as many elements as there are blocks.
    """
    none = "cast(array() as array<bigint>)"
    block = (
        "aggregate(slice(x, k * b + 1, b), struct(s.top as top, cast(array() as array<bigint>) as part), (u, v) ->"
        f" {_let('o', step.replace('top', 'u.top'), 'struct(o as top, array_append(u.part, o) as part)')})"
    )
    blocks = (
        "aggregate(sequence(0, cast((size(x) - 1) div b as int)),"
        " struct(0L as top, cast(array() as array<array<bigint>>) as done),"
        f" (s, k) -> {_let('p', block, 'struct(p.top as top, array_append(s.done, p.part) as done)')}, s -> flatten(s.done))"
    )
    return _let("x", values, f"if(size(x) = 0, {none}, {_let('b', 'cast(ceil(sqrt(size(x))) as int)', blocks)})")


def positions(text: str, pattern: str, found: str, length: str = "length") -> str:
    """SQL: (start, end) of the matches ``found`` of ``pattern``, from the lengths of all parts."""
    sizes = (
        f"zip_with(slice(split({text}, {_sql_text(pattern)}, -1), 1, size({found})), {found},"
        f" (gap, m) -> cast({length}(gap) + {length}(m) as bigint))"
    )
    return f"zip_with({running(sizes, 'top + v')}, {found}, (e, m) -> struct(e - {length}(m) as start, e as end))"


def _below(value: str, starts: str) -> str:
    """SQL: how many of the sorted ``starts`` are below ``value``, by binary search."""
    step = (
        f"if(s.low < s.high, if(get({starts}, (s.low + s.high) div 2) < {value},"
        " struct(cast((s.low + s.high) div 2 + 1 as int) as low, s.high as high),"
        " struct(s.low as low, cast((s.low + s.high) div 2 as int) as high)), s)"
    )
    return f"aggregate(sequence(0, length(bin(size({starts})))), struct(0 as low, size({starts}) as high), (s, i) -> {step}, s -> s.low)"


def _parts(run: str, pattern: str) -> str:
    """SQL: the matches of ``pattern`` in a run (start, end, v), as such runs; the last one keeps the run's padding."""
    found = f"regexp_extract_all({run}.v, {_sql_text(pattern)}, 0)"
    return (
        f"zip_with({positions(f'{run}.v', pattern, found)}, {found}, (part, w) -> struct({run}.start + part.start as start,"
        f" if(part.end = length({run}.v), {run}.end, {run}.start + part.end) as end, w as v))"
    )


def _tail(z: str) -> str:
    """SQL: upper tail of the normal distribution, by a logistic curve in z and its cube."""
    return f"(1 / (1 + exp(least(1.5976 * ({z}) + 0.07056 * pow({z}, 3), 600))))"


def _alphabet(value: str) -> str:
    """SQL: the alphabet of the first encoding that fits."""
    fits = [f"when {value} rlike {_sql_text(pattern)} then {_sql_text(abc)}" for _, pattern, abc in ENCODINGS]
    return f"case {' '.join(fits)} end"


def scanned(
    docs: DataFrame, t: str = "t", base: str = "base", candidates: str = "found", length: str = "length"
) -> DataFrame:
    """Add ``base`` (array of start, order, end, kind) and ``found`` (candidates with their evidence) to each row.

    A null text counts as empty. Positions are code points, or bytes with ``length`` octet_length; the end is exclusive.
    Very long texts and texts of very many spans take time in proportion to their length, and to the number of spans to
    the power of 1.5.
    """
    df = docs.withColumn(t, text_or_empty())
    own = list(df.columns)
    for kind, (pattern, group, _) in PATTERNS.items():
        df = df.withColumn(f"_secret_{kind}", F.regexp_extract_all(t, F.lit(pattern), F.lit(0)))
        if group:
            df = df.withColumn(f"_secret_{kind}_value", F.regexp_extract_all(t, F.lit(pattern), F.lit(group)))
    df = df.withColumn("_secret_token", F.regexp_extract_all(t, F.lit(RUN), F.lit(0)))
    spans = []
    for order, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        value = f"_secret_{kind}_value" if group else f"_secret_{kind}"
        spans.append(
            f"transform(filter(zip_with({positions(t, pattern, f'_secret_{kind}', length)}, {value}, (p, v) -> struct(p.start as start,"
            f" {order} as order, p.end as end, length(v) as size)), p -> p.size >= {least}),"
            f" p -> struct(p.start as start, p.order as order, p.end as end, '{kind}' as kind))"
        )
    df = df.withColumn(base, F.expr(f"array_sort(concat({', '.join(spans)}))"))
    runs = (
        f"zip_with({positions(t, RUN, '_secret_token', length)}, _secret_token,"
        " (p, v) -> struct(p.start as start, p.end as end, rtrim('=', v) as v))"
    )
    df = df.withColumn("_secret_runs", F.expr(runs))
    df = df.withColumn("_secret_starts", F.expr(f"transform({base}, b -> b.start)"))
    df = df.withColumn("_secret_reach", F.expr(running(f"transform({base}, b -> b.end)", "greatest(top, v)")))
    before = _below("c.end", "_secret_starts")
    cut = ", ".join(_parts("r", pattern) for pattern in ("[A-Za-z0-9+/]+", "[A-Za-z0-9_-]+", "[A-Za-z0-9]+"))
    mixed = "r.v rlike '[+/]' and r.v rlike '[_-]'"
    df = df.withColumn(
        "_secret_c1",
        F.expr(
            f"filter(flatten(transform(_secret_runs, r -> if({mixed}, array_distinct(concat({cut})), array(r)))),"
            f" c -> length(c.v) >= {MIN_LENGTH} and coalesce(get(_secret_reach, {before} - 1) <= c.start, true))"
        ),
    )
    alone, pairs = (f"array({', '.join(map(str, values))})" for values in written())
    kind = "if(k < 26, 0, if(k < 52, 1, if(k < 62, 2, 3)))"
    sizes = sorted({len(alphabet) for _, _, alphabet in ENCODINGS})
    uniform = f"case c.a {' '.join(f'when {n} then {exponent(1 / n)}' for n in sizes)} end"
    # Writing begins as after a separator.
    follow = (
        f"aggregate(c.k, struct(0 as sum, 3 as last), (s, k) -> struct(s.sum + get({alone}, k) + get({pairs},"
        f" 4 * s.last + {kind}) as sum, {kind} as last), s -> s.sum)"
    )
    steps = [
        # Encoding.
        f"filter(transform(_secret_c1, c -> struct(c.start, c.end, c.v, cast(length(c.v) as double) as n, {_alphabet('c.v')} as abc)),"
        " c -> c.abc is not null)",
        # Symbols as numbers, and equal pairs from the counts per symbol.
        "transform(_secret_c2, c -> struct(c.start, c.end, c.n, xxhash64(c.v) as id, cast(length(c.abc) as double) as a,"
        f" transform(filter(split(c.v, '', -1), s -> s != ''), s -> instr({_sql_text(''.join(SYMBOLS))}, s) - 1) as k,"
        " transform(filter(split(c.v, '', -1), s -> s != ''), s -> cast(instr(c.abc, s) - 1 as double)) as x,"
        " aggregate(transform(filter(split(c.abc, '', -1), s -> s != ''), s -> length(c.v) - length(replace(c.v, s, ''))),"
        " 0D, (u, o) -> u + cast(o as double) * (o - 1) / 2) as u))",
        # Sums for the runs and the serial correlation.
        "transform(_secret_c3, c -> struct(c.start, c.end, c.n, c.id, c.a, c.u,"
        f" {follow} - c.n * {uniform} as exponent,"
        " cast(size(filter(c.x, s -> 2 * s >= c.a)) as double) as high,"
        " 1 + aggregate(zip_with(slice(c.x, 1, size(c.x) - 1), slice(c.x, 2, size(c.x) - 1),"
        " (p, q) -> if((2 * p >= c.a) != (2 * q >= c.a), 1D, 0D)), 0D, (u, o) -> u + o) as runs,"
        " aggregate(c.x, 0D, (u, o) -> u + o) / c.n as mean, c.x as x))",
        "transform(_secret_c4, c -> struct(c.start, c.end, c.n, c.id, c.exponent, c.a, c.u, c.high, c.n - c.high as low, c.runs,"
        " aggregate(c.x, 0D, (u, o) -> u + (o - c.mean) * (o - c.mean)) as spread,"
        " aggregate(zip_with(slice(c.x, 1, size(c.x) - 1), slice(c.x, 2, size(c.x) - 1),"
        " (p, q) -> (p - c.mean) * (q - c.mean)), 0D, (u, o) -> u + o) as serial))",
        # Test values.
        "transform(_secret_c5, c -> struct(c.start, c.end, c.n, c.id, c.exponent,"
        " (c.a / c.n * (c.n + 2 * c.u) - c.n - (c.a - 1)) / sqrt(2 * (c.a - 1) * (c.n - 1) / c.n) as z_uniform,"
        " if(c.high * c.low = 0, 40D, abs(c.runs - 1 - 2 * c.high * c.low / c.n) / sqrt(greatest(2 * c.high * c.low *"
        " (2 * c.high * c.low - c.n) / (c.n * c.n * (c.n - 1)), 1e-9))) as z_runs,"
        " if(c.spread = 0, 40D, abs(c.serial / c.spread * sqrt(c.n))) as z_serial))",
        f"transform(_secret_c6, c -> struct(c.start, c.end, c.n, c.id, c.exponent, -2 * (ln({_tail('c.z_uniform')}) +"
        f" ln(least(1D, 2 * {_tail('c.z_runs')})) + ln(least(1D, 2 * {_tail('c.z_serial')}))) as fisher))",
        "transform(_secret_c7, c -> struct(c.start, c.end, c.id, cast(floor(log2(c.n)) as int) as class,"
        " cast(floor(least(c.exponent, 300000D) / 100) as int) as tenth,"
        f" exp(-c.fisher / 2) * (1 + c.fisher / 2 + c.fisher * c.fisher / 8) >= {LEAST_RANDOM} as random))",
    ]
    for i, step in enumerate(steps, start=2):
        df = df.withColumn(f"_secret_c{i}" if i <= len(steps) else candidates, F.expr(step))
    return df.select(*own, base, candidates)


def limits(rows: DataFrame, found: str = "found", level: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """Length class -> least tenth that counts as a discovery. One row per length class comes to the driver.

    A value that repeats counts once: tasks first drop their own repeats, so no value is hot.
    """
    each = rows.select(F.explode(found).alias("c")).select("c.class", "c.tenth", "c.id").distinct()
    counts = each.groupBy("class", "tenth").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("class")
    ranked = counts.withColumn("all", F.sum("n").over(group)).withColumn(
        "upto", F.sum("n").over(group.orderBy(F.desc("tenth")))
    )
    enough = F.pow(F.lit(10.0), -F.col("tenth") / 10) <= F.col("upto") / F.col("all") * level
    return {r["class"]: r["tenth"] for r in ranked.where(enough).groupBy("class").agg(F.min("tenth").alias("tenth")).collect()}


def all_spans(least: dict[int, int], base: str = "base", found: str = "found") -> Column:
    """Base spans and discoveries as (start, order, end, kind), sorted."""
    known = " ".join(f"when {k} then {v}" for k, v in sorted(least.items()))
    limit = f"case c.class {known} end" if known else "cast(null as int)"
    judged = f"filter({found}, c -> c.random and coalesce(c.tenth >= {limit}, false))"
    # Sorted so that a span comes after all that it lies within.
    placed = f"array_sort(transform({judged}, c -> struct(c.start as start, -c.end as back)))"
    outermost = _let(
        "r", running("transform(j, c -> -c.back)", "greatest(top, v)"),
        f"transform(filter(j, (c, i) -> i = 0 or get(r, i - 1) < -c.back), c -> struct(c.start as start,"
        f" {len(KINDS)} as order, -c.back as end, '{RANDOM}' as kind))",
    )
    added = _let("j", placed, outermost)
    return F.expr(f"array_sort(concat({base}, {added}))")


def listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Whole texts are scanned once; the spans and candidates are stored and judged together. A null or empty text has no
    spans; repeated rows are judged alike and count each; an empty table gives an empty result.
    """
    rows = stored(scanned(docs.select("doc_id", "text")).drop("text", "t"), "secrets")
    out = rows.withColumn("spans", all_spans(limits(rows)))
    counts = [
        F.expr(f"cast(size(filter(base, b -> b.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS
    ]
    return out.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def masked(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """The documents with every span replaced by ``mask`` and ``n_chars`` set anew where a text changed.

    Overlapping spans are replaced as one. Rows without a span stay as they are, so do null texts; repeated rows are
    masked each, and an empty table stays empty. Spans are places in bytes here, so that cutting does not count
    characters anew for each.
    """
    t, base, found, spans = (free_name(docs, n) for n in ("t", "base", "found", "spans"))
    # Stored first: unfolded in place, the candidates of a row would be made anew for each of them.
    least = limits(stored(scanned(docs.select("text"), t, base, found).select(found), "candidates"), found)
    rows = scanned(docs, t, base, found, "octet_length").withColumn(spans, all_spans(least, base, found))
    heads = f"filter(sequence(0, size({spans}) - 1), i -> i = 0 or get({spans}, i).start >= get(r, i - 1))"
    last = f"if(n + 1 < size(h), get(h, n + 1), size({spans})) - 1"
    each = _let("h", heads, f"transform(h, (i, n) -> struct(get({spans}, i).start as start, get(r, {last}) as end))")
    united = f"if(size({spans}) = 0, cast(array() as array<struct<start:bigint,end:bigint>>), " + _let(
        "r", running(f"transform({spans}, s -> s.end)", "greatest(top, v)"), each
    ) + ")"
    gaps = (
        f"transform(sequence(0, size({spans})), i -> struct(if(i = 0, 0L, get({spans}, i - 1).end) as start,"
        f" if(i = size({spans}), cast(octet_length({t}) as bigint), get({spans}, i).start) as end))"
    )
    cut = f"transform({gaps}, g -> cast(substring(y, int(g.start + 1), int(g.end - g.start)) as string))"
    text = f"array_join({_let('y', f'cast({t} as binary)', cut)}, {_sql_text(mask)})"
    some = F.size(spans) > 0
    rows = rows.withColumn(spans, F.expr(united))
    rows = rows.withColumn("text", F.when(some, F.expr(text)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn(
            "n_chars", F.when(some, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars"))
        )
    return rows.select(docs.columns)
