"""Partner seniority: rank, top n, pivot to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmroll.fixed_values import FEED_COLUMNS, PARTNER_SLOTS, PIVOT_SOURCES
from firmroll.operators.lookups import Lookup, describe, grouped
from firmroll.operators.numbering import number_rows
from firmroll.operators.skew import SALT, Hot, hot_keys, only_hot, slices, without_hot

KEY = "cnpj_basico"
RANK = "rn"

# Dates are compared as text, so an undated partner counts as the oldest; the name decides next. The other columns
# only make the order total. Those that the pivot does not show come last: rows that differ in nothing else give the
# same pivot in any order, so the pivot can prune them at the scan.
_LEADING = ["data_entrada_sociedade", "nome_socio_razao_social"]
_SHOWN = [name for name in FEED_COLUMNS["socios"] if name in PIVOT_SOURCES.values() and name not in _LEADING]
_NOT_SHOWN = [name for name in FEED_COLUMNS["socios"] if name not in PIVOT_SOURCES.values() and name != KEY]
SENIORITY = _LEADING + _SHOWN + _NOT_SHOWN


def partner_rank(partners: DataFrame, hot: Hot | None = None) -> DataFrame:
    """All partners with their seniority ``rn`` within the company."""
    return number_rows(partners, KEY, SENIORITY, RANK, hot)


def _first(partners: DataFrame, n: int, *group: str) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*_LEADING, *_SHOWN)
    return partners.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) <= n)


def senior_partners(partners: DataFrame, n: int, hot: Hot | None = None) -> DataFrame:
    """The ``n`` most senior partners per company, with the columns that the pivot shows.

    The rank filter sits right on the window, so each task keeps at most ``n`` rows per company *before* the shuffle.
    A staged table needs no shuffle, but has all rows of a company in one bucket: companies with a large share of all
    partners, ``hot``, are therefore cut to ``n`` rows in slices first. None looks for them. Slices go by position in
    the scan, so that even full copies of one row spread.
    """
    hot = hot_keys(partners, KEY) if hot is None else hot
    shown = partners.select(KEY, *PIVOT_SOURCES.values())
    if hot:
        parts = slices(shown)
        # Asked for by name: a table bucketed by company would count as grouped by (company, slice) already.
        placed = only_hot(shown, KEY, hot).withColumn(SALT, F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int"))
        in_slices = placed.repartitionById(parts, F.col(SALT))
        shown = without_hot(shown, KEY, hot).unionByName(_first(in_slices, n, KEY, SALT).drop(SALT, RANK))
    return _first(shown, n, KEY)


def top_partners(
    partners: DataFrame,
    roles: Lookup | None = None,
    ages: Lookup | None = None,
    blank: bool = True,
    hot: Hot | None = None,
) -> DataFrame:
    """One row per company, its three most senior partners as columns ``<attribute>_<slot>``.

    With dictionaries given, descriptions are looked up on the long form, three joins instead of nine, and pivoted
    along. Repeated codes multiply rows, each slot for itself: all descriptions of a code travel as one array, which is
    unfolded slot by slot after the pivot. A free slot is blank, or NULL with ``blank=False``; descriptions stay NULL.
    """
    long = senior_partners(partners, len(PARTNER_SLOTS), hot).select(
        KEY, RANK, *[F.col(source).alias(name) for name, source in PIVOT_SOURCES.items()]
    )
    described, unfolded = [], []
    for code, lookup in (("qualificacao_socio", roles), ("qualificacao_representante", roles), ("faixa_etaria", ages)):
        if lookup is not None:
            common = () if lookup.small else hot_keys(partners, PIVOT_SOURCES[code])
            long = describe(long, lookup if lookup.unique else grouped(lookup), code, f"desc_{code}", common)
            described.append(f"desc_{code}")
            if not lookup.unique:
                unfolded += [f"desc_{code}_{slot}" for slot in PARTNER_SLOTS]

    # One aggregate per slot, which keeps a row as a whole: one per slot and column would go through each row 33 times.
    row = F.struct(*PIVOT_SOURCES, *described)
    slots = long.groupBy(KEY).agg(*[F.max(F.when(F.col(RANK) == slot, row)).alias(f"_slot_{slot}") for slot in PARTNER_SLOTS])
    pivot = slots.select(
        KEY,
        *[F.col(f"_slot_{slot}")[name].alias(f"{name}_{slot}") for slot in PARTNER_SLOTS for name in [*PIVOT_SOURCES, *described]],
    )
    for name in unfolded:
        others = [c for c in pivot.columns if c != name]
        pivot = pivot.select(*others, F.explode_outer(name).alias(name)).withColumn(name, F.col(f"{name}.description"))
    if not blank:
        return pivot
    plain = [f"{name}_{slot}" for slot in PARTNER_SLOTS for name in PIVOT_SOURCES]
    return pivot.fillna("", subset=plain)

