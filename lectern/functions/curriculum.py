"""Curriculum columns: weights, tiers, ordered lists, search texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern import fixed_values as V


def weight(col: Column) -> Column:
    """``~5%`` gives 5."""
    return F.regexp_extract(col, r"(\d+)", 1).try_cast("int")


def weight_range(col: Column) -> Column:
    """First figure of a heading: ``~28–32%`` gives (28, 32), ``~25%`` gives (25, 25)."""
    lo = F.regexp_extract(col, r"~(\d+)", 1).try_cast("int")
    hi = F.regexp_extract(col, r"~\d+[–-](\d+)%", 1)
    first = F.regexp_extract(col, r"~(\d+(?:[–-]\d+)?)%", 1)
    ranged = first.rlike("[–-]")
    return F.struct(lo.alias("lo_pct"), F.when(ranged, hi.try_cast("int")).otherwise(lo).alias("hi_pct"))


def tier(col: Column, tiers: dict[str, str] = V.TIERS) -> Column:
    """Tier name for a cell that holds a tier mark."""
    named = F.lit(None).cast("string")
    for mark, name in tiers.items():
        named = F.when(col.contains(mark), F.lit(name)).otherwise(named)
    return named


def rank_in(col: Column, order: Sequence[str]) -> Column:
    """1-based place of a value in a short fixed list; values outside come last."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), col).cast("int")
    return F.when(F.coalesce(place, F.lit(0)) == 0, F.lit(len(order) + 1)).otherwise(place)


def tier_rank(col: Column) -> Column:
    return rank_in(col, V.TIER_ORDER)


def arrow_items(col: Column) -> Column:
    """Split ``A → B (x → y) → C`` at the outer arrows."""
    return F.split(col, r"\s*→\s*(?![^()]*\))")


def filled(template: str, **values: Column) -> Column:
    """Replace each ``{name}`` of a template by a column."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out
