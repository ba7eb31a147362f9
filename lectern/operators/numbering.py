"""Row numbers that stay parallel when one group holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lectern.session import stage

_SLOT_BITS = 33  # monotonically_increasing_id keeps the row count of a partition in its low 33 bits


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "pos", total: str | None = None,
) -> DataFrame:
    """Number the rows of each group (from 1) by any order; ``total`` adds the size of the group.

    The rows are range-partitioned on (group, order) and written once, so partitions are cut by row count and a
    large group spreads over many. A group's numbers start at the smallest global number in it; the pieces that a
    group has in the partitions are counted, one small row each. NULL keys form a group; NULL order values come first.
    """
    group = list(keys)
    ordered = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = numbered_globally(df, [*[F.col(k) for k in group], *ordered], "_at")
    if not group:
        numbered = placed.withColumn(out, F.col("_at") + 1)
        return (numbered.withColumn(total, F.lit(placed.count()).cast("long")) if total else numbered).drop("_at", "_part")
    # Integers only, so the pieces are counted by hash before the shuffle.
    starts = placed.groupBy(*group).agg(F.min("_at").alias("_start"), F.count("*").alias("_all")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(group)], "_start", "_all")
    match = F.lit(True)
    for i, k in enumerate(group):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    columns = [*df.columns, (F.col("_at") - F.col("_start") + 1).alias(out)]
    return placed.join(starts, match).select(*columns, *([F.col("_all").alias(total)] if total else []))


def numbered_globally(df: DataFrame, order: Sequence[Column] | None, out: str) -> DataFrame:
    """0-based dense number over the whole table, plus ``_part``; in ``order`` if one is given.

    The rows are written once with their slot (partition and row in it); the offsets of the
    partitions are then one row per written partition.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = stage(df.withColumn("_slot", F.monotonically_increasing_id()), "numbered")
    split = written.select(
        "*",
        F.shiftright("_slot", _SLOT_BITS).alias("_part"),
        F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)).alias("_row"),
    ).drop("_slot")
    running = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        split.groupBy(F.col("_part").alias("_of")).agg(F.count("*").alias("_rows"))
        .select("_of", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_before"))
    )
    return (
        split.join(offsets, F.col("_part") == F.col("_of"))
        .withColumn(out, F.col("_before") + F.col("_row"))
        .drop("_row", "_of", "_before")
    )


def assign_ids(df: DataFrame, id_col: str, start: int, order_cols: Sequence[str | Column] | None = None) -> DataFrame:
    """Dense ids from ``start`` on, in the given order (or in the order the partitions come)."""
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols or []]
    base = df.drop(id_col)
    numbered = numbered_globally(base, order, "_at")
    return numbered.select((F.col("_at") + start).cast("long").alias(id_col), *base.columns)


def in_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "pos") -> DataFrame:
    """First ``k`` rows of each group; every map task keeps at most ``k`` per group before the shuffle."""
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(out) <= k).withColumn(out, F.col(out).cast("long"))
