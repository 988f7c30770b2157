"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.names import as_list, col, fresh
from starloom.scratch import materialise

# monotonically_increasing_id holds the partition above bit 33 and the row's
# position in that partition below it.
_PARTITION_BIT = 33


@dataclass(frozen=True)
class Ordered:
    """A written table in sorted order, with the columns that say where a row lies."""

    table: DataFrame
    part: str
    pos: str


def in_global_order(df: DataFrame, order_by: Iterable[str], name: str) -> Ordered:
    """``df`` written in sorted order, with each row's partition and position in it.

    The sort is Spark's range-partitioned one. Both numbers are stored with the
    rows, so whatever is computed from them later sees the same partitions.
    """
    part, pos, slot = (fresh(n, df.columns) for n in ("_part", "_pos", "_slot"))
    ordered = df.orderBy(*[col(c) for c in order_by]).withColumn(
        slot, F.monotonically_increasing_id()
    )
    table = (
        materialise(ordered, name)
        .withColumn(part, F.shiftright(col(slot), _PARTITION_BIT))
        .withColumn(pos, col(slot).bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1)))
        .drop(slot)
    )
    return Ordered(table, part, pos)


def with_surrogate_key(
    df: DataFrame, natural_key: str | Iterable[str], name: str = "id"
) -> DataFrame:
    """Add the row's 0-based rank by ``natural_key`` (NULL first) as a dense key.

    The values depend on the data alone, so a rebuild gives every member its old
    key back as long as the members are the same. ``natural_key`` should be
    unique. Nothing is gathered: rows are numbered inside range partitions, and
    only the partition sizes (one short row per partition) are summed up and
    broadcast. A column called ``name`` is refused.
    """
    if name in df.columns:
        raise ValueError(f"the table already has a column {name!r}")
    ordered = in_global_order(df, as_list(natural_key), "keyed")
    size, offset = (fresh(n, df.columns) for n in ("_size", "_offset"))
    sizes = ordered.table.groupBy(ordered.part).agg(F.count(F.lit(1)).alias(size))
    before = Window.orderBy(ordered.part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        ordered.part, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(offset)
    )
    return ordered.table.join(F.broadcast(offsets), ordered.part).select(
        *[col(c) for c in df.columns], (F.col(offset) + F.col(ordered.pos)).alias(name)
    )
