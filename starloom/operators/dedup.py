"""Distinct values and keyed de-duplication."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.names import as_list, col, fresh


def distinct_values(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Distinct combinations of ``columns``; NULL is one value like any other."""
    return df.select(*[col(name) for name in as_list(columns)]).distinct()


def dedup(
    df: DataFrame,
    keys: str | Iterable[str],
    order_by: Iterable[str | Column] = (),
    survivor: str = "first",
) -> DataFrame:
    """Keep one row per key; NULL keys equal each other.

    ``survivor="first"`` keeps the first row by ``order_by`` and then by the
    remaining columns, missing values last, so every run keeps the same one.
    Columns without an order (maps) are compared as text. Spark ranks within each
    input task before the shuffle, so a key held by a third of the rows reaches
    its final task as one row per input task. ``survivor="any"`` keeps whichever
    row comes first.
    """
    keys = as_list(keys)
    if survivor == "any":
        return df.dropDuplicates(keys)
    by = [col(k) for k in keys]
    # The hash leads so that the sort mostly compares one fixed-width number.
    ranked = Window.partitionBy(F.xxhash64(*by), *by).orderBy(*(_order(df, keys, order_by) or [F.lit(1)]))
    rank = fresh("_rank", df.columns)
    return df.withColumn(rank, F.row_number().over(ranked)).where(col(rank) == 1).drop(rank)


def dedup_marked(
    df: DataFrame, keys: str | Iterable[str], held: DataFrame, mark: str, order_by: Iterable[str | Column] = ()
) -> DataFrame:
    """The first row per key as :func:`dedup` keeps it, with ``mark`` true where ``held`` has the key.

    ``held`` has the columns ``keys`` and each key once. Its keys go through the shuffle and the
    ranking of the rows, ahead of them, so the rows are moved once for both.
    """
    keys = as_list(keys)
    from_held, rank = fresh("_held", [*df.columns, mark]), fresh("_rank", [*df.columns, mark])
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name not in keys]
    ahead = held.select(*[col(k) for k in keys], *lacking, F.lit(True).alias(from_held))
    both = df.withColumn(from_held, F.lit(False)).unionByName(ahead)
    by = [col(k) for k in keys]
    ranked = Window.partitionBy(F.xxhash64(*by), *by).orderBy(col(from_held).desc(), *_order(df, keys, order_by))
    so_far = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumns({rank: F.row_number().over(ranked), mark: F.first(col(from_held)).over(so_far)})
    # The bound on the rank lets Spark rank within each input task before the shuffle.
    own = (col(rank) <= 2) & ~col(from_held) & ((col(rank) == 1) | col(mark))
    return both.where(own).drop(rank, from_held)


def _order(df: DataFrame, keys: list[str], order_by: Iterable[str | Column]) -> list[Column]:
    order_by = list(order_by)
    named = [c for c in order_by if isinstance(c, str)]
    rest = [
        (col(f.name) if _has_order(f.dataType) else _as_text(f)).asc_nulls_last()
        for f in df.schema.fields
        if f.name not in keys and f.name not in named
    ]
    return [col(c) if isinstance(c, str) else c for c in order_by] + rest


def _has_order(kind: T.DataType) -> bool:
    """False for maps and variants, and for whatever holds one."""
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _as_text(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.MapType):
        # Entries in key order, so that equal maps give equal text.
        return F.to_json(F.array_sort(F.map_entries(col(field.name))))
    return F.to_json(F.struct(col(field.name)))
