"""Dropping, counting and showing rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame

from starloom.functions.missing import is_missing
from starloom.names import as_list, col


def drop_empty_rows(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows in which every column (of ``subset``) is NULL or NaN."""
    return df.dropna(how="all", subset=None if subset is None else list(subset))


def is_complete(df: DataFrame, subset: str | Iterable[str]) -> Column:
    """True where no column of ``subset`` is NULL or NaN."""
    return reduce(and_, [~is_missing(df.schema[c], text_nan=False) for c in as_list(subset)])


def drop_incomplete_rows(df: DataFrame, subset: str | Iterable[str]) -> DataFrame:
    """Drop rows in which any column of ``subset`` is NULL or NaN.

    Written as plain predicates rather than ``dropna``, which hides the null
    tests from the Parquet reader.
    """
    subset = as_list(subset)
    present = reduce(and_, [col(name).isNotNull() for name in subset])
    return df.where(present & is_complete(df, subset))


def missing_cells(df: DataFrame, text_nan: bool = False) -> Column:
    """How many cells of the row are missing."""
    return reduce(add, [is_missing(f, text_nan).cast("int") for f in df.schema.fields])


def with_missing_count(df: DataFrame, name: str = "n_missing") -> DataFrame:
    """Add the number of missing cells per row."""
    return df.withColumn(name, missing_cells(df))


def sparse_rows(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Rows with more than ``share`` of their cells missing."""
    return df.where(missing_cells(df) > share * len(df.columns))


def peek(df: DataFrame, n: int = 5, order_by: str | Iterable[str] = ()) -> DataFrame:
    """The first ``n`` rows, in a stated order if one is given."""
    order = as_list(order_by)
    return (df.orderBy(*[col(name) for name in order]) if order else df).limit(n)
