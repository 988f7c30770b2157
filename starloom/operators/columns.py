"""Dropping and renaming columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from starloom.names import as_list
from starloom.operators.profile import missing_profile


def drop_columns(df: DataFrame, names: str | Iterable[str]) -> DataFrame:
    """Drop columns by name; names the table lacks are ignored."""
    return df.drop(*as_list(names))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the table lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def sparse_columns(df: DataFrame, threshold: float = 0.9) -> list[str]:
    """Columns whose share of missing values is above ``threshold``.

    One aggregate over the table; one short row per column reaches the driver.
    """
    sparse = missing_profile(df).where(f"pct_missing > {round(100 * threshold, 6)}")
    found = {row.column_name for row in sparse.select("column_name").collect()}
    return [name for name in df.columns if name in found]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Drop every column that is missing in more than ``threshold`` of the rows."""
    return df.drop(*sparse_columns(df, threshold))
