"""What counts as a missing value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.names import col


def is_missing(field: T.StructField, text_nan: bool = True) -> Column:
    """NULL for every type, NaN for floats, and the word NaN for text.

    The test is chosen by type: ``isnan`` on text or dates fails under ANSI
    mode. ``text_nan=False`` leaves text spelled NaN alone, as ``dropna`` does.
    """
    value = col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    if text_nan and isinstance(field.dataType, T.StringType):
        return value.isNull() | (F.lower(F.trim(value)) == "nan")
    return value.isNull()


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, NULL when ``whole`` is zero."""
    return F.try_divide(F.lit(100.0) * part, whole)
