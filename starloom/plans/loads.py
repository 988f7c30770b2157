"""Loading month by month: keys that stay, records that count once, folders that are replaced.

One load runs at a time. A load that failed is run again with the same rows; what it
had already written is then found as it should be, or replaced.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import calendar_parts
from starloom.names import as_list, col, fresh
from starloom.operators.dedup import dedup_marked
from starloom.operators.registry import new_members
from starloom.plans import cleaning
from starloom.plans.facts import FACT_NAMES, immigration_fact
from starloom.scratch import materialise
from starloom.sources.writers import exists, hadoop_path, write_partitioned

#: Folder column of a monthly table, and the column that marks records of an earlier month.
MONTH = "load_month"
SUPERSEDED = "superseded"
#: Folders whose rows are written without bringing each one's together: a task may write a file in each.
FEW = 4


def extend_dimension(
    rows: DataFrame, path: str, natural_key: str | Iterable[str], name: str = "id"
) -> DataFrame:
    """The dimension at ``path`` with the members of ``rows`` that it lacked; all keys it had stay.

    Only the new members are written, as further files: a load without any writes nothing.
    """
    spark, natural_key = rows.sparkSession, as_list(natural_key)
    fields = [rows.schema[k] for k in natural_key]
    schema = T.StructType([*fields, T.StructField(name, T.LongType())])
    saved = _read(spark, path, schema)
    added = materialise(new_members(saved, rows, natural_key, name), "new-members")
    if not added.isEmpty() or not exists(spark, path):
        added.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def extend_calendar(
    rows: DataFrame, path: str, day: str = "arrdate", prefix: str = "arrival", folders: Iterable[str] = ()
) -> DataFrame:
    """The calendar at ``path`` with the days of ``rows`` that it lacked, in one folder per ``folders``."""
    spark = rows.sparkSession
    fields = [T.StructField(day, T.DateType()), *[T.StructField(c, T.IntegerType()) for c in calendar_parts(col(day), prefix)]]
    schema = T.StructType([*fields, T.StructField("id", T.LongType())])
    added = new_members(_read(spark, path, schema), rows.select(col(day).cast("date").alias(day)), day)
    added = materialise(added.withColumns(calendar_parts(col(day), prefix)), "new-days")
    if not added.isEmpty() or not exists(spark, path):
        added.coalesce(1).write.mode("append").partitionBy(*folders).parquet(path)
    return spark.read.schema(schema).parquet(path).select(*[col(c) for c in schema.names])


def load_month(
    rows: DataFrame,
    path: str,
    month: Any,
    keys: str | Iterable[str],
    order_by: Iterable[str | Column] = (),
) -> DataFrame:
    """Make ``rows`` what the table at ``path`` holds for ``month``; returns :func:`read_months`.

    A record, told by its ``keys`` (NULL keys equal each other), belongs to the earliest
    month that holds it. Whatever the order of the loads, and however often one is
    repeated, the same rows per month give the same table; a month loaded again with
    other rows gives records it no longer holds back to later months.

    To that end a month's folder keeps the records that an earlier one holds too, marked.
    Keys that the month gains or loses are looked up in the later months, if there are any, by
    key columns alone, and only months in which a mark changes are written again, before
    the month itself. Each folder is replaced in whole.
    """
    spark, keys = rows.sparkSession, as_list(keys)
    for name in (MONTH, SUPERSEDED):
        if name.lower() in {c.lower() for c in rows.columns}:
            raise ValueError(f"the table already has a column {name!r}")
    schema = _monthly_schema(rows.schema, month)
    saved = _read(spark, path, schema)
    at = F.lit(month)

    earlier = saved.where(F.col(MONTH) < at)
    own = dedup_marked(rows, keys, _keys(earlier, keys), SUPERSEDED, order_by)
    marked = materialise(own, "month").withColumn(MONTH, at)

    later = saved.where(F.col(MONTH) > at)
    if not later.isEmpty():
        _mark_later(saved, marked, path, at, keys)
    if marked.isEmpty():
        files, folder = hadoop_path(spark, f"{path}/{MONTH}={month}")
        files.delete(folder, True)
    else:
        write_partitioned(marked, path, MONTH, replace="partitions", as_it_lies=True)
    return read_months(spark, path, rows.schema, month)


def _mark_later(saved: DataFrame, marked: DataFrame, path: str, at: Column, keys: list[str]) -> None:
    """Write later months again in which a mark changes once ``marked`` is what month ``at`` holds."""
    old = saved.where(F.col(MONTH) == at)
    earlier, later = saved.where(F.col(MONTH) < at), saved.where(F.col(MONTH) > at)
    moved = materialise(_in_one_of(marked, old, keys), "moved-keys")
    # Who holds the moved keys once this month is replaced.
    holders = later.unionByName(earlier).select(*_cols(keys), MONTH).unionByName(marked.select(*_cols(keys), MONTH))
    first = fresh("_first", keys)
    firsts = _matching(holders, moved, keys).groupBy(*_cols(keys)).agg(F.min(MONTH).alias(first))
    firsts = materialise(firsts, "first-months")
    changed = _joined(later.select(*_cols(keys), MONTH, SUPERSEDED), firsts, keys, "inner", first)
    stale = changed.where(F.col(SUPERSEDED) != (col(first) < F.col(MONTH))).select(MONTH).distinct()
    # At most one row per month of the table.
    touched = [r[0] for r in stale.collect()]
    if touched:
        again = _joined(saved.where(F.col(MONTH).isin(touched)), firsts, keys, "left", first)
        mark = F.coalesce(col(first) < F.col(MONTH), F.col(SUPERSEDED))
        again = again.withColumn(SUPERSEDED, mark).drop(first)
        again = materialise(again, "later-months")
        write_partitioned(again, path, MONTH, replace="partitions", as_it_lies=len(touched) <= FEW)


def read_months(spark: SparkSession, path: str, schema: T.StructType, month: Any = "") -> DataFrame:
    """The records of a monthly table, each under its earliest month; ``month`` shows the folders' type."""
    table = _read(spark, path, _monthly_schema(schema, month))
    return table.where(~F.col(SUPERSEDED)).drop(SUPERSEDED)


def load_immigration_month(
    immigration: DataFrame, output: str, month: Any, folders: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """One month of raw immigration rows into the fact, the visa types and the calendar.

    Rows are those of the record rule (with an id, once each). Keys of visa types and
    days are those of earlier loads, so facts written before keep pointing at the same
    members.
    """
    clean = materialise(cleaning.IMMIGRATION_RECORDS.apply(immigration), "month-records")
    visa_types = extend_dimension(clean.select("visatype"), f"{output}/visatype", "visatype", "visa_type_key")
    fact = immigration_fact(clean, visa_types)
    fact = load_month(fact, f"{output}/immigration_fact", month, FACT_NAMES["cicid"])
    days = extend_calendar(fact, f"{output}/immigration_calendar", folders=folders)
    return {"immigration_fact": fact, "immigration_calendar": days, "visatype": visa_types}


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*[col(c) for c in schema.names])


def _monthly_schema(schema: T.StructType, month: Any) -> T.StructType:
    kind = T.StringType() if isinstance(month, str) else T.DateType() if hasattr(month, "isoformat") else T.IntegerType()
    return T.StructType([*schema.fields, T.StructField(SUPERSEDED, T.BooleanType()), T.StructField(MONTH, kind)])


def _cols(keys: list[str]) -> list[Column]:
    return [col(k) for k in keys]


def _keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*_cols(keys)).distinct()


def _in_one_of(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one of two tables has; each table holds a key once."""
    names = {k: fresh(f"_other_{k}", keys) for k in keys}
    here, there = fresh("_here", keys), fresh("_there", keys)
    mine = left.select(*_cols(keys), F.lit(True).alias(here))
    other = right.select(*[col(k).alias(n) for k, n in names.items()], F.lit(True).alias(there))
    both = mine.join(other, _same(names), "full").where(col(here).isNull() | col(there).isNull())
    return both.select(*[F.when(col(here), col(k)).otherwise(col(n)).alias(k) for k, n in names.items()])


def _matching(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose keys are among ``wanted``."""
    names = {k: fresh(f"_wanted_{k}", df.columns) for k in keys}
    right = wanted.select(*[col(k).alias(n) for k, n in names.items()])
    return df.join(right, _same(names), "left_semi")


def _joined(df: DataFrame, lookup: DataFrame, keys: list[str], how: str, value: str) -> DataFrame:
    """``df`` with ``value`` of a lookup that has one row per key."""
    names = {k: fresh(f"_lookup_{k}", df.columns) for k in keys}
    right = lookup.select(*[col(k).alias(n) for k, n in names.items()], col(value))
    return df.join(right, _same(names), how).drop(*names.values())


def _same(names: dict[str, str]) -> Column:
    return reduce(and_, [col(k).eqNullSafe(col(n)) for k, n in names.items()])
