"""Checks on finished tables; each is a small table with a ``passed`` column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.missing import is_missing
from starloom.names import as_list, as_pairs, col, fresh


def check_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count, passed`` per table; an empty table fails."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("passed")
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _outcome(check: str, checked: Column, violations: Column) -> list[Column]:
    violations = F.coalesce(violations, F.lit(0))
    return [
        F.lit(check).alias("check_name"),
        F.coalesce(checked, F.lit(0)).alias("n_checked"),
        violations.alias("n_violations"),
        (violations == 0).alias("passed"),
    ]


def check_unique(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Counts rows that repeat an earlier row's key; NULL keys equal each other."""
    keys = as_list(keys)
    n = fresh("_n", keys)
    per_key = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(n))
    name = "unique(" + ", ".join(keys) + ")"
    return per_key.agg(
        F.sum(n).alias("rows"), F.sum(F.col(n) - 1).alias("surplus")
    ).select(*_outcome(name, F.col("rows"), F.col("surplus")))


def check_not_null(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Counts NULLs and NaNs, one row per column, in one scan."""
    columns = as_list(columns)
    total = fresh("_rows", columns)
    counts = df.agg(
        F.count(F.lit(1)).alias(total),
        *[F.count_if(is_missing(df.schema[c], text_nan=False)).alias(c) for c in columns],
    )
    long = counts.unpivot(total, [col(c) for c in columns], "_column", "_nulls")
    check, *rest = _outcome("", F.col(total), F.col("_nulls"))
    named = F.concat(F.lit("not_null("), F.col("_column"), F.lit(")")).alias("check_name")
    return long.select(named, *rest)


def check_foreign_key(
    child: DataFrame, parent: DataFrame, on: str | Iterable[str] | Mapping[str, str]
) -> DataFrame:
    """Counts child rows whose key is set but absent from the parent.

    The child is reduced to one row per key before it is joined, so a key with
    very many rows is one row in the join.
    """
    pairs = as_pairs(on)
    names = [f"_key{i}" for i in range(len(pairs))]
    known = reduce(and_, [col(c).isNotNull() for c in pairs])
    used = (
        child.where(known)
        .groupBy(*[col(c).alias(n) for c, n in zip(pairs, names)])
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    present = (
        parent.select(*[col(p).alias(n) for p, n in zip(pairs.values(), names)])
        .distinct()
        .withColumn("_found", F.lit(True))
    )
    totals = used.join(present, names, "left").agg(
        F.sum("_n").alias("rows"), F.sum(F.when(F.col("_found").isNull(), F.col("_n"))).alias("lost")
    )
    name = "foreign_key(" + ", ".join(pairs) + ")"
    return totals.select(*_outcome(name, F.col("rows"), F.col("lost")))


def check_source_target(source: DataFrame, target: DataFrame, dropped: int = 0) -> DataFrame:
    """Compares row counts: the target must hold the source less ``dropped`` rows."""
    sides = reduce(
        DataFrame.unionByName,
        [
            side.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(name))
            for name, side in (("source", source), ("target", target))
        ],
    )
    counts = sides.agg(
        F.max(F.when(F.col("side") == "source", F.col("n"))).alias("n_source"),
        F.max(F.when(F.col("side") == "target", F.col("n"))).alias("n_target"),
    )
    expected = F.col("n_source") - F.lit(dropped).cast("long")
    return counts.withColumn("passed", F.col("n_target") == expected)


def check_schema(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """``column_name, expected_type, actual_type, passed`` for every expected or extra column."""
    if isinstance(expected, str):
        expected = T.StructType.fromDDL(expected)
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(n, want.get(n), have.get(n), want.get(n) == have.get(n)) for n in {**want, **have}]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, actual_type string, passed boolean"
    )


class QualityError(ValueError):
    """A quality check failed."""


def fail_if_any(report: DataFrame) -> DataFrame:
    """Raise :class:`QualityError` listing the failed checks, else return the report."""
    failed = [row.asDict() for row in report.where("not passed").collect()]
    if failed:
        raise QualityError(f"failed checks: {failed}")
    return report
