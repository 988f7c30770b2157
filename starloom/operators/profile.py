"""Profiles of a table: shape, schema, missing values, summary statistics."""

from __future__ import annotations

from collections.abc import Iterable
from math import ceil, floor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.missing import is_missing, percentage
from starloom.names import as_list, col, fresh
from starloom.operators.keys import in_global_order

_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def shape(df: DataFrame) -> DataFrame:
    """One row: ``n_rows, n_columns``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def schema_rows(df: DataFrame) -> DataFrame:
    """One row per column: ``position, column_name, data_type, nullable``."""
    fields = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*fields)))


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing values per column: ``column_name, missing, pct_missing, n_rows``.

    One scan: the row count is taken by the same aggregate as the missing
    counts. The percentage of an empty table is NULL.
    """
    total = fresh("_n_rows", df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias(total),
        *[F.count_if(is_missing(f)).alias(f.name) for f in df.schema.fields],
    )
    long = counts.unpivot(total, [col(c) for c in df.columns], "column_name", "missing")
    return long.toDF("n_rows", "column_name", "missing").select(
        "column_name",
        "missing",
        percentage(F.col("missing"), F.col("n_rows")).alias("pct_missing"),
        "n_rows",
    )


# Types whose only missing value is NULL, which column chunks count in their footers.
_COUNTED_IN_FOOTERS = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.BooleanType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def missing_profile_of_files(spark: SparkSession, path: str) -> DataFrame:
    """:func:`missing_profile` of a Parquet table, mostly from the footers of its files.

    NULL counts of whole-number, decimal, date, time and boolean columns are added up
    from the statistics of column chunks, inside tasks; their data is not read. Float
    and text columns, which may also be missing as NaN, and folder columns are scanned.
    So is every column where a chunk has no statistics, or a column is nested. All files
    must have been written with one schema, as the writers here do: chunks are told by
    the place of their column.
    """
    table = spark.read.parquet(path)
    stored = spark.read.option("recursiveFileLookup", True).parquet(path).schema.fields
    nested = any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in stored)
    counted = [] if nested else [f.name for f in stored if isinstance(f.dataType, _COUNTED_IN_FOOTERS)]
    known = _footer_counts(spark, path, counted) if counted else None
    if known is None:
        return missing_profile(table)
    schema = "column_name string, missing long, pct_missing double, n_rows long"
    total = known["rows"]
    rows = [(c, total - n, 100.0 * (total - n) / total if total else None, total) for c, n in zip(counted, known["present"])]
    found = spark.createDataFrame(rows, schema)
    rest = [c for c in table.columns if c not in counted]
    return found.unionByName(missing_profile(table.select(*[col(c) for c in rest]))) if rest else found


def footer_plan(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One row: the rows of a Parquet table, and the values of each column that are not NULL.

    The session that plans it has its own settings: they make Spark answer such counts
    from footers, which the caller's session does not do.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = [F.count(col(c)).alias(f"c{i}") for i, c in enumerate(columns)]
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), *counts)


def _footer_counts(spark: SparkSession, path: str, columns: list[str]) -> dict | None:
    """None where a footer lacks what is needed."""
    try:
        row = footer_plan(spark, path, columns).first()
    except (Py4JJavaError, PySparkException):
        return None
    finally:
        # A new session becomes the active one.
        spark._jvm.org.apache.spark.sql.SparkSession.setActiveSession(spark._jsparkSession)
    # Sums over no file at all are NULL.
    return {"rows": row["rows"] or 0, "present": [row[f"c{i}"] or 0 for i in range(len(columns))]}


def only_missing(profile: DataFrame) -> DataFrame:
    """The profile rows of columns that miss anything."""
    return profile.where("pct_missing > 0")


def column_overview(df: DataFrame) -> DataFrame:
    """The printed schema and the missing profile as one table."""
    return schema_rows(df).join(missing_profile(df), "column_name", "left")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: str | Iterable[str] | None = None) -> DataFrame:
    """Summary statistics, one row per numeric column.

    ``column_name, count, mean, std, min, p25, p50, p75, max`` over the values
    that are neither NULL nor NaN. All are doubles, so whole numbers beyond 2**53 are
    rounded. Quartiles are exact and interpolated.

    Two scans, however the values lie. The first takes the moments and a mergeable
    quantile sketch per column, whose error is bounded, so that two of its quantiles
    bracket each quartile. The second counts what lies between the brackets and
    groups the values inside them, a few in 10,000 of all; they are ranked by a
    range-partitioned sort, so no bracket is one task's work.
    """
    columns = numeric_columns(df) if columns is None else as_list(columns)
    values = df.select(*[_number(c).alias(f"v{i}") for i, c in enumerate(columns)])
    rows = []
    for i, (name, row) in enumerate(zip(columns, _moments(values, len(columns)))):
        rows.append(row | {"column_name": name, "column": i})
    for row, found in zip(rows, _quartiles(values, rows)):
        row.update(found)
    order = ("column_name", "count", "mean", "std", "min", *_QUARTILES, "max")
    kinds = ", ".join(f"{n} {_KINDS.get(n, 'double')}" for n in order)
    return df.sparkSession.createDataFrame([[row[n] for n in order] for row in rows], kinds)


_KINDS = {"column_name": "string", "count": "long"}
# Up to this many values a column is one bracket; beyond it, the share of values on
# either side of a quartile that the sketch's error cannot exceed.
_FEW = 100_000
_ACCURACY = 10_000
_SLACK = 2 / _ACCURACY


def _number(name: str) -> Column:
    """The column as a double, NULL where it is NaN."""
    value = col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _moments(values: DataFrame, width: int) -> list[dict]:
    """Per column its moments and sketched values (low, high) around each quartile."""
    shares = [min(1.0, max(0.0, p + d)) for p in _QUARTILES.values() for d in (-_SLACK, _SLACK)]

    def facts(i: int) -> Column:
        v = F.col(f"v{i}")
        return F.struct(
            F.count(v).alias("count"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
            F.percentile_approx(v, shares, _ACCURACY).alias("brackets"),
        ).alias(f"f{i}")

    if not width:
        return []
    return [fact.asDict() for fact in values.agg(*[facts(i) for i in range(width)]).first()]


def _brackets(row: dict) -> list[tuple[float, float]]:
    """Closed intervals of values that hold the ranks next to the quartiles, in order and apart."""
    if row["count"] <= _FEW:
        return [(row["min"], row["max"])]
    apart: list[tuple[float, float]] = []
    for k in range(len(_QUARTILES)):
        low, high = row["brackets"][2 * k : 2 * k + 2]
        if apart and low <= apart[-1][1]:
            apart[-1] = (apart[-1][0], max(high, apart[-1][1]))
        else:
            apart.append((low, high))
    return apart


def _cell(row: dict) -> Column:
    """(column, cell, value): odd cells are brackets and keep their values, even ones lie
    below the bracket that follows. NULL beyond the last bracket."""
    value = F.col(f"v{row['column']}")

    def entry(cell: int, kept: Column) -> Column:
        number = F.lit(row["column"]).alias("column")
        return F.struct(number, F.lit(cell).alias("cell"), kept.alias("value"))

    chosen = F.when(value.isNull(), None)
    for i, (low, high) in enumerate(_brackets(row)):
        chosen = chosen.when(value < F.lit(low), entry(2 * i, F.lit(None).cast("double")))
        chosen = chosen.when(value <= F.lit(high), entry(2 * i + 1, value))
    return chosen


def _quartiles(values: DataFrame, rows: list[dict]) -> list[dict]:
    """The quartiles of each column, NULL where it has no values."""
    held = [row for row in rows if row["count"]]
    ranks = {row["column"]: _ranks(row["count"]) for row in held}
    found: dict[tuple[int, int], float] = {}
    if held:
        cells = values.select(F.explode(F.array_compact(F.array(*map(_cell, held)))).alias("c"))
        counts = cells.groupBy("c.column", "c.cell", "c.value").agg(F.count(F.lit(1)).alias("n"))
        for r in _at_ranks(counts, ranks).collect():
            found[r["column"], r["rank"]] = r["value"]
    out = []
    for row in rows:
        own = {}
        for label, share in _QUARTILES.items():
            at, c = (row["count"] - 1) * share, row["column"]
            between = row["count"] and _between(found[c, floor(at)], found[c, ceil(at)], at - floor(at))
            own[label] = between if row["count"] else None
        out.append(own)
    return out


def _ranks(count: int) -> list[int]:
    """The 0-based ranks on either side of each quartile."""
    places = [(count - 1) * share for share in _QUARTILES.values()]
    return sorted({f(at) for at in places for f in (floor, ceil)})


def _at_ranks(counts: DataFrame, ranks: dict[int, list[int]]) -> DataFrame:
    """``column, rank, value`` of the wanted ranks among counted cells.

    Cells are put in order by a range-partitioned sort. Sums per partition and column
    give where each partition starts, and rows are added up inside partitions.
    """
    ordered = in_global_order(counts, ["column", "cell", "value"], "quartile-cells")
    table, part = ordered.table, ordered.part
    sums = table.groupBy(part, "column").agg(F.sum("n").alias("size"))
    earlier = Window.partitionBy("column").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One short row per partition and column.
    starts = sums.select(part, "column", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    upto = F.sum("n").over(Window.partitionBy(part, "column").orderBy(ordered.pos))
    ends = table.withColumn("upto", upto).join(F.broadcast(starts), [part, "column"])
    end = F.col("start") + F.col("upto")
    wanted = F.create_map(
        *[F.lit(x) if isinstance(x, int) else F.array(*map(F.lit, x)) for pair in ranks.items() for x in pair]
    )
    own = F.filter(wanted[F.col("column")], lambda r: (r >= end - F.col("n")) & (r < end))
    return ends.select("column", "value", F.explode(own).alias("rank"))


def _between(low: float, high: float, share: float) -> float:
    """Linear interpolation that leaves a rank of no weight out (0 times infinity)."""
    return low if not share or low == high else low * (1 - share) + high * share
