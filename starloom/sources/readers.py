"""Reading raw tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.names import as_list, col


def read_table(
    spark: SparkSession,
    paths: str | Iterable[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read one or many paths of any format the session knows, as one table."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(as_list(paths))


def read_csv(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    malformed: str | None = None,
) -> DataFrame:
    """Read CSV with a header row.

    With a schema the whole header is checked against it, whatever columns are used
    later, and no inference job runs; without one the types are inferred, which
    scans the files once more. With a schema a line that does not fit it, in a cell
    or in the number of cells, fails the read; or else ``malformed`` names a text column
    that holds such lines, and is NULL for all others (Spark refuses a query that uses
    that column alone).
    """
    options = {"header": True, "sep": sep, "encoding": encoding}
    if schema is None:
        return read_table(spark, paths, "csv", inferSchema=True, **options)
    options |= {"enforceSchema": False, "columnPruning": False, "mode": "FAILFAST"}
    if malformed is not None:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": malformed}
    return read_table(spark, paths, "csv", schema, **options)


def read_many(
    spark: SparkSession,
    paths: Iterable[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read monthly tables whose columns may differ, matching columns by name.

    A column a month lacks reads as NULL. With a schema each month's columns are cast
    to its types, whatever the month stored, so months agree; a value that does not
    fit fails the read. Columns beyond the schema are kept. CSV months are read as text under their own
    header and need a schema for other types. Only footers and headers are opened here.
    """
    if fmt == "csv":
        options = {"header": True} | options
    months = [read_table(spark, path, fmt, **options) for path in paths]
    if schema is not None:
        months = [conform(month, schema) for month in months]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), months)


def conform(df: DataFrame, schema: T.StructType | str, cast: str = "cast") -> DataFrame:
    """The schema's columns in its order and types (NULL if absent), then all others.

    A value that does not fit fails, or is NULL with ``cast="try_cast"``.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    have = {f.name: f.dataType for f in df.schema.fields}

    def declare(f: T.StructField) -> Column:
        if have.get(f.name) == f.dataType:
            # Not renamed: filters over many renamed columns are slow to optimise.
            return col(f.name)
        value = col(f.name) if f.name in have else F.lit(None)
        return getattr(value, cast)(f.dataType).alias(f.name)

    declared = [declare(f) for f in schema.fields]
    return df.select(*declared, *[col(c) for c in df.columns if c not in schema.names])


def read_with_rejects(
    spark: SparkSession,
    paths: Iterable[str],
    schema: T.StructType | str,
    fmt: str = "parquet",
    **options: str,
) -> tuple[DataFrame, DataFrame]:
    """:func:`read_many` that keeps rows with values that do not fit apart, instead of failing.

    Returns the rows in which every value fits its declared type, and one reject per other
    row: ``file_path``, ``reasons`` (``column: value is not a type``, one per cell that
    does not fit) and ``row``, all its cells as JSON. A column a month lacks, and NULL,
    always fit. Both are plans over the files and read them when they are used.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if fmt == "csv":
        options = {"header": True} | options
    kept, rejects = [], []
    for path in paths:
        month = read_table(spark, path, fmt, **options)
        reasons = F.array_compact(F.array(*[_misfit(month.schema[f.name], f) for f in schema.fields if f.name in month.columns]))
        reasons = F.coalesce(reasons, F.array().cast("array<string>"))
        kept.append(conform(month.where(F.size(reasons) == 0), schema, "try_cast"))
        rejects.append(
            month.where(F.size(reasons) > 0).select(
                F.col("_metadata.file_path").alias("file_path"),
                reasons.alias("reasons"),
                F.to_json(F.struct(*[col(c) for c in month.columns])).alias("row"),
            )
        )
    good = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept)
    return good, reduce(DataFrame.unionByName, rejects)


def _misfit(have: T.StructField, want: T.StructField) -> Column:
    """Why the stored value does not fit, NULL if it does."""
    if have.dataType == want.dataType:
        return F.lit(None).cast("string")
    value = col(have.name)
    told = F.concat(F.lit(f"{want.name}: "), value.cast("string"), F.lit(f" is not a {want.dataType.simpleString()}"))
    return F.when(value.isNotNull() & value.try_cast(want.dataType).isNull(), told)


def fits(df: DataFrame, schema: T.StructType | str) -> bool:
    """True if no column that ``df`` shares with the schema has another type."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    have = {f.name: f.dataType for f in df.schema.fields}
    return all(have.get(f.name, f.dataType) == f.dataType for f in schema.fields)


def register(**tables: DataFrame) -> None:
    """Create or replace a temporary view per keyword, for use in SQL text."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
