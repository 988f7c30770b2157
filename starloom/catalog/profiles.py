"""Profiles of the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog.cleaning import GAPPY, gappy_lines
from starloom.catalog.registry import query, table
from starloom.operators import (
    column_overview,
    describe,
    missing_profile,
    missing_profile_of_files,
    only_missing,
    shape,
)
from starloom.scratch import scratch_path

_LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)
_MISSING = " union all ".join(
    f"""
    select '{c}' as column_name, count(*) - count({c}) as missing,
           100.0::double * (count(*) - count({c})) / count(*) as pct_missing, count(*) as n_rows
    from ({GAPPY})
    """
    for c in _LINE_COLUMNS
)


@query(
    f"select column_name, missing, round(pct_missing, 6) as pct_missing, n_rows from ({_MISSING})"
)
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = missing_profile(gappy_lines(spark, sf_dir))
    return profile.withColumn("pct_missing", F.round("pct_missing", 6))


@query(
    f"""
    select column_name, missing, round(pct_missing, 6) as pct_missing, n_rows
    from ({_MISSING}) where pct_missing > 0
    """
)
def missing_values_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = only_missing(missing_profile(gappy_lines(spark, sf_dir)))
    return profile.withColumn("pct_missing", F.round("pct_missing", 6))


_MORE_GAPS = f"select * replace (nullif(l_linenumber, 1) as l_linenumber, nullif(l_suppkey, 1) as l_suppkey) from ({GAPPY})"


@query(
    " union all ".join(
        f"""
        select '{c}' as column_name, count(*) - count({c}) as missing,
               round(100.0::double * (count(*) - count({c})) / count(*), 6) as pct_missing, count(*) as n_rows
        from ({_MORE_GAPS})
        """
        for c in _LINE_COLUMNS
    )
)
def missing_values_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gappy-lines")
    gaps = {c: F.nullif(F.col(c), F.lit(1)) for c in ("l_linenumber", "l_suppkey")}
    gappy_lines(spark, sf_dir).withColumns(gaps).write.parquet(path)
    return missing_profile_of_files(spark, path).withColumn("pct_missing", F.round("pct_missing", 6))


def _statistics(source: str, columns: tuple[str, ...]) -> str:
    return " union all ".join(
        f"""
        select '{c}' as column_name, count({c}) as "count", round(avg({c}), 4) as mean,
               round(stddev_samp({c}), 4) as std, round(min({c}), 4) as min,
               round(quantile_cont({c}, 0.25), 4) as p25,
               round(quantile_cont({c}, 0.5), 4) as p50,
               round(quantile_cont({c}, 0.75), 4) as p75, round(max({c}), 4) as max
        from ({source})
        """
        for c in columns
    )


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _rounded(statistics: DataFrame) -> DataFrame:
    names = ("mean", "std", "min", "p25", "p50", "p75", "max")
    return statistics.withColumns({n: F.round(n, 4) for n in names})


@query(_statistics(GAPPY, _MEASURES))
def describe_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(describe(gappy_lines(spark, sf_dir), _MEASURES))


@query(_statistics("select value, cast(user_id as double) as user_id from events", ("value", "user_id")))
def describe_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(describe(table(spark, sf_dir, "events").select("value", "user_id")))


_TIED = """
    select case when l_orderkey % 10 < 3 then 0 when l_orderkey % 10 < 5 then 1
                when l_partkey % 1000 = 7 then 2 when l_orderkey % 10 < 7 then 3 else 4 end as steps,
           l_linenumber % 2 as odd
    from lineitem
"""


@query(_statistics(_TIED, ("steps", "odd")))
def describe_tied_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole brackets of equal values; the columns in the order that once failed."""
    tens, rare = F.col("l_orderkey") % 10, F.col("l_partkey") % 1000 == 7
    steps = F.when(tens < 3, 0).when(tens < 5, 1).when(rare, 2).when(tens < 7, 3).otherwise(4)
    lines = table(spark, sf_dir, "lineitem")
    return _rounded(describe(lines.select(steps.alias("steps"), (F.col("l_linenumber") % 2).alias("odd"))))


@query("select count(*) as n_rows, 11 as n_columns from lineitem")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(table(spark, sf_dir, "lineitem"))


@query(
    """
    with types(position, column_name, data_type) as (
        values (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'), (2, 'user_id', 'bigint'),
               (3, 'event_type', 'string'), (4, 'value', 'double'), (5, 'props', 'string')
    )
    select column_name, position, data_type, n_rows,
           case when column_name = 'event_type' then views else 0 end as missing
    from types, (select count(*) as n_rows,
                        count(*) filter (event_type = 'view') as views from events)
    """
)
def schema_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kind = F.nullif(F.col("event_type"), F.lit("view"))
    overview = column_overview(events.withColumn("event_type", kind))
    return overview.select("column_name", "position", "data_type", "n_rows", "missing")
