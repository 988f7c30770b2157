"""Row and column cleaning on the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import standins as s
from starloom.catalog.registry import query, table
from starloom.operators import (
    dedup,
    distinct_values,
    drop_empty_rows,
    drop_incomplete_rows,
    drop_sparse_columns,
    missing_profile,
    only_missing,
    peek,
    rename,
    sparse_rows,
    with_missing_count,
)
from starloom.plans import cleaning
from starloom.plans.cleaning import Cleaning


def gappy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in which zero discounts and taxes, and one flag, are unknown."""
    return table(spark, sf_dir, "lineitem").withColumns(
        {
            "l_discount": F.nullif(F.col("l_discount"), F.lit(0.0)),
            "l_tax": F.nullif(F.col("l_tax"), F.lit(0.0)),
            "l_returnflag": F.nullif(F.col("l_returnflag"), F.lit("N")),
        }
    )


GAPPY = """
    select * replace (nullif(l_discount, 0.0) as l_discount, nullif(l_tax, 0.0) as l_tax,
                      nullif(l_returnflag, 'N') as l_returnflag)
    from lineitem
"""


@query(f"select * from ({GAPPY}) where l_discount is not null and l_returnflag is not null")
def dropna_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_incomplete_rows(gappy_lines(spark, sf_dir), ["l_discount", "l_returnflag"])


@query(
    f"""
    select l_discount, l_tax, l_returnflag from ({GAPPY})
    where l_discount is not null or l_tax is not null or l_returnflag is not null
    """
)
def dropna_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_empty_rows(gappy_lines(spark, sf_dir).select("l_discount", "l_tax", "l_returnflag"))


@query(
    f"""
    select * from ({GAPPY})
    where l_discount is not null or l_tax is not null or l_returnflag is not null
    """
)
def dropna_all_of_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_empty_rows(gappy_lines(spark, sf_dir), ["l_discount", "l_tax", "l_returnflag"])


@query("select * exclude (l_linenumber) from lineitem")
def drop_sparse_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    rare = F.when(F.col("l_linenumber") < 0, F.col("l_linenumber"))
    return drop_sparse_columns(lines.withColumn("l_linenumber", rare), 0.9)


@query(
    f"""
    select *, cast((l_discount is null)::int + (l_tax is null)::int
                   + (l_returnflag is null)::int as integer) as n_missing
    from (select l_orderkey, l_discount, l_tax, l_returnflag from ({GAPPY}))
    """
)
def row_missing_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = gappy_lines(spark, sf_dir)
    return with_missing_count(lines.select("l_orderkey", "l_discount", "l_tax", "l_returnflag"))


@query(
    f"""
    select * from (select l_discount, l_tax, l_returnflag from ({GAPPY}))
    where (l_discount is null)::int + (l_tax is null)::int + (l_returnflag is null)::int > 1.5
    """
)
def rows_mostly_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_rows(gappy_lines(spark, sf_dir).select("l_discount", "l_tax", "l_returnflag"))


@query(
    """
    select * from lineitem
    qualify row_number() over (
        partition by l_orderkey, l_linenumber
        order by l_shipdate desc, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                 l_tax, l_returnflag, l_linestatus
    ) = 1
    """
)
def dedup_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return dedup(lines, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@query("select distinct l_orderkey, l_linenumber from lineitem")
def dedup_any_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return dedup(lines, keys, survivor="any").select(*keys)


@query("select distinct nullif(event_type, 'view') as event_type from events")
def distinct_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kinds = events.select(F.nullif(F.col("event_type"), F.lit("view")).alias("event_type"))
    return distinct_values(kinds, "event_type")


@query("select distinct event_type from events order by 1 limit 5")
def distinct_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = distinct_values(table(spark, sf_dir, "events"), "event_type")
    return peek(kinds, 5, "event_type")


@query("select * from events order by value desc, event_id limit 5")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").orderBy(F.desc("value"), "event_id").limit(5)


@query(
    """
    select p_partkey as part_key, p_name as part_name, p_size as size,
           cast(p_size as varchar) as size_text, p_retailprice * p_size as stock_value
    from part
    """
)
def rename_and_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").drop("p_brand", "p_type")
    named = rename(part, {"p_partkey": "part_key", "p_name": "part_name", "p_size": "size"})
    return named.withColumns(
        {
            "size_text": F.col("size").cast("string"),
            "stock_value": F.col("p_retailprice") * F.col("size"),
        }
    ).drop("p_retailprice")


@query(f"select * exclude (occup) from ({s.RAW_ARRIVALS}) where i94yr is not null")
def clean_immigration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.IMMIGRATION.apply(s.raw_arrivals(spark, sf_dir))


@query(
    f"""
    select * exclude (occup) from ({s.RAW_ARRIVALS}) where cicid is not null
    qualify row_number() over (partition by cicid order by depdate) = 1
    """
)
def clean_immigration_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.IMMIGRATION_RECORDS.apply(s.raw_arrivals(spark, sf_dir))


@query(s.CLEAN_READINGS)
def clean_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.TEMPERATURE.apply(s.readings(spark, sf_dir))


@query(s.CLEAN_DEMOGRAPHICS)
def clean_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.DEMOGRAPHICS.apply(s.demographics(spark, sf_dir))


def _report(source: str, present: str, keys: str | None) -> str:
    kept = f"select * from ({source}) where {present}"
    out = f"select distinct {keys} from ({kept})" if keys else kept
    return f"""
        select rows_in, rows_in - kept as dropped_missing, kept - rows_out as dropped_duplicates,
               rows_out
        from (select (select count(*) from ({source})) as rows_in,
                     (select count(*) from ({kept})) as kept,
                     (select count(*) from ({out})) as rows_out)
    """


@query(_report(s.RAW_ARRIVALS, "i94yr is not null", None))
def immigration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.IMMIGRATION.report(s.raw_arrivals(spark, sf_dir))


@query(_report(s.RAW_ARRIVALS, "cicid is not null", "cicid"))
def immigration_records_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.IMMIGRATION_RECORDS.report(s.raw_arrivals(spark, sf_dir))


def _lines_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("l_returnflag") == "A", F.lit("NaN").cast("double"))
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_discount", "l_tax")
    return lines.withColumns(
        {
            "l_discount": odd.otherwise(F.col("l_discount")),
            "l_tax": F.nullif(F.col("l_tax"), F.lit(0.0)),
        }
    )


@query(
    """
    select 'l_discount' as column_name, count_if(l_returnflag = 'A') as missing,
           round(100.0 * count_if(l_returnflag = 'A') / count(*), 6) as pct_missing from lineitem
    union all
    select 'l_tax', count_if(l_tax = 0.0), round(100.0 * count_if(l_tax = 0.0) / count(*), 6)
    from lineitem
    """
)
def missing_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = only_missing(missing_profile(_lines_with_nan(spark, sf_dir)))
    return profile.select("column_name", "missing", F.round("pct_missing", 6).alias("pct_missing"))


@query(
    """
    select l_returnflag, count(*) as n from lineitem
    where l_returnflag <> 'A' and l_tax <> 0.0 group by 1
    """
)
def dropna_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_incomplete_rows(_lines_with_nan(spark, sf_dir), ["l_discount", "l_tax"])
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(_report(GAPPY, "l_discount is not null", "l_orderkey, l_linenumber"))
def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Cleaning(required=("l_discount",), unique_by=("l_orderkey", "l_linenumber"))
    return rule.report(gappy_lines(spark, sf_dir))


@query(
    _report(
        f"select l_discount, l_tax, l_returnflag from ({GAPPY})",
        "l_discount is not null or l_tax is not null or l_returnflag is not null",
        None,
    )
)
def cleaning_report_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = gappy_lines(spark, sf_dir).select("l_discount", "l_tax", "l_returnflag")
    return Cleaning(empty_rows=True).report(lines)


@query(_report(s.READINGS, '"AverageTemperature" is not null', 'dt, "City", "Country"'))
def temperature_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.TEMPERATURE.report(s.readings(spark, sf_dir))


@query(
    _report(
        s.DEMOGRAPHICS,
        '"Number of Veterans" is not null',
        '"City", "State", "State Code", "Race"',
    )
)
def demographics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.DEMOGRAPHICS.report(s.demographics(spark, sf_dir))
