"""Fact tables and the joins that build them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import standins as s
from starloom.catalog.registry import query, table
from starloom.operators import bucketed_lookup_join, lookup_join
from starloom.plans import cleaning
from starloom.plans.dimensions import (
    calendar_dimension,
    state_population,
    visa_type_dimension,
)
from starloom.plans.facts import fact_table, immigration_fact, star_join
from starloom.scratch import materialise, scratch_path
from starloom.sources import register, write_bucketed


@query(
    """
    select o_orderkey as record_id, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           visa_type_key
    from orders join (
        select o_orderpriority, row_number() over (order by o_orderpriority) - 1 as visa_type_key
        from (select distinct o_orderpriority from orders)
    ) using (o_orderpriority)
    """
)
def fact_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "visatype")
    return fact_table(
        orders, {"visatype": visa_type_dimension(orders)}, {"o_orderkey": "record_id"}
    )


@query(s.FACT)
def fact_key_null_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.IMMIGRATION.apply(s.arrivals(spark, sf_dir))
    return immigration_fact(clean, visa_type_dimension(clean))


@query(
    f"""
    select visa_type_key, count(*) as arrivals from ({s.FACT}) group by 1
    """
)
def arrivals_by_visa_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.IMMIGRATION.apply(s.arrivals(spark, sf_dir))
    fact = immigration_fact(clean, visa_type_dimension(clean))
    return fact.groupBy("visa_type_key").agg(F.count(F.lit(1)).alias("arrivals"))


_LINE_PARTS = """
    select l_linenumber, l_shipdate, l_quantity, l_part, p_brand, p_size
    from (select *, nullif(l_partkey, 0) as l_part from lineitem)
         left join part on l_part = p_partkey
"""


@query(_LINE_PARTS)
def lookup_join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_parts(spark, sf_dir)


@query(_LINE_PARTS)
def lookup_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_parts(spark, sf_dir, broadcast_bytes=8000, hot_share=0.0005)


@query(_LINE_PARTS)
def lookup_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = _lines_and_parts(spark, sf_dir)
    lines = write_bucketed(lines, scratch_path(spark, "lines"), "l_part")
    part = write_bucketed(part, scratch_path(spark, "parts"), "p_partkey")
    return bucketed_lookup_join(lines, part, {"l_part": "p_partkey"})


def _line_parts(spark: SparkSession, sf_dir: str, **options: float) -> DataFrame:
    lines, part = _lines_and_parts(spark, sf_dir)
    return lookup_join(lines, part, {"l_part": "p_partkey"}, **options)


def _lines_and_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_linenumber",
        "l_shipdate",
        "l_quantity",
        F.nullif(F.col("l_partkey"), F.lit(0)).alias("l_part"),
    )
    return lines, table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")


@query(
    """
    select o_orderkey, first_line
    from orders left join (
        select l_orderkey, min(l_linenumber) as first_line from lineitem group by 1
    ) on o_orderkey = l_orderkey
    """
)
def lookup_join_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("first_line")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return lookup_join(orders, lines, {"o_orderkey": "l_orderkey"}, duplicates="first")


@query(
    """
    select distinct c_nationkey as country_code, n_name as country_name
    from customer left join nation on c_nationkey = n_nationkey
    """
)
def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(
        starloom_customers=table(spark, sf_dir, "customer"),
        starloom_nations=table(spark, sf_dir, "nation"),
    )
    return spark.sql(
        """
        SELECT c_nationkey AS country_code, n_name AS country_name
        FROM (SELECT DISTINCT c_nationkey FROM starloom_customers)
        LEFT JOIN starloom_nations ON c_nationkey = n_nationkey
        """
    )


@query(
    f"""
    select f.*, arrival_day, arrival_week, arrival_month, arrival_year, arrival_weekday,
           country_name, round(average_temperature, 4) as average_temperature, visatype,
           total_population
    from ({s.FACT}) f
         left join ({s.CALENDAR}) c on f.arrdate = c.arrdate
         left join ({s.COUNTRIES}) on country_residence_code = country_code
         left join ({s.VISA_TYPES}) v on f.visa_type_key = v.visa_type_key
         left join ({s.STATES}) p on f.state_code = p.state_code
    """
)
def star_with_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.IMMIGRATION.apply(s.arrivals(spark, sf_dir))
    visa_types = materialise(visa_type_dimension(clean), "visatype")
    countries = materialise(s.countries(spark, sf_dir, clean), "country")
    people = cleaning.DEMOGRAPHICS.apply(s.demographics(spark, sf_dir)).withColumnsRenamed(
        {"State Code": "state_code", "Total Population": "total_population"}
    )
    joined = star_join(
        immigration_fact(clean, visa_types),
        calendar_dimension(clean),
        countries,
        visa_types,
        state_population(people),
    )
    return joined.withColumn("average_temperature", F.round("average_temperature", 4))
