"""Dimension tables on the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import standins as s
from starloom.catalog.registry import query, table
from starloom.functions import sas_days, sas_to_date, title_case
from starloom.operators import with_surrogate_key
from starloom.plans import cleaning
from starloom.plans.dimensions import (
    average_by,
    calendar_dimension,
    country_temperatures,
    demographics_dimension,
    member_dimension,
    state_population,
    visa_type_dimension,
)


@query(
    """
    select o_orderpriority as visatype,
           row_number() over (order by o_orderpriority) - 1 as visa_type_key
    from (select distinct o_orderpriority from orders)
    """
)
def visa_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return visa_type_dimension(orders.select(F.col("o_orderpriority").alias("visatype")))


@query(s.VISA_TYPES)
def visa_dim_null_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visa_type_dimension(s.arrivals(spark, sf_dir))


@query(
    """
    select o_custkey, o_orderkey,
           row_number() over (order by o_custkey, o_orderkey) - 1 as id
    from orders
    """
)
def surrogate_key_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return with_surrogate_key(orders, ["o_custkey", "o_orderkey"])


@query(
    """
    select l_returnflag, l_linestatus, l_linenumber,
           row_number() over (order by l_returnflag, l_linestatus, l_linenumber) - 1 as id
    from (select distinct l_returnflag, l_linestatus, l_linenumber from lineitem)
    """
)
def member_dim_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return member_dimension(table(spark, sf_dir, "lineitem"), columns, "id")


@query(
    """
    with numbers as (
        select o_orderkey,
               cast(cast(o_orderdate as date) - date '1960-01-01' as integer) as days,
               cast(cast(o_orderdate as date) - date '1998-01-01' as integer) as offs
        from orders
    )
    select o_orderkey,
           date '1960-01-01' + days as arrival,
           date '1960-01-01' + nullif(offs, 0) as zero_is_null,
           date '1960-01-01' + offs as zero_is_a_day,
           date '1960-01-01' + offs as fraction_floored
    from numbers
    """
)
def sas_date_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = sas_days(F.col("o_orderdate"))
    offset = F.datediff("o_orderdate", F.lit("1998-01-01")).cast("double")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        sas_to_date(days).alias("arrival"),
        sas_to_date(offset).alias("zero_is_null"),
        sas_to_date(offset, zero_is_null=False).alias("zero_is_a_day"),
        sas_to_date(offset + 0.5).alias("fraction_floored"),
    )


@query(s.CALENDAR)
def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return calendar_dimension(orders.select(sas_days(F.col("o_orderdate")).alias("arrdate")))


@query(
    """
    select event_date, cast(day(event_date) as integer) as event_day,
           cast(weekofyear(event_date) as integer) as event_week,
           cast(month(event_date) as integer) as event_month,
           cast(year(event_date) as integer) as event_year,
           cast(dayofweek(event_date) + 1 as integer) as event_weekday,
           row_number() over (order by event_date) - 1 as id
    from (select distinct cast(ts as date) as event_date from events)
    """
)
def calendar_from_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("ts").alias("event_date"))
    return calendar_dimension(events, "event_date", "event", sas=False)


@query(
    """
    select n_name, round(avg(s_acctbal), 4) as average_balance
    from supplier join nation on s_nationkey = n_nationkey group by 1
    """
)
def country_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = average_by(table(spark, sf_dir, "supplier"), "s_nationkey", "s_acctbal", "average")
    nation = table(spark, sf_dir, "nation")
    return averages.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "n_name", F.round("average", 4).alias("average_balance")
    )


@query(
    f"""
    select "Country", round(average_temperature, 4) as average_temperature
    from ({s.TEMPERATURES})
    """
)
def temperature_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.TEMPERATURE.apply(s.readings(spark, sf_dir))
    return country_temperatures(clean).withColumn(
        "average_temperature", F.round("average_temperature", 4)
    )


@query(
    f"""
    select country_code, country_name, round(average_temperature, 4) as average_temperature
    from ({s.COUNTRIES})
    """
)
def country_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = s.countries(spark, sf_dir, s.arrivals(spark, sf_dir))
    return dimension.withColumn("average_temperature", F.round("average_temperature", 4))


@query(
    """
    select p_partkey,
           array_to_string(
               [upper(x[1]) || lower(x[2:])
                for x in regexp_extract_all(words, '[A-Za-z]+|[^A-Za-z]+')], '') as title
    from (select p_partkey,
                 upper(p_type) || '-' || p_name || ', o''' || upper(p_brand) as words from part)
    """
)
def title_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.concat(F.upper("p_type"), F.lit("-"), "p_name", F.lit(", o'"), F.upper("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", title_case(words).alias("title"))


_DEMOGRAPHICS_DIM = f"""
    select "City", "State", "Median Age" as median_age, "Male Population" as male_population,
           "Female Population" as female_population, "Total Population" as total_population,
           "Number of Veterans" as number_of_veterans, "Foreign-born" as foreign_born,
           "Average Household Size" as average_household_size, "State Code" as state_code,
           "Race", "Count",
           row_number() over (order by "City", "State", "State Code", "Race") - 1 as id
    from ({s.CLEAN_DEMOGRAPHICS})
"""


@query(_DEMOGRAPHICS_DIM)
def demographics_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.DEMOGRAPHICS.apply(s.demographics(spark, sf_dir))
    return demographics_dimension(clean)


@query(s.STATES)
def state_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.DEMOGRAPHICS.apply(s.demographics(spark, sf_dir))
    renamed = clean.withColumnsRenamed(
        {"State Code": "state_code", "Total Population": "total_population"}
    )
    return state_population(renamed)
