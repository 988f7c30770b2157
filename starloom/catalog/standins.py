"""The given tables in the shape of the four raw inputs, in Spark and in SQL.

Orders stand in for arrivals, line items for temperature readings, customers for
demographics and nations for country codes. The given tables hold no NULLs and
every key resolves, so both are derived here, the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog.registry import table
from starloom.functions import sas_days, title_case
from starloom.operators import lookup_join
from starloom.plans import cleaning
from starloom.plans.dimensions import country_dimension, country_temperatures
from starloom.scratch import materialise


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    day = sas_days(F.col("o_orderdate"))
    return lookup_join(orders, customer, {"o_custkey": "c_custkey"}).select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.year("o_orderdate").cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        (F.col("c_nationkey") + 5).cast("double").alias("i94res"),
        day.alias("arrdate"),
        F.col("c_mktsegment").alias("i94addr"),
        (day + 14).alias("depdate"),
        F.lit(1.0).alias("count"),
        F.nullif(F.col("o_orderstatus"), F.col("o_orderstatus")).alias("occup"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("matflag"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("visatype"),
    )


ARRIVALS = """
    select cast(o_orderkey as double) as cicid,
           cast(year(o_orderdate) as double) as i94yr,
           cast(month(o_orderdate) as double) as i94mon,
           cast(c_nationkey + 5 as double) as i94res,
           cast(cast(o_orderdate as date) - date '1960-01-01' as double) as arrdate,
           c_mktsegment as i94addr,
           cast(cast(o_orderdate as date) - date '1960-01-01' as double) + 14 as depdate,
           1.0::double as "count",
           cast(null as varchar) as occup,
           nullif(o_orderstatus, 'P') as matflag,
           nullif(o_orderpriority, '5-LOW') as visatype
    from orders left join customer on o_custkey = c_custkey
"""


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with what cleaning is for: empty rows, records without an id, repeated
    records, and rows without a date or a residence."""
    given = arrivals(spark, sf_dir)
    empty = F.col("matflag").isNull()
    lacking = {"cicid": "2-HIGH", "arrdate": "3-MEDIUM", "i94res": "3-MEDIUM"}
    cells = []
    for name in given.columns:
        gone = empty | (F.col("visatype") == lacking[name]) if name in lacking else empty
        value = F.when(~F.coalesce(gone, F.lit(False)), F.col(name)).alias(name)
        # Only the column that cleaning drops first still has a value.
        cells.append(F.when(empty, F.lit("x")).alias(name) if name == "occup" else value)
    again = given.where((F.col("visatype") == "1-URGENT") & ~empty)
    return given.select(*cells).unionByName(again.withColumn("depdate", F.col("depdate") + 1))


_EMPTY = "matflag is null"
RAW_ARRIVALS = f"""
    select case when not ({_EMPTY}) and visatype is distinct from '2-HIGH' then cicid end as cicid,
           case when not ({_EMPTY}) then i94yr end as i94yr,
           case when not ({_EMPTY}) then i94mon end as i94mon,
           case when not ({_EMPTY}) and visatype is distinct from '3-MEDIUM' then i94res end as i94res,
           case when not ({_EMPTY}) and visatype is distinct from '3-MEDIUM' then arrdate end as arrdate,
           case when not ({_EMPTY}) then i94addr end as i94addr,
           case when not ({_EMPTY}) then depdate end as depdate,
           case when not ({_EMPTY}) then "count" end as "count",
           case when {_EMPTY} then 'x' end as occup,
           matflag,
           case when not ({_EMPTY}) then visatype end as visatype
    from ({ARRIVALS})
    union all
    select cicid, i94yr, i94mon, i94res, arrdate, i94addr, depdate + 1, "count", occup, matflag, visatype
    from ({ARRIVALS}) where visatype = '1-URGENT' and matflag is not null
"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), title_case(F.col("n_name")).alias("Country")
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
    )
    placed = supplier.join(nation, "s_nationkey", "left")
    return lookup_join(lines, placed, {"l_suppkey": "s_suppkey"}).select(
        F.col("l_shipdate").cast("date").alias("dt"),
        (F.nullif(F.col("l_discount"), F.lit(0.0)) * 300 + F.col("s_nationkey")).alias(
            "AverageTemperature"
        ),
        F.col("l_tax").alias("AverageTemperatureUncertainty"),
        F.concat(F.lit("City "), "l_suppkey").alias("City"),
        "Country",
        F.col("l_returnflag").alias("Latitude"),
        F.col("l_linestatus").alias("Longitude"),
    )


READINGS = """
    select cast(l_shipdate as date) as dt,
           nullif(l_discount, 0.0) * 300 + s_nationkey as "AverageTemperature",
           l_tax as "AverageTemperatureUncertainty",
           'City ' || l_suppkey as "City",
           'Nation_' || n_nationkey as "Country",
           l_returnflag as "Latitude",
           l_linestatus as "Longitude"
    from lineitem join supplier on l_suppkey = s_suppkey
         join nation on s_nationkey = n_nationkey
"""
CLEAN_READINGS = f"""
    select * from ({READINGS}) where "AverageTemperature" is not null
    qualify row_number() over (
        partition by dt, "City", "Country"
        order by "Latitude", "Longitude", "AverageTemperature", "AverageTemperatureUncertainty"
    ) = 1
"""
TEMPERATURES = f"""
    select "Country", avg("AverageTemperature") as average_temperature
    from ({CLEAN_READINGS}) group by 1
"""


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    return customer.select(
        F.concat(F.lit("City "), nation).alias("City"),
        F.lower("c_mktsegment").alias("State"),
        F.col("c_acctbal").alias("Median Age"),
        (nation * 10).alias("Male Population"),
        (nation * 11).alias("Female Population"),
        (nation * 21 + 100).alias("Total Population"),
        F.nullif(nation, F.lit(7)).alias("Number of Veterans"),
        (nation + 3).alias("Foreign-born"),
        (F.col("c_acctbal") / 1000).alias("Average Household Size"),
        F.col("c_mktsegment").alias("State Code"),
        F.concat(F.lit("Group "), F.floor(F.col("c_acctbal") / 100)).alias("Race"),
        F.col("c_custkey").cast("int").alias("Count"),
    )


DEMOGRAPHICS = """
    select 'City ' || c_nationkey as "City",
           lower(c_mktsegment) as "State",
           c_acctbal as "Median Age",
           cast(c_nationkey * 10 as integer) as "Male Population",
           cast(c_nationkey * 11 as integer) as "Female Population",
           cast(c_nationkey * 21 + 100 as integer) as "Total Population",
           nullif(c_nationkey, 7) as "Number of Veterans",
           cast(c_nationkey + 3 as integer) as "Foreign-born",
           c_acctbal / 1000 as "Average Household Size",
           c_mktsegment as "State Code",
           'Group ' || cast(floor(c_acctbal / 100) as bigint) as "Race",
           cast(c_custkey as integer) as "Count"
    from customer
"""
CLEAN_DEMOGRAPHICS = f"""
    select * from ({DEMOGRAPHICS}) where "Number of Veterans" is not null
    qualify row_number() over (
        partition by "City", "State", "State Code", "Race"
        order by "Median Age", "Male Population", "Female Population", "Total Population",
                 "Number of Veterans", "Foreign-born", "Average Household Size", "Count"
    ) = 1
"""
STATES = f"""
    select "State Code" as state_code, sum(people)::bigint as total_population
    from (select "State Code", "City", max("Total Population") as people
          from ({CLEAN_DEMOGRAPHICS}) group by 1, 2)
    group by 1
"""


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("Name")
    )


def countries(spark: SparkSession, sf_dir: str, arrivals: DataFrame) -> DataFrame:
    readings_kept = cleaning.TEMPERATURE.apply(readings(spark, sf_dir))
    averages = materialise(country_temperatures(readings_kept), "country-temperatures")
    return country_dimension(arrivals, country_codes(spark, sf_dir), averages)


VISA_TYPES = f"""
    select visatype, row_number() over (order by visatype nulls first) - 1 as visa_type_key
    from (select distinct visatype from ({ARRIVALS}))
"""
COUNTRIES = f"""
    select i94res as country_code, 'Nation_' || n_nationkey as country_name, average_temperature
    from (select distinct i94res from ({ARRIVALS}))
         left join nation on i94res = n_nationkey
         left join ({TEMPERATURES}) on 'Nation_' || n_nationkey = "Country"
"""
FACT = f"""
    select cicid as record_id, i94yr, i94mon, i94res as country_residence_code,
           date '1960-01-01' + cast(arrdate as integer) as arrdate, i94addr as state_code,
           depdate, "count", matflag, visa_type_key
    from ({ARRIVALS}) a left join ({VISA_TYPES}) v on a.visatype = v.visatype
"""
CALENDAR = f"""
    select arrdate,
           cast(day(arrdate) as integer) as arrival_day,
           cast(weekofyear(arrdate) as integer) as arrival_week,
           cast(month(arrdate) as integer) as arrival_month,
           cast(year(arrdate) as integer) as arrival_year,
           cast(dayofweek(arrdate) + 1 as integer) as arrival_weekday,
           row_number() over (order by arrdate nulls first) - 1 as id
    from (select distinct arrdate from ({FACT}))
"""
