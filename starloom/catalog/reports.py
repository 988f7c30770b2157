"""The star schema's questions on the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import standins as s
from starloom.catalog.registry import query
from starloom.operators import rename
from starloom.plans import cleaning
from starloom.plans.dimensions import (
    DEMOGRAPHICS_NAMES,
    calendar_dimension,
    state_population,
    visa_type_dimension,
)
from starloom.plans.facts import FACT_NAMES, fact_table, immigration_fact
from starloom.plans.loads import load_month
from starloom.plans.reports import (
    climate_bands,
    climate_correlation,
    drilldown_of_counts,
    monthly_visitors_by_state,
    refresh_visit_counts,
    visit_drilldown,
    visits_on,
    write_fact_by_month,
)
from starloom.scratch import materialise, scratch_path


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.IMMIGRATION.apply(s.arrivals(spark, sf_dir))


def _fact(arrivals: DataFrame) -> DataFrame:
    """The fact's renamed columns and dates; reports that need no visa types build no more."""
    return fact_table(arrivals, {}, FACT_NAMES, "arrdate")


@query(
    f"""
    select case when average_temperature is not null then
               (average_temperature >= 20)::int + (average_temperature >= 25)::int
               + (average_temperature >= 30)::int end as band,
           sum(arrivals)::bigint as arrivals, count(*) as countries
    from (select country_residence_code as code, count(*) as arrivals from ({s.FACT}) group by 1)
         left join ({s.COUNTRIES}) on code = country_code
    group by 1
    """
)
def climate_vs_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = _arrivals(spark, sf_dir)
    return climate_bands(_fact(arrivals), s.countries(spark, sf_dir, arrivals), (20.0, 25.0, 30.0))


@query(
    f"""
    select count(*) as countries, round(corr(average_temperature, arrivals), 6) as correlation
    from (select country_residence_code as code, count(*) as arrivals from ({s.FACT}) group by 1)
         join ({s.COUNTRIES}) on code = country_code
    where average_temperature is not null
    """
)
def climate_arrivals_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = _arrivals(spark, sf_dir)
    found = climate_correlation(_fact(arrivals), s.countries(spark, sf_dir, arrivals))
    return found.withColumn("correlation", F.round("correlation", 6))


@query(
    f"""
    select f.*, total_population
    from (select state_code, cast(year(arrdate) as integer) as year,
                 cast(month(arrdate) as integer) as month, count(*) as visitors
          from ({s.FACT}) group by 1, 2, 3) f
         left join ({s.STATES}) p on f.state_code = p.state_code
    """
)
def population_vs_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(_arrivals(spark, sf_dir))
    people = rename(cleaning.DEMOGRAPHICS.apply(s.demographics(spark, sf_dir)), DEMOGRAPHICS_NAMES)
    return monthly_visitors_by_state(fact, state_population(people))


_DRILLDOWN = f"""
    select visatype, arrival_year as year, arrival_month as month, arrival_week as week,
           cast(grouping(visatype, arrival_year, arrival_month, arrival_week) as integer) as level,
           count(*) as visits
    from ({s.FACT}) f
         left join ({s.CALENDAR}) c on f.arrdate = c.arrdate
         left join ({s.VISA_TYPES}) v on f.visa_type_key = v.visa_type_key
    group by rollup (visatype, arrival_year, arrival_month, arrival_week)
"""


@query(_DRILLDOWN)
def drilldown_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = _arrivals(spark, sf_dir)
    visa_types = materialise(visa_type_dimension(arrivals), "visatype")
    fact = immigration_fact(arrivals, visa_types)
    return visit_drilldown(fact, calendar_dimension(arrivals), visa_types)


@query(_DRILLDOWN)
def drilldown_after_second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drill-down from counts per load, of which the second refresh adds one."""
    arrivals = _arrivals(spark, sf_dir)
    visa_types = materialise(visa_type_dimension(arrivals), "visatype")
    fact = materialise(immigration_fact(arrivals, visa_types), "fact")
    path, counts = scratch_path(spark, "monthly"), scratch_path(spark, "visit-counts")
    for month, loaded in (("early", F.year("arrdate") < 1999), ("later", F.year("arrdate") >= 1999)):
        table = load_month(fact.where(loaded), path, month, "record_id")
        daily = refresh_visit_counts(spark, path, table, counts)
    return drilldown_of_counts(daily, calendar_dimension(arrivals), visa_types)


@query(
    f"""
    select f.arrdate, arrival_week, arrival_weekday, visa_type_key, count(*) as visits
    from ({s.FACT}) f join ({s.CALENDAR}) c on f.arrdate = c.arrdate
    where f.arrdate between date '1998-03-02' and date '1998-03-29' and arrival_weekday = 2
    group by all
    """
)
def drilldown_one_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mondays of one month; the calendar's condition prunes the folders of the fact."""
    arrivals = _arrivals(spark, sf_dir)
    visa_types = materialise(visa_type_dimension(arrivals), "visatype")
    fact = write_fact_by_month(immigration_fact(arrivals, visa_types), scratch_path(spark, "fact-by-month"))
    calendar = materialise(calendar_dimension(arrivals), "calendar")
    days = F.col("arrdate").between("1998-03-02", "1998-03-29") & (F.col("arrival_weekday") == 2)
    found = visits_on(fact, calendar, days)
    return found.groupBy("arrdate", "arrival_week", "arrival_weekday", "visa_type_key").agg(F.count(F.lit(1)).alias("visits"))
