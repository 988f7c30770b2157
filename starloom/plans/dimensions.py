"""Dimension tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import calendar_parts, sas_to_date
from starloom.functions.text import title_case
from starloom.names import as_list, col
from starloom.operators.columns import rename
from starloom.operators.dedup import distinct_values
from starloom.operators.joins import lookup_join
from starloom.operators.keys import with_surrogate_key

# Raw demographics headers and their column names in the dimension.
DEMOGRAPHICS_NAMES = {
    "Median Age": "median_age",
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Total Population": "total_population",
    "Number of Veterans": "number_of_veterans",
    "Foreign-born": "foreign_born",
    "Average Household Size": "average_household_size",
    "State Code": "state_code",
}
DEMOGRAPHICS_KEY = ("City", "State", "state_code", "Race")


def member_dimension(df: DataFrame, columns: str | Iterable[str], key: str) -> DataFrame:
    """Distinct members of ``columns`` with a dense key; NULL is a member too."""
    columns = as_list(columns)
    return with_surrogate_key(distinct_values(df, columns), columns, key)


def visa_type_dimension(df: DataFrame) -> DataFrame:
    return member_dimension(df, "visatype", "visa_type_key")


def calendar_dimension(
    df: DataFrame, day: str = "arrdate", prefix: str = "arrival", sas: bool = True
) -> DataFrame:
    """One row per day that occurs, with its calendar parts and a dense id.

    Days are reduced to distinct dates first, so the parts are computed once
    per date.
    """
    date = sas_to_date(col(day)) if sas else col(day).cast("date")
    dates = df.select(date.alias(day)).distinct()
    return with_surrogate_key(dates.withColumns(calendar_parts(col(day), prefix)), day, "id")


def average_by(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Average of ``value`` per ``group``; a NULL group is a group."""
    return df.groupBy(col(group)).agg(F.avg(col(value)).alias(name))


def country_temperatures(temperatures: DataFrame) -> DataFrame:
    return average_by(temperatures, "Country", "AverageTemperature", "average_temperature")


def country_dimension(
    arrivals: DataFrame,
    country_codes: DataFrame,
    temperatures: DataFrame,
    code: str = "i94res",
    measure: str = "average_temperature",
) -> DataFrame:
    """One row per country code that occurs: ``country_code, country_name, <measure>``.

    ``country_codes`` holds ``code, Name``; ``temperatures`` one row per
    ``Country``, matched to the title-cased name, and should be a written table,
    see :func:`~starloom.operators.joins.lookup_join`. The codes are reduced to
    distinct ones before any join, so no join sees the arrivals. An unknown code
    has no name, and a name without temperatures no average.
    """
    members = distinct_values(arrivals, code).withColumnRenamed(code, "country_code")
    named = lookup_join(members, country_codes, {"country_code": "code"}, duplicates="first")
    named = named.select("country_code", title_case(F.col("Name")).alias("country_name"))
    return lookup_join(named, temperatures, {"country_name": "Country"}).select(
        "country_code", "country_name", measure
    )


def demographics_dimension(
    df: DataFrame,
    names: Mapping[str, str] = DEMOGRAPHICS_NAMES,
    natural_key: Iterable[str] = DEMOGRAPHICS_KEY,
) -> DataFrame:
    """The cleaned demographics under column names without blanks, with a dense id."""
    return with_surrogate_key(rename(df, names), natural_key, "id")


def state_population(demographics: DataFrame) -> DataFrame:
    """Total population per state: ``state_code, total_population``.

    The table has one row per city and race, each repeating the city's total,
    so cities are made distinct before they are added up.
    """
    cities = demographics.groupBy("state_code", "City").agg(
        F.max("total_population").alias("total_population")
    )
    return cities.groupBy("state_code").agg(F.sum("total_population").alias("total_population"))
