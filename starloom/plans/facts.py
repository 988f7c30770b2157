"""Fact tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from starloom.functions.dates import sas_to_date
from starloom.names import as_list, col
from starloom.operators.columns import rename
from starloom.operators.joins import lookup_join, lookup_joins

# Raw immigration columns and their names in the fact table.
FACT_NAMES = {
    "cicid": "record_id",
    "i94res": "country_residence_code",
    "i94addr": "state_code",
}


def with_dimension_key(fact: DataFrame, dimension: DataFrame, natural_key: str) -> DataFrame:
    """Replace a member column by its dimension key; a NULL member has no key."""
    return lookup_join(fact, dimension, natural_key).drop(natural_key)


def fact_table(
    df: DataFrame,
    dimensions: Mapping[str, DataFrame],
    names: Mapping[str, str],
    sas_dates: str | Iterable[str] = (),
) -> DataFrame:
    """Rename, convert day numbers to dates, and swap members for keys.

    ``dimensions`` maps each member column to the dimension that holds it. The
    result has exactly the rows of ``df``.
    """
    fact = rename(df, names)
    fact = fact.withColumns({name: sas_to_date(col(name)) for name in as_list(sas_dates)})
    for natural_key, dimension in dimensions.items():
        fact = with_dimension_key(fact, dimension, natural_key)
    return fact


def immigration_fact(
    df: DataFrame, visa_types: DataFrame, sas_dates: Iterable[str] = ("arrdate",)
) -> DataFrame:
    """The immigration fact; ``depdate`` stays a day number unless listed."""
    return fact_table(df, {"visatype": visa_types}, FACT_NAMES, sas_dates)


def star_join(
    fact: DataFrame,
    calendar: DataFrame,
    country: DataFrame,
    visa_types: DataFrame,
    states: DataFrame,
) -> DataFrame:
    """The fact with the attributes of its four dimensions, one row per fact row.

    ``states`` must have one row per ``state_code``, see
    :func:`~starloom.plans.dimensions.state_population`; the demographics table
    itself has many and would multiply the fact.
    """
    return lookup_joins(
        fact,
        (calendar.drop("id"), "arrdate"),
        (country, {"country_residence_code": "country_code"}),
        (visa_types, "visa_type_key"),
        (states, "state_code"),
    )
