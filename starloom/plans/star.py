"""The whole run: raw files in, a checked star schema out."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import reduce
from typing import Any
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.names import as_list
from starloom.operators.columns import drop_columns
from starloom.operators.quality import check_row_counts, fail_if_any
from starloom.plans import cleaning
from starloom.plans.dimensions import (
    calendar_dimension,
    country_dimension,
    country_temperatures,
    demographics_dimension,
    visa_type_dimension,
)
from starloom.plans.facts import FACT_NAMES, immigration_fact
from starloom.scratch import materialise, scratch_path
from starloom.sources import (
    publish,
    read_csv,
    read_many,
    read_table,
    write_partitioned,
    write_table,
)
from starloom.sources.readers import fits
from starloom.sources.schemas import COUNTRY_CODES, DEMOGRAPHICS, IMMIGRATION, TEMPERATURE
from starloom.sources.versions import publish_version, read_version

_COLUMNAR = ("parquet", "orc")
# The calendar's folder levels.
CALENDAR_FOLDERS = ("arrival_year", "arrival_month", "arrival_week")
_CALENDAR_TASKS = 64


@dataclass(frozen=True)
class StarSources:
    """Where the raw data lies. Several immigration paths are read as one table."""

    immigration: str | tuple[str, ...]
    temperature: str
    demographics: str
    country_codes: str
    immigration_format: str = "parquet"


@dataclass(frozen=True)
class Star:
    """The five written tables."""

    immigration_fact: DataFrame
    immigration_calendar: DataFrame
    country: DataFrame
    visatype: DataFrame
    demographics: DataFrame
    #: What cleaning removed from each source, see :func:`cleaning_report`.
    cleaning: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {name: table for name, table in vars(self).items() if name != "cleaning"}

    def quality(self) -> DataFrame:
        """The row-count check of every table."""
        return check_row_counts(self.tables())


def cleaning_report(spark: SparkSession, sources: StarSources) -> DataFrame:
    """One row per cleaned source: ``source`` and what each step of its rule removed."""
    tables = {
        "immigration": (
            cleaning.IMMIGRATION,
            load_immigration(spark, sources.immigration, sources.immigration_format),
        ),
        "temperature": (cleaning.TEMPERATURE, read_csv(spark, sources.temperature, TEMPERATURE)),
        "demographics": (
            cleaning.DEMOGRAPHICS,
            read_csv(spark, sources.demographics, DEMOGRAPHICS, sep=";"),
        ),
    }
    reports = [
        rule.report(df).select(F.lit(name).alias("source"), "*") for name, (rule, df) in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def load_immigration(
    spark: SparkSession, paths: str | Iterable[str], fmt: str = "parquet"
) -> DataFrame:
    """The raw immigration table without its sparse columns, in a columnar format.

    Months are matched by column name and brought to the declared types. Several steps read a few columns each, so a row format is copied to Parquet
    first: the raw files are then decoded once for the whole run. So are months
    whose types differ from the declared ones.
    """
    paths = as_list(paths)
    raw = read_many(spark, paths, fmt, IMMIGRATION)
    raw = drop_columns(raw, cleaning.IMMIGRATION.columns)
    as_is = fmt in _COLUMNAR and all(fits(read_table(spark, p, fmt), IMMIGRATION) for p in paths)
    return raw if as_is else materialise(raw, "immigration")


def load_temperature(spark: SparkSession, path: str) -> cleaning.Counted:
    """The cleaned temperature table, with its counts."""
    return cleaning.TEMPERATURE.counted(read_csv(spark, path, TEMPERATURE))


def load_demographics(spark: SparkSession, path: str) -> cleaning.Counted:
    """The cleaned demographics table, with its counts."""
    return cleaning.DEMOGRAPHICS.counted(read_csv(spark, path, DEMOGRAPHICS, sep=";"))


def write_calendar(calendar: DataFrame, path: str) -> DataFrame:
    """Write the calendar by year, month and week: few rows, one folder per week."""
    tasks = min(calendar.sparkSession.sparkContext.defaultParallelism, _CALENDAR_TASKS)
    return write_partitioned(calendar, path, CALENDAR_FOLDERS, tasks=tasks)


def write_immigration_star(
    immigration: DataFrame,
    temperature: DataFrame,
    country_codes: DataFrame,
    output: str,
    counted: cleaning.Counted | None = None,
) -> dict[str, DataFrame]:
    """Write the fact and its visa-type, calendar and country dimensions.

    The raw table is read in full once, for the fact. Before that, the visa-type
    column is read for the dimension, which is read back so that the fact holds its
    keys, and rows without one are looked for until the first is found.
    The other two dimensions each read one column of the written fact, whose
    rows are the cleaned ones. What does not depend on each other runs at the
    same time, so one table's last tasks do not leave the cluster idle. ``counted`` are
    the cleaned immigration rows, if they are to be counted as the fact is written.
    """
    rule = cleaning.IMMIGRATION

    def visatype_and_fact() -> tuple[DataFrame, DataFrame]:
        types = visa_type_dimension(rule.distinct_column(immigration, "visatype"))
        visatype = write_table(types, f"{output}/visatype")
        fact = immigration_fact(counted.table if counted else rule.apply(immigration), visatype)
        return visatype, write_table(fact, f"{output}/immigration_fact")

    def averages() -> DataFrame:
        return materialise(country_temperatures(temperature), "country-temperatures")

    (visatype, fact), temperatures = at_once(visatype_and_fact, averages)

    def calendar() -> DataFrame:
        days = calendar_dimension(fact, "arrdate", sas=False)
        return write_calendar(days, f"{output}/immigration_calendar")

    def country() -> DataFrame:
        code = FACT_NAMES["i94res"]
        return write_table(
            country_dimension(fact, country_codes, temperatures, code), f"{output}/country"
        )

    days, countries = at_once(calendar, country)
    return {
        "immigration_fact": fact,
        "immigration_calendar": days,
        "country": countries,
        "visatype": visatype,
    }


def write_demographics(demographics: DataFrame, output: str) -> DataFrame:
    return write_table(demographics_dimension(demographics), f"{output}/demographics")


def build_star(
    spark: SparkSession,
    sources: StarSources,
    output: str,
    fail_on_empty: bool = False,
    versioned: bool = False,
) -> Star:
    """Read, clean, model, write, check and publish; every table at ``output`` is replaced.

    The tables are built in the scratch folder. Only when all are written, and with
    ``fail_on_empty`` none is empty, do they take the place of the old ones, so
    a bad month or a failed run leaves the old star as it was. They are moved one by one;
    with ``versioned`` they become a version that one pointer puts in force, and
    :func:`open_star` reads it, so the five tables change at once. What cleaning removed is
    counted by the jobs that write the tables, so the star's ``cleaning`` scans nothing;
    if one of their tasks had to run again, it is a query over the raw tables instead.
    """
    built, tag = scratch_path(spark, "star"), f"starloom-build-{uuid4().hex}"
    raw = load_immigration(spark, sources.immigration, sources.immigration_format)
    arrivals = cleaning.IMMIGRATION.counted(raw)
    readings = load_temperature(spark, sources.temperature)
    cities = load_demographics(spark, sources.demographics)

    def immigration_star() -> dict[str, DataFrame]:
        codes = read_csv(spark, sources.country_codes, COUNTRY_CODES)
        return write_immigration_star(raw, readings.table, codes, built, arrivals)

    def demographics() -> DataFrame:
        # Written first: the sort behind its keys computes its input twice.
        return write_demographics(materialise(cities.table, "cities"), built)

    spark.sparkContext.addJobTag(tag)
    try:
        tables, people = at_once(immigration_star, demographics)
    finally:
        spark.sparkContext.removeJobTag(tag)
    star = Star(**tables, demographics=people)
    if fail_on_empty:
        fail_if_any(star.quality())
    trusted = cleaning.ran_once(spark, tag)
    reports = [
        counted.report(trusted).select(F.lit(name).alias("source"), "*")
        for name, counted in (("immigration", arrivals), ("temperature", readings), ("demographics", cities))
    ]
    if versioned:
        published = publish_version(
            spark, output, {name: (table, f"{built}/{name}") for name, table in star.tables().items()}
        )
    else:
        published = {
            name: publish(table, f"{built}/{name}", f"{output}/{name}")
            for name, table in star.tables().items()
        }
    return Star(**published, cleaning=reduce(DataFrame.unionByName, reports))


def open_star(spark: SparkSession, output: str) -> Star:
    """The five tables of the version in force."""
    return Star(**read_version(spark, output))


def at_once(*steps: Callable[[], Any]) -> list[Any]:
    """Run steps whose Spark jobs are independent side by side.

    When one fails, the jobs of the others are cancelled.
    """
    session = SparkSession.getActiveSession()
    tag = f"starloom-{uuid4().hex}"
    with ThreadPoolExecutor(len(steps)) as pool:
        futures = [pool.submit(_in_session(session, tag, step)) for step in steps]
        done, _ = wait(futures, return_when=FIRST_EXCEPTION)
        failed = next((f for f in done if f.exception()), None)
        if failed and session:
            session.sparkContext.cancelJobsWithTag(tag)
            wait(futures)
            raise failed.exception()
        return [future.result() for future in futures]


def _in_session(
    session: SparkSession | None, tag: str, step: Callable[[], Any]
) -> Callable[[], Any]:
    """Carry the caller's local properties into the step's thread, and mark its jobs."""
    if session is None:
        return step

    def marked() -> Any:
        session.sparkContext.addJobTag(tag)
        return step()

    inherit = inheritable_thread_target(session)
    return inherit(marked) if callable(inherit) else marked
