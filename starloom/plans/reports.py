"""The questions the star schema answers.

Each report reduces the fact to one row per dimension key before it joins, so
the joins see key-sized tables and a popular key is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import calendar_parts
from starloom.plans.loads import MONTH
from starloom.sources.writers import exists, hadoop_path, read_partitioned, write_partitioned

# Lower edges, in °C, of the mild, warm and hot bands.
TEMPERATURE_BANDS = (10.0, 20.0, 25.0)
# Folder levels of a fact that is drilled into by month.
FACT_FOLDERS = ("arrival_year", "arrival_month")


def arrivals_per_country(fact: DataFrame, country: DataFrame) -> DataFrame:
    """Arrivals per residence code with the country's name and temperature."""
    arrivals = fact.groupBy(F.col("country_residence_code").alias("country_code")).agg(
        F.count(F.lit(1)).alias("arrivals")
    )
    return arrivals.join(country, "country_code", "left")


def climate_bands(
    fact: DataFrame, country: DataFrame, edges: Sequence[float] = TEMPERATURE_BANDS
) -> DataFrame:
    """Arrivals and countries per temperature band: ``band, arrivals, countries``.

    Band 0 lies below the first edge and band ``i`` starts at edge ``i``; the
    NULL band collects countries without a temperature.
    """
    temperature = F.col("average_temperature")
    passed = sum((F.when(temperature >= edge, 1).otherwise(0) for edge in edges), F.lit(0))
    return (
        arrivals_per_country(fact, country)
        .groupBy(F.when(temperature.isNotNull(), passed).alias("band"))
        .agg(F.sum("arrivals").alias("arrivals"), F.count(F.lit(1)).alias("countries"))
    )


def climate_correlation(fact: DataFrame, country: DataFrame) -> DataFrame:
    """Correlation between a country's average temperature and its arrivals."""
    return (
        arrivals_per_country(fact, country)
        .where(F.col("average_temperature").isNotNull())
        .agg(
            F.count(F.lit(1)).alias("countries"),
            F.corr("average_temperature", F.col("arrivals").cast("double")).alias("correlation"),
        )
    )


def monthly_visitors_by_state(fact: DataFrame, states: DataFrame) -> DataFrame:
    """Visitors per state and month beside the state's population."""
    visitors = fact.groupBy(
        "state_code", F.year("arrdate").alias("year"), F.month("arrdate").alias("month")
    ).agg(F.count(F.lit(1)).alias("visitors"))
    return visitors.join(states, "state_code", "left")


def visit_drilldown(fact: DataFrame, calendar: DataFrame, visa_types: DataFrame) -> DataFrame:
    """Visits by visa type, year, month and ISO week, with all subtotals.

    ``level`` is the grouping id: 0 for a week, then 1, 3 and 7 for the month,
    year and visa-type subtotals and 15 for the total. It tells a subtotal's
    NULL from an unknown date or visa type.
    """
    daily = fact.groupBy("arrdate", "visa_type_key").agg(F.count(F.lit(1)).alias("_visits"))
    return drilldown_of_counts(daily, calendar, visa_types, "_visits")


def drilldown_of_counts(
    daily: DataFrame, calendar: DataFrame, visa_types: DataFrame, visits: str = "visits"
) -> DataFrame:
    """:func:`visit_drilldown` from counts per ``arrdate`` and ``visa_type_key``, one row or several."""
    named = daily.join(calendar, "arrdate", "left").join(visa_types, "visa_type_key", "left")
    levels = named.select(
        "visatype",
        *[F.col(f"arrival_{part}").alias(part) for part in ("year", "month", "week")],
        F.col(visits).alias("_visits"),
    ).rollup("visatype", "year", "month", "week")
    return levels.agg(
        F.grouping_id().cast("int").alias("level"), F.sum("_visits").alias("visits")
    )


def write_fact_by_month(fact: DataFrame, path: str, replace: str = "table") -> DataFrame:
    """Write the fact in one folder per arrival year and month, which it gains as columns."""
    parts = calendar_parts(F.col("arrdate"))
    folders = {name: parts[name] for name in FACT_FOLDERS}
    return write_partitioned(fact.withColumns(folders), path, FACT_FOLDERS, replace)


def visits_on(fact: DataFrame, calendar: DataFrame, days: Column) -> DataFrame:
    """The fact rows that arrived on the calendar days for which ``days`` holds.

    The fact is one of :func:`write_fact_by_month`. The calendar has one row per day, a
    few million at most, so it is broadcast, and the folders that its chosen days name
    are the only ones read: whatever the condition is on, it prunes them at run time.
    """
    keys = ["arrdate", *FACT_FOLDERS]
    # In the calendar's own column order: a rearranged one is not recognised as the
    # broadcast that the pruning is to reuse, and without it nothing is pruned.
    return fact.join(F.broadcast(calendar.where(days).drop("id")), keys)


def refresh_visit_counts(spark: SparkSession, fact_path: str, fact: DataFrame, path: str) -> DataFrame:
    """Visits per month folder, ``arrdate`` and ``visa_type_key``, kept up to date at ``path``.

    ``fact`` is the monthly table at ``fact_path`` (:func:`~starloom.plans.loads.load_month`).
    A month is counted again only if the names or sizes of its files are not those it
    was last counted from; the other months' counts are left as they lie. Counts merge
    by addition, so reports are built from the parts (:func:`drilldown_of_counts`).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(fact_path)
    folder = F.regexp_extract("path", f"{MONTH}=([^/]+)", 1)
    listed = files.select(F.url_decode(folder).alias(MONTH), F.struct("path", "length").alias("file"))
    # One row per month, of the names of its files.
    now = listed.groupBy(MONTH).agg(F.xxhash64(F.sort_array(F.collect_list("file"))).alias("files"))
    now = {r[MONTH]: r["files"] for r in now.collect()}
    schema = T.StructType(
        [
            fact.schema["arrdate"],
            fact.schema["visa_type_key"],
            T.StructField("visits", T.LongType()),
            T.StructField("files", T.LongType()),
            T.StructField(MONTH, T.StringType()),
        ]
    )
    saved = read_partitioned(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)
    before = {r[MONTH]: r["files"] for r in saved.groupBy(MONTH).agg(F.max("files").alias("files")).collect()}
    stale = [m for m in now if before.get(m) != now[m]]
    if stale:
        chosen = fact.where(F.col(MONTH).isin([_like(fact, m) for m in stale]))
        counts = chosen.groupBy(MONTH, "arrdate", "visa_type_key").agg(F.count(F.lit(1)).alias("visits"))
        marks = F.create_map(*[F.lit(x) for m in stale for x in (m, now[m])])
        counts = counts.withColumn(MONTH, F.col(MONTH).cast("string")).withColumn("files", marks[F.col(MONTH)])
        write_partitioned(counts.select(*schema.names), path, MONTH, replace="partitions")
    # A month without rows has written nothing, so what it had is deleted.
    held = read_partitioned(spark, path, schema) if exists(spark, path) else saved
    now_held = {r[MONTH]: r["files"] for r in held.groupBy(MONTH).agg(F.max("files").alias("files")).collect()}
    for month in now_held:
        if now_held[month] != now.get(month):
            target, gone = hadoop_path(spark, f"{path}/{MONTH}={month}")
            target.delete(gone, True)
    return read_partitioned(spark, path, schema) if exists(spark, path) else saved


def _like(fact: DataFrame, month: str):
    """A folder's name as a value of the month column."""
    kind = fact.schema[MONTH].dataType
    return int(month) if isinstance(kind, T.IntegerType) else F.lit(month).cast(kind)
