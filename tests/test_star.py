"""Cleaning rules, dimensions, fact and reports on hand-made rows."""

from __future__ import annotations

import datetime as dt
import math
import time

import pytest
from pyspark.sql import functions as F

from starloom.__main__ import main
from starloom.operators.quality import QualityError
from starloom.plans import cleaning
from starloom.plans.cleaning import Cleaning
from starloom.plans.dimensions import (
    calendar_dimension,
    country_dimension,
    country_temperatures,
    state_population,
)
from starloom.plans.facts import star_join
from starloom.plans.reports import (
    climate_bands,
    climate_correlation,
    monthly_visitors_by_state,
    visit_drilldown,
)
from starloom.plans.star import StarSources, at_once, build_star, load_immigration
from starloom.sources.schemas import DEMOGRAPHICS, IMMIGRATION, TEMPERATURE

APRIL_1, APRIL_2, NEW_YEAR = dt.date(2016, 4, 1), dt.date(2016, 4, 2), dt.date(2016, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def arrival(**values):
    return tuple(values.get(f.split()[0]) for f in IMMIGRATION.split(", "))


ARRIVALS = [
    arrival(cicid=1.0, i94res=101.0, i94addr="CA", arrdate=20545.0, depdate=20550.0, visatype="B2"),
    arrival(cicid=2.0, i94res=101.0, i94addr="CA", arrdate=20545.9, visatype="B1"),
    arrival(cicid=3.0, i94res=130.0, i94addr="NY", arrdate=20546.0, visatype="B2"),
    arrival(cicid=4.0, i94res=999.0, i94addr="NY", arrdate=20454.0, visatype="WT"),
    arrival(cicid=5.0, i94res=None, i94addr=None, arrdate=None, visatype=None),
    arrival(cicid=6.0, i94res=582.0, i94addr="ZZ", arrdate=0.0, visatype="B2"),
    arrival(cicid=7.0, i94res=130.0, i94addr="CA", arrdate=20546.0, visatype=None),
    arrival(cicid=7.0, i94res=130.0, i94addr="CA", arrdate=20546.0, visatype=None),
    arrival(occup="STU", entdepu="U", insnum="3"),
    arrival(),
]
READINGS = [
    (dt.date(1900, 1, 1), 10.0, 1.0, "Tirana", "Albania", "41N", "20E"),
    (dt.date(1900, 1, 1), 14.0, 1.0, "Tirana", "Albania", "41N", "20E"),
    (dt.date(1900, 2, 1), 20.0, 1.0, "Tirana", "Albania", "41N", "20E"),
    (dt.date(1900, 1, 1), None, None, "Århus", "Denmark", "57N", "10E"),
    (dt.date(1900, 1, 1), math.nan, None, "Århus", "Denmark", "57N", "10E"),
    (dt.date(1900, 1, 1), 5.0, 1.0, "Sarajevo", "Bosnia-Herzegovina", "44N", "18E"),
    (dt.date(1900, 1, 1), 7.0, 1.0, "Nowhere", None, "0N", "0E"),
]
PEOPLE = [
    ("Fresno", "California", 30.0, 10, 11, 21, 1, 2, 2.5, "CA", "Asian", 5),
    ("Fresno", "California", 30.0, 10, 11, 21, 1, 2, 2.5, "CA", "Asian", 5),
    ("Fresno", "California", 30.0, 10, 11, 21, 1, 2, 2.5, "CA", "White", 9),
    ("Irvine", "California", None, 20, 21, None, 1, 2, 2.5, "CA", "White", 9),
    ("Davis", "California", 30.0, 20, 21, 41, 1, 2, 2.5, "CA", "White", 9),
    ("Albany", "New York", 30.0, 5, 6, 11, 1, 2, 2.5, "NY", "White", 9),
    ("Ithaca", "New York", 30.0, None, 6, 11, 1, 2, 2.5, "NY", "White", 9),
    ("Troy", "New York", 30.0, 5, 6, 11, None, 2, 2.5, "NY", "White", 9),
]
CODES = """code,Name
101,ALBANIA
130,BOSNIA-HERZEGOVINA
582,"MEXICO Air Sea, and Not Reported (I-94, no land arrivals)"
700,UNUSED
"""


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("star")
    half = len(ARRIVALS) // 2
    for name, part in (("march", ARRIVALS[:half]), ("april", ARRIVALS[half:])):
        spark.createDataFrame(part, IMMIGRATION).write.parquet(f"{folder}/{name}")
    for name, data, schema, sep in (
        ("temperature", READINGS, TEMPERATURE, ","),
        ("demographics", PEOPLE, DEMOGRAPHICS, ";"),
    ):
        spark.createDataFrame(data, schema).write.options(header=True, sep=sep).csv(f"{folder}/{name}")
    (folder / "codes.csv").write_text(CODES)
    return StarSources(
        immigration=(f"{folder}/march", f"{folder}/april"),
        temperature=f"{folder}/temperature",
        demographics=f"{folder}/demographics",
        country_codes=f"{folder}/codes.csv",
    )


@pytest.fixture(scope="module")
def star(spark, sources, tmp_path_factory):
    return build_star(spark, sources, f"{tmp_path_factory.mktemp('out')}/star", fail_on_empty=True)


def test_command_line_builds_the_same_star(spark, star, sources, tmp_path, capsys):
    main(
        [
            *("--immigration", *sources.immigration),
            *("--temperature", sources.temperature),
            *("--demographics", sources.demographics),
            *("--country-codes", sources.country_codes),
            *("--output", f"{tmp_path}/star/"),
            "--fail-on-empty",
        ]
    )
    assert "immigration_calendar" in capsys.readouterr().out
    for name, table in star.tables().items():
        again = spark.read.parquet(f"{tmp_path}/star/{name}").select(table.columns)
        assert rows(again) == rows(table)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_row_formats_load_like_parquet(spark, tmp_path, fmt):
    arrivals = spark.createDataFrame(ARRIVALS, IMMIGRATION)
    written = arrivals.write.option("header", True).format(fmt)
    written.save(f"{tmp_path}/{fmt}")
    loaded = load_immigration(spark, f"{tmp_path}/{fmt}", fmt)
    assert not {"occup", "entdepu", "insnum"} & set(loaded.columns)
    columns = ["cicid", "i94res", "i94addr", "arrdate", "visatype"]
    expected = cleaning.IMMIGRATION.apply(arrivals).select(columns)
    assert rows(cleaning.IMMIGRATION.apply(loaded).select(columns)) == rows(expected)


def test_visa_types_are_ranked_with_null_first(star):
    assert rows(star.visatype) == [("B1", 1), ("B2", 2), ("WT", 3), (None, 0)]


def test_fact(star):
    fact = star.immigration_fact
    assert fact.columns[:4] == ["record_id", "i94yr", "i94mon", "i94cit"]
    assert fact.columns[-1] == "visa_type_key" and len(fact.columns) == 25
    assert not {"occup", "entdepu", "insnum", "visatype", "cicid"} & set(fact.columns)
    picked = fact.select(
        "record_id", "country_residence_code", "state_code", "arrdate", "depdate", "visa_type_key"
    )
    assert rows(picked) == [
        (1.0, 101.0, "CA", APRIL_1, 20550.0, 2),
        (2.0, 101.0, "CA", APRIL_1, None, 1),
        (3.0, 130.0, "NY", APRIL_2, None, 2),
        (4.0, 999.0, "NY", NEW_YEAR, None, 3),
        (5.0, None, None, None, None, None),
        (6.0, 582.0, "ZZ", None, None, 2),
        (7.0, 130.0, "CA", APRIL_2, None, None),
        (7.0, 130.0, "CA", APRIL_2, None, None),
    ]


def test_calendar(star):
    assert star.immigration_calendar.columns == [
        "arrdate",
        "arrival_day",
        "arrival_week",
        "arrival_month",
        "arrival_year",
        "arrival_weekday",
        "id",
    ]
    assert rows(star.immigration_calendar) == [
        (None, None, None, None, None, None, 0),
        (NEW_YEAR, 1, 53, 1, 2016, 6, 1),
        (APRIL_1, 1, 13, 4, 2016, 6, 2),
        (APRIL_2, 2, 13, 4, 2016, 7, 3),
    ]


def test_country(star):
    mexico = "Mexico Air Sea, And Not Reported (I-94, No Land Arrivals)"
    assert rows(star.country) == [
        (101.0, "Albania", 15.0),
        (130.0, "Bosnia-Herzegovina", 5.0),
        (582.0, mexico, None),
        (999.0, None, None),
        (None, None, None),
    ]


def test_demographics(star):
    assert star.demographics.columns[2:4] == ["median_age", "male_population"]
    picked = star.demographics.select("City", "state_code", "Race", "median_age", "id")
    assert rows(picked) == [
        ("Albany", "NY", "White", 30.0, 0),
        ("Davis", "CA", "White", 30.0, 1),
        ("Fresno", "CA", "Asian", 30.0, 2),
        ("Fresno", "CA", "White", 30.0, 3),
        ("Irvine", "CA", "White", None, 4),
    ]
    assert rows(state_population(star.demographics)) == [("CA", 62), ("NY", 11)]


def test_quality(star):
    assert rows(star.quality()) == [
        ("country", 5, True),
        ("demographics", 5, True),
        ("immigration_calendar", 4, True),
        ("immigration_fact", 8, True),
        ("visatype", 4, True),
    ]


def test_star_join_keeps_the_fact_rows(star):
    joined = star_join(
        star.immigration_fact,
        star.immigration_calendar,
        star.country,
        star.visatype,
        state_population(star.demographics),
    )
    picked = joined.select("record_id", "arrival_week", "country_name", "visatype", "total_population")
    got = rows(picked)
    assert len(got) == 8
    assert (4.0, 53, None, "WT", 11) in got
    assert (5.0, None, None, None, None) in got
    assert got.count((7.0, 13, "Bosnia-Herzegovina", None, 62)) == 2


def test_reports(star):
    fact = star.immigration_fact
    assert rows(climate_bands(fact, star.country)) == [
        (0, 3, 1),
        (1, 2, 1),
        (None, 3, 3),
    ]
    assert tuple(climate_correlation(fact, star.country).first()) == (2, pytest.approx(-1.0))
    visitors = monthly_visitors_by_state(fact, state_population(star.demographics))
    assert ("CA", 2016, 4, 4, 62) in rows(visitors)
    assert ("ZZ", None, None, 1, None) in rows(visitors)
    levels = rows(visit_drilldown(fact, star.immigration_calendar, star.visatype))
    assert (None, None, None, None, 15, 8) in levels
    assert ("B2", None, None, None, 7, 3) in levels
    assert ("B2", None, None, None, 0, 1) in levels
    assert ("B2", 2016, 4, 13, 0, 2) in levels


def test_cleaning_reports_balance(spark):
    arrivals = spark.createDataFrame(ARRIVALS, IMMIGRATION)
    assert tuple(cleaning.IMMIGRATION.report(arrivals).first()) == (10, 2, 0, 8)
    assert tuple(cleaning.IMMIGRATION_RECORDS.report(arrivals).first()) == (10, 2, 1, 7)
    readings = spark.createDataFrame(READINGS, TEMPERATURE)
    assert tuple(cleaning.TEMPERATURE.report(readings).first()) == (7, 2, 1, 4)
    people = spark.createDataFrame(PEOPLE, DEMOGRAPHICS)
    assert tuple(cleaning.DEMOGRAPHICS.report(people).first()) == (8, 2, 1, 5)
    for rule, df in (
        (cleaning.IMMIGRATION, arrivals),
        (cleaning.IMMIGRATION_RECORDS, arrivals),
        (cleaning.TEMPERATURE, readings),
        (cleaning.DEMOGRAPHICS, people),
    ):
        assert rule.apply(df).count() == rule.report(df).first().rows_out
        assert tuple(rule.report(df.limit(0)).first()) == (0, 0, 0, 0)


def test_one_column_of_the_kept_rows(spark):
    arrivals = spark.createDataFrame(ARRIVALS, IMMIGRATION)
    for name in ("visatype", "arrdate", "i94res"):
        for rule in (cleaning.IMMIGRATION, cleaning.IMMIGRATION_RECORDS):
            assert rows(rule.distinct_column(arrivals, name)) == rows(rule.apply(arrivals).select(name).distinct())
    odd = spark.createDataFrame([(math.nan, None), (math.nan, 1), (None, 1), (2.0, None)], "a double, b int")
    kept = Cleaning(empty_rows=True).distinct_column(odd, "a")
    assert [repr(r) for r in rows(kept)] == ["(2.0,)", "(None,)", "(nan,)"]


def test_cleaning_without_rules_changes_nothing(spark):
    df = spark.range(3)
    assert Cleaning().apply(df).count() == 3
    assert tuple(Cleaning().report(df).first()) == (3, 0, 0, 3)


def test_first_duplicate_reading_survives(spark):
    clean = cleaning.TEMPERATURE.apply(spark.createDataFrame(READINGS, TEMPERATURE))
    assert rows(country_temperatures(clean)) == [
        ("Albania", 15.0),
        ("Bosnia-Herzegovina", 5.0),
        (None, 7.0),
    ]


def test_a_code_listed_twice_does_not_multiply_countries(spark):
    arrivals = spark.createDataFrame([(1.0,), (1.0,)], "i94res double")
    codes = spark.createDataFrame([(1, "B"), (1, "A")], "code int, Name string")
    averages = spark.createDataFrame([("A", 3.0)], "Country string, average_temperature double")
    assert rows(country_dimension(arrivals, codes, averages)) == [(1.0, "A", 3.0)]


def test_calendar_ids_do_not_depend_on_layout(spark):
    days = spark.range(400).select((F.col("id") * 37 % 211 + 20000.25).alias("arrdate"))
    expected = rows(calendar_dimension(days))
    assert len(expected) == 211 and [r[-1] for r in sorted(expected)] == list(range(211))
    assert rows(calendar_dimension(days.repartition(11))) == expected


def test_an_empty_table_fails_the_build(spark, tmp_path):
    spark.createDataFrame([], IMMIGRATION).write.parquet(f"{tmp_path}/immigration")
    for name, schema, sep in (("t", TEMPERATURE, ","), ("d", DEMOGRAPHICS, ";")):
        spark.createDataFrame([], schema).write.options(header=True, sep=sep).csv(f"{tmp_path}/{name}")
    (tmp_path / "codes.csv").write_text(CODES)
    sources = StarSources(
        f"{tmp_path}/immigration", f"{tmp_path}/t", f"{tmp_path}/d", f"{tmp_path}/codes.csv"
    )
    old = f"{tmp_path}/out/immigration_fact"
    spark.range(3).write.parquet(old)
    with pytest.raises(QualityError, match="immigration_fact"):
        build_star(spark, sources, f"{tmp_path}/out", fail_on_empty=True)
    assert spark.read.parquet(old).count() == 3
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["immigration_fact"]


def test_a_failing_step_cancels_its_siblings(spark):
    def slow():
        spark.sparkContext.parallelize(range(2), 2).foreach(lambda _: time.sleep(90))

    def broken():
        time.sleep(3)
        raise KeyError("broken")

    start = time.monotonic()
    with pytest.raises(KeyError):
        at_once(slow, broken)
    assert time.monotonic() - start < 60


@pytest.fixture
def raw_files(spark, tmp_path):
    """Raw files of all four sources, as paths."""
    spark.createDataFrame(ARRIVALS, IMMIGRATION).write.parquet(f"{tmp_path}/raw/arrivals")
    spark.createDataFrame(READINGS, TEMPERATURE).write.csv(f"{tmp_path}/raw/readings", header=True)
    city = ("Boston", "Massachusetts", 31.8, 1, 2, 3, 4, 5, 2.5, "MA", "White", 6)
    cities = [city, city, (*city[:3], None, *city[4:])]
    spark.createDataFrame(cities, DEMOGRAPHICS).write.csv(f"{tmp_path}/raw/cities", header=True, sep=";")
    spark.createDataFrame([(101, "ALBANIA")], "code int, Name string").write.csv(f"{tmp_path}/raw/codes", header=True)
    return StarSources(*(f"{tmp_path}/raw/{name}" for name in ("arrivals", "readings", "cities", "codes")))


def test_counts_are_taken_while_the_star_is_written(spark, tmp_path, monkeypatch, raw_files):
    from starloom.plans.star import cleaning_report

    wanted = rows(cleaning_report(spark, raw_files))
    monkeypatch.setattr(Cleaning, "report", lambda self, df: pytest.fail("scanned again"))
    star = build_star(spark, raw_files, f"{tmp_path}/star")
    assert rows(star.cleaning) == wanted
    assert all(r.rows_in == r.dropped_missing + r.dropped_duplicates + r.rows_out for r in star.cleaning.collect())


def test_counts_of_tasks_that_ran_again_are_not_trusted(spark, tmp_path, monkeypatch, raw_files):
    from starloom.plans.star import cleaning_report

    assert not cleaning.ran_once(spark, "a tag that no job has")
    spark.sparkContext.addJobTag("fails")
    with pytest.raises(Exception, match="lost"):
        spark.range(3).select(F.raise_error(F.lit("lost"))).collect()
    spark.sparkContext.removeJobTag("fails")
    assert not cleaning.ran_once(spark, "fails")
    monkeypatch.setattr(cleaning, "ran_once", lambda spark, tag: False)
    star = build_star(spark, raw_files, f"{tmp_path}/star")
    assert rows(star.cleaning) == rows(cleaning_report(spark, raw_files))
