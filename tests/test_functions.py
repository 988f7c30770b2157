from __future__ import annotations

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions import (
    calendar_parts,
    is_missing,
    percentage,
    sas_days,
    sas_to_date,
    title_case,
)


def test_sas_to_date_edges(spark):
    days = [None, 0.0, 20545.0, 20545.9, -0.5, math.nan, 20454.0, -1.0]
    rows = spark.createDataFrame([(d,) for d in days], "d double").select(
        sas_to_date(F.col("d")).alias("skip"),
        sas_to_date(F.col("d"), zero_is_null=False).alias("keep"),
    )
    epoch = dt.date(1960, 1, 1)
    skip = [
        None,
        None,
        dt.date(2016, 4, 1),
        dt.date(2016, 4, 1),
        dt.date(1959, 12, 31),
        None,
        dt.date(2016, 1, 1),
        dt.date(1959, 12, 31),
    ]
    keep = [None, epoch, *skip[2:]]
    got = rows.collect()
    assert [r.skip for r in got] == skip
    assert [r.keep for r in got] == keep


def test_sas_to_date_takes_integers(spark):
    rows = spark.createDataFrame([(20545, 1)], "d int, e bigint")
    got = rows.select(sas_to_date(F.col("d")), sas_to_date(F.col("e"))).first()
    assert tuple(got) == (dt.date(2016, 4, 1), dt.date(1960, 1, 2))


def test_sas_days_inverts_sas_to_date(spark):
    days = spark.range(-30000, 60000, 37).withColumn("d", F.col("id").cast("double"))
    back = sas_days(sas_to_date(F.col("d"), zero_is_null=False))
    assert days.where(~back.eqNullSafe(F.col("d"))).isEmpty()


def test_calendar_parts_at_new_year(spark):
    days = spark.createDataFrame([(dt.date(2016, 1, 1),), (None,)], "d date")
    parts = days.select(*[c.alias(n) for n, c in calendar_parts(F.col("d"), "x").items()])
    first, second = parts.collect()
    assert first.asDict() == {
        "x_day": 1,
        "x_week": 53,
        "x_month": 1,
        "x_year": 2016,
        "x_weekday": 6,
    }
    assert set(second) == {None}


def test_title_case_known_names(spark):
    names = {
        "BOSNIA-HERZEGOVINA": "Bosnia-Herzegovina",
        "ÅRHUS": "Århus",
        "COTE D'IVOIRE": "Cote D'Ivoire",
        "INVALID: NO 3RD CODE (54)": "Invalid: No 3Rd Code (54)",
        "MEXICO Air Sea, and Not Reported (I-94)": "Mexico Air Sea, And Not Reported (I-94)",
        "": "",
        None: None,
    }
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.title for r in rows.select("name", title_case(F.col("name")).alias("title")).collect()}
    assert got == names


_LETTERS = "abcXYZéÉñÑåÅöÖçßñøØđжЖяЯλΛ"
_OTHERS = " -'.,:()/_0123456789中日"


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(_LETTERS + _OTHERS, max_size=30), min_size=200, max_size=300))
def test_title_case_equals_python(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in rows.select("t", title_case(F.col("t")).alias("got")).collect():
        assert row.got == row.t.title()


def test_is_missing_by_type(spark):
    rows = spark.createDataFrame(
        [
            (1.0, 1, "word", dt.date(2020, 1, 1), True, [1]),
            (math.nan, 2, " NaN ", None, False, []),
            (None, None, None, None, None, None),
        ],
        "a double, b int, c string, d date, e boolean, f array<int>",
    )
    flags = rows.select(*[is_missing(f).alias(f.name) for f in rows.schema.fields]).collect()
    assert [tuple(r) for r in flags] == [
        (False,) * 6,
        (True, False, True, True, False, False),
        (True,) * 6,
    ]
    field = rows.schema["c"]
    plain = rows.select(is_missing(field, text_nan=False).alias("m")).collect()
    assert [r.m for r in plain] == [False, False, True]


def test_percentage_of_nothing_is_null(spark):
    rows = spark.createDataFrame([(1, 4), (0, 0)], "a bigint, b bigint")
    got = rows.select(percentage(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r.p for r in got] == [25.0, None]
