"""Profiles taken from the footers of files."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starloom.operators import missing_profile, missing_profile_of_files
from starloom.operators.profile import footer_plan


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def path(spark, tmp_path):
    kinds = "a int, `b c` long, t string, f double, d date, n decimal(20,3), o boolean, s timestamp, year int"
    day, now = dt.date(2016, 4, 1), dt.datetime(2016, 4, 1, 2)
    given = [
        (1, None, "nan", math.nan, day, Decimal(1), True, now, 2015),
        (None, None, None, 1.0, None, None, None, None, 2015),
        (None, 5, "x", None, day, Decimal(2), False, now, None),
    ]
    spark.createDataFrame(given * 50, kinds).repartition(4).write.partitionBy("year").parquet(f"{tmp_path}/t")
    return f"{tmp_path}/t"


def test_footers_give_the_profile_of_the_rows(spark, path):
    assert rows(missing_profile_of_files(spark, path)) == rows(missing_profile(spark.read.parquet(path)))


def test_data_of_whole_number_columns_is_not_read(spark, plan, path):
    counted = plan(footer_plan(spark, path, ["a", "b c", "d"]))
    assert "BatchScan" in counted and "count(a)" in counted
    scanned = plan(missing_profile_of_files(spark, path))
    assert "ReadSchema: struct<t:string,f:double>" in scanned


def test_settings_of_the_session_stay(spark, path):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    missing_profile_of_files(spark, path).collect()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert type(spark).getActiveSession().conf.get("spark.sql.sources.useV1SourceList") == before


def test_chunks_without_statistics_are_scanned(spark, tmp_path):
    for name, statistics in (("with", True), ("without", False)):
        table = pa.table({"k": pa.array([1, None, 3]), "t": ["a", None, "NaN"]})
        pq.write_table(table, tmp_path / f"{name}.parquet", write_statistics=statistics)
    got = {r.column_name: (r.missing, r.n_rows) for r in missing_profile_of_files(spark, str(tmp_path)).collect()}
    assert got == {"k": (2, 6), "t": (4, 6)}


def test_nested_and_empty_tables(spark, tmp_path):
    nested = spark.range(9).select(F.struct("id", (F.col("id") + 1).alias("b")).alias("s"), F.when(F.col("id") > 3, 1).alias("k"))
    nested.write.parquet(f"{tmp_path}/nested")
    assert rows(missing_profile_of_files(spark, f"{tmp_path}/nested")) == rows(missing_profile(nested))
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    assert rows(missing_profile_of_files(spark, f"{tmp_path}/empty")) == [("id", 0, None, 0)]
