"""What the physical plans must look like."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import check_foreign_key, drop_incomplete_rows, missing_profile
from starloom.plans.cleaning import Cleaning
from starloom.plans.dimensions import member_dimension
from starloom.plans.reports import arrivals_per_country
from starloom.sources import write_table

SF_DIR = "/root/testdata/sf0.001"


def read(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_required_columns_reach_the_scan(spark, plan):
    lines = drop_incomplete_rows(read(spark, "lineitem"), ["l_discount"]).select("l_orderkey")
    text = plan(lines)
    assert "IsNotNull(l_discount)" in text[text.index("PushedFilters") :]
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in text


def test_members_of_kept_rows_read_one_column(spark, plan):
    kinds = Cleaning(empty_rows=True).distinct_column(read(spark, "orders"), "o_orderpriority")
    known = plan(kinds).split("FileScan")[1]
    assert "ReadSchema: struct<o_orderpriority:string>" in known
    assert "IsNotNull(o_orderpriority)" in known


def test_profile_is_one_scan(spark, plan):
    assert plan(missing_profile(read(spark, "lineitem"))).count("FileScan") == 1


def test_distinct_reads_one_column_and_combines_before_the_shuffle(spark, plan):
    kinds = read(spark, "orders").select("o_orderpriority").distinct()
    text = plan(kinds)
    assert "ReadSchema: struct<o_orderpriority:string>" in text
    assert text.count("HashAggregate") == 2


def test_foreign_key_check_joins_keys_not_rows(spark, plan):
    text = plan(
        check_foreign_key(read(spark, "lineitem"), read(spark, "orders"), {"l_orderkey": "o_orderkey"})
    )
    join = text.index("Join")
    assert text[join:].count("HashAggregate") == 4


def test_country_report_reduces_the_fact_before_the_join(spark, plan, tmp_path):
    fact = read(spark, "customer").select(
        F.col("c_nationkey").cast("double").alias("country_residence_code"), "c_name"
    )
    country = member_dimension(fact, "country_residence_code", "id").select(
        F.col("country_residence_code").alias("country_code"), F.lit(1.0).alias("average_temperature")
    )
    text = plan(arrivals_per_country(fact, write_table(country, f"{tmp_path}/country")))
    assert "HashAggregate" in text[text.index("Join") :]
    assert "ReadSchema: struct<c_nationkey:int>" in text
