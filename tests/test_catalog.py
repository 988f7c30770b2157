"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from starloom.catalog import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as from '{SF_DIR}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, plan, name):
    result = QUERIES[name](spark, SF_DIR)
    text = plan(result)
    for unwanted in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text
    expected = duck.sql(ORACLE[name])
    assert sorted(result.columns) == sorted(expected.columns)
    actual = bag(result.columns, result.collect())
    wanted = bag(expected.columns, expected.fetchall())
    assert wanted, "the check would pass on nothing"
    assert actual == wanted


def test_entry_offers_every_query():
    assert entry.queries().items() >= QUERIES.items()
    assert entry.oracle_sql().items() >= ORACLE.items()


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5
