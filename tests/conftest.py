from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[*]")
        .appName("starloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def plan():
    """The physical plan of a DataFrame as text."""

    def text(df) -> str:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        return out.getvalue()

    return text


@pytest.fixture
def setting(spark):
    """Set session options for one test."""
    before = {}

    def change(name: str, value: str) -> None:
        before.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)
