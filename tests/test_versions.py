"""Versions behind a pointer, folders pruned at run time, counts kept up to date, buckets, rejects."""

from __future__ import annotations

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from starloom.operators import bucketed_lookup_join, lookup_join
from starloom.plans.dimensions import calendar_dimension
from starloom.plans.loads import load_month
from starloom.plans.reports import drilldown_of_counts, refresh_visit_counts, visit_drilldown, visits_on, write_fact_by_month
from starloom.sources import drop_versions, publish_version, read_version, read_with_rejects, write_bucketed, write_partitioned, write_table
from starloom.sources import versions as v


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def built(spark, folder, n):
    facts = write_table(spark.range(n), f"{folder}/facts")
    days = write_partitioned(spark.range(n).select((F.col("id") % 2).cast("int").alias("y"), "id"), f"{folder}/days", "y")
    return {"facts": (facts, f"{folder}/facts"), "days": (days, f"{folder}/days")}


def test_all_tables_change_at_once(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/star"
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    publish_version(spark, path, built(spark, f"{tmp_path}/a", 3))
    move, calls = v.publish, []

    def fail_second(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        return move(*args)

    monkeypatch.setattr(v, "publish", fail_second)
    with pytest.raises(OSError, match="lost"):
        publish_version(spark, path, built(spark, f"{tmp_path}/b", 5))
    monkeypatch.undo()
    old = read_version(spark, path)
    assert rows(old["facts"]) == [(0,), (1,), (2,)] and rows(old["days"]) == [(0, 0), (0, 2), (1, 1)]
    assert old["days"].columns == ["y", "id"]
    new = publish_version(spark, path, built(spark, f"{tmp_path}/c", 4))
    assert new["facts"].count() == new["days"].count() == 4
    # Whoever opened the old version still reads it.
    assert old["facts"].count() == 3
    first, failed, last = v.versions(spark, path)
    assert v.current(spark, path)["version"] == last
    assert read_version(spark, path, first)["facts"].count() == 3
    assert drop_versions(spark, path, keep=1) == [first, failed]
    assert read_version(spark, path)["facts"].count() == 4
    assert [p.rsplit("/", 1)[1] for p in glob.glob(f"{path}/CURRENT*")] == ["CURRENT"]


@pytest.fixture
def fact(spark):
    day = F.date_add(F.lit("2016-01-15").cast("date"), (F.col("id") % 90).cast("int"))
    return spark.range(900).select(
        F.col("id").cast("double").alias("record_id"), F.when(F.col("id") % 50 > 0, day).alias("arrdate"), (F.col("id") % 3).alias("visa_type_key")
    )


def spoil(pattern):
    """Make files unreadable without changing their size."""
    spoiled = glob.glob(pattern)
    for name in spoiled:
        with open(name, "r+b") as file:
            size = file.seek(0, 2)
            file.seek(0)
            file.write(b"x" * size)
    for crc in glob.glob(pattern.rsplit("/", 1)[0] + "/.*.crc"):
        with open(crc, "r+b") as file:
            file.truncate(0)
    return spoiled


def test_a_condition_on_the_calendar_reads_the_folders_it_names(spark, plan, tmp_path, fact):
    stored = write_fact_by_month(fact, f"{tmp_path}/fact")
    calendar = write_table(calendar_dimension(fact, sas=False), f"{tmp_path}/calendar")
    found = visits_on(stored, calendar, F.col("arrival_week") == 6)
    assert "dynamicpruning" in plan(found)
    wanted = [r for r in fact.collect() if r.arrdate and r.arrdate.isocalendar()[:2] == (2016, 6)]
    assert wanted and {r.arrdate.month for r in wanted} == {2}
    assert spoil(f"{tmp_path}/fact/arrival_year=2016/arrival_month=[134]/*.parquet")
    assert sorted(r.record_id for r in found.collect()) == sorted(r.record_id for r in wanted)


def test_counts_of_months_that_did_not_change_are_not_taken_again(spark, tmp_path, fact):
    path, counts = f"{tmp_path}/fact", f"{tmp_path}/counts"
    calendar = calendar_dimension(fact, sas=False)
    types = spark.createDataFrame([(0, "a"), (1, "b"), (2, None)], "visa_type_key long, visatype string")
    early = F.coalesce(F.month("arrdate") == 1, F.lit(False))
    loaded = load_month(fact.where(early), path, "2016-01", "record_id")
    refresh_visit_counts(spark, path, loaded, counts)
    loaded = load_month(fact.where(~early), path, "2016-02", "record_id")
    wanted = rows(visit_drilldown(loaded, calendar, types))
    spoil(f"{path}/load_month=2016-01/*.parquet")
    daily = refresh_visit_counts(spark, path, loaded, counts)
    assert rows(drilldown_of_counts(daily, calendar, types)) == wanted


def test_counts_follow_months_that_change_or_go(spark, tmp_path, fact):
    path, counts = f"{tmp_path}/fact", f"{tmp_path}/counts"
    month = {m: F.coalesce(F.month("arrdate") == m, F.lit(False)) for m in (1, 2, 3)}
    for m, chosen in month.items():
        loaded = load_month(fact.where(chosen), path, m, "record_id")
    visits = lambda daily: {r.load_month: r.n for r in daily.groupBy("load_month").agg(F.sum("visits").alias("n")).collect()}
    wanted = {str(m): fact.where(chosen).count() for m, chosen in month.items()}
    assert visits(refresh_visit_counts(spark, path, loaded, counts)) == wanted
    # One month without rows, one whose rows all belong to an earlier month.
    load_month(fact.limit(0), path, 2, "record_id")
    loaded = load_month(fact.where(month[1]), path, 3, "record_id")
    assert visits(refresh_visit_counts(spark, path, loaded, counts)) == {"1": wanted["1"]}


def test_bucketed_tables_are_joined_without_a_shuffle(spark, plan, tmp_path):
    fact = spark.range(3000).select("id", F.when(F.col("id") % 9 > 0, F.col("id") % 400).alias("k"))
    lookup = spark.range(0, 500, 3).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    left, right = write_bucketed(fact, f"{tmp_path}/f", "k"), write_bucketed(lookup, f"{tmp_path}/l", "key")
    joined = bucketed_lookup_join(left, right, {"k": "key"})
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert rows(joined) == rows(lookup_join(fact, lookup, {"k": "key"}))
    with pytest.raises(ValueError, match="rows per key"):
        bucketed_lookup_join(right, left.withColumnRenamed("id", "n"), {"key": "k"})
    with pytest.raises(ValueError, match="too many"):
        write_bucketed(fact.withColumn("k", F.lit(1)), f"{tmp_path}/hot", "k")


def test_rows_that_do_not_fit_are_kept_apart(spark, tmp_path):
    spark.createDataFrame([(1, "1.5", "2016-04-01"), (2, "1,5", "soon"), (3, None, None)], "id int, price string, day string").write.parquet(f"{tmp_path}/m1")
    spark.createDataFrame([(4, 2.5, 7)], "id int, price double, extra int").write.parquet(f"{tmp_path}/m2")
    good, rejects = read_with_rejects(spark, [f"{tmp_path}/m1", f"{tmp_path}/m2"], "id long, price double, day date")
    assert dict(good.dtypes) == {"id": "bigint", "price": "double", "day": "date", "extra": "int"}
    assert rows(good) == [(1, 1.5, dt.date(2016, 4, 1), None), (3, None, None, None), (4, 2.5, None, 7)]
    (lost,) = rejects.collect()
    assert "/m1/" in lost.file_path and lost.row == '{"id":2,"price":"1,5","day":"soon"}'
    assert lost.reasons == ["price: 1,5 is not a double", "day: soon is not a date"]


def test_json_and_csv_months_have_rejects_too(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "n": "7"}\n{"id": 2, "n": "seven"}\n')
    (tmp_path / "b.csv").write_text("n,id\n8,3\neight,4\n")
    for name, fmt, wanted in (("a.json", "json", [(1, 7)]), ("b.csv", "csv", [(3, 8)])):
        good, rejects = read_with_rejects(spark, [f"{tmp_path}/{name}"], "id long, n int", fmt)
        assert rows(good) == wanted
        assert [r.reasons[0].split(":")[0] for r in rejects.collect()] == ["n"]
