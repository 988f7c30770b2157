"""Loads that come one after the other, on hand-made rows."""

from __future__ import annotations

import datetime as dt
import itertools
import os

import pytest

from starloom.operators import with_surrogate_key
from starloom.operators.registry import new_members
from starloom.plans.loads import extend_calendar, extend_dimension, load_immigration_month, load_month, read_months
from starloom.sources.schemas import IMMIGRATION

SCHEMA = "k int, v string"
MONTHS = {
    "2016-01": [(1, "a"), (2, "b"), (2, "c"), (None, "n")],
    "2016-02": [(2, "x"), (3, "y"), (None, "m")],
    "2016-03": [(1, "p"), (3, "q"), (4, "r")],
}
WANTED = [(1, "a", "2016-01"), (2, "b", "2016-01"), (3, "y", "2016-02"), (4, "r", "2016-03"), (None, "n", "2016-01")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(path):
    """Every data file below a folder, with its time."""
    found = (os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet"))
    return {f.removeprefix(str(path)): os.stat(f).st_mtime_ns for f in found}


def load(spark, path, month, data):
    return load_month(spark.createDataFrame(data, SCHEMA), str(path), month, "k")


@pytest.mark.parametrize("order", list(itertools.permutations(MONTHS))[1::2] + [["2016-03", "2016-02", "2016-03", "2016-01", "2016-02"]])
def test_any_order_of_loads_gives_the_same_table(spark, tmp_path, order):
    for month in order:
        loaded = load(spark, tmp_path / "t", month, MONTHS[month])
    assert rows(loaded) == sorted(WANTED, key=repr)


def test_records_come_back_when_an_earlier_month_is_corrected(spark, tmp_path):
    path = tmp_path / "t"
    for month, data in MONTHS.items():
        load(spark, path, month, data)
    assert rows(load(spark, path, "2016-01", [(5, "e"), (4, "d")])) == sorted(
        [(5, "e", "2016-01"), (4, "d", "2016-01"), (2, "x", "2016-02"), (3, "y", "2016-02"), (None, "m", "2016-02"), (1, "p", "2016-03")],
        key=repr,
    )
    # A month without rows has no folder.
    assert rows(load(spark, path, "2016-02", [])) == sorted(
        [(5, "e", "2016-01"), (4, "d", "2016-01"), (1, "p", "2016-03"), (3, "q", "2016-03")], key=repr
    )
    assert sorted(p.name for p in path.iterdir() if p.is_dir()) == ["load_month=2016-01", "load_month=2016-03"]


def test_only_folders_that_change_are_replaced(spark, tmp_path):
    path = tmp_path / "t"
    for month, data in MONTHS.items():
        load(spark, path, month, data)
    before = files(path)
    load(spark, path, "2016-02", MONTHS["2016-02"])
    after = files(path)
    kept = {f for f in before if f in after and before[f] == after[f]}
    assert {f for f in before if "2016-02" not in f} == kept
    # Key 4 moves to the second month, so the third is written too.
    load(spark, path, "2016-02", [*MONTHS["2016-02"], (4, "s")])
    last = files(path)
    assert {f.split("/")[1] for f in after if f in last} == {"load_month=2016-01"}
    assert (4, "s", "2016-02") in rows(read_months(spark, str(path), spark.createDataFrame([], SCHEMA).schema))


def test_a_load_that_failed_half_way_is_run_again(spark, tmp_path, monkeypatch):
    """Later months are written first; failing before the month itself loses nothing."""
    from starloom.plans import loads

    path = tmp_path / "t"
    for month in ("2016-02", "2016-03"):
        load(spark, path, month, MONTHS[month])
    write, calls = loads.write_partitioned, []

    def fail_second(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        return write(*args, **kwargs)

    monkeypatch.setattr(loads, "write_partitioned", fail_second)
    with pytest.raises(OSError, match="lost"):
        load(spark, path, "2016-01", MONTHS["2016-01"])
    monkeypatch.undo()
    assert rows(load(spark, path, "2016-01", MONTHS["2016-01"])) == sorted(WANTED, key=repr)


def test_a_load_moves_its_rows_once(spark, tmp_path, setting, monkeypatch):
    """One exchange of whole rows per load, and none to write them; keys are looked up where later months exist."""
    from starloom.plans import loads

    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    written = {}

    def materialise(df, name, real=loads.materialise):
        written[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    def write(df, *args, real=loads.write_partitioned, **options):
        written["write"] = options
        return real(df, *args, **options)

    monkeypatch.setattr(loads, "materialise", materialise)
    monkeypatch.setattr(loads, "write_partitioned", write)
    data = [(k, str(k)) for k in range(50)] * 2
    load(spark, tmp_path / "t", "2016-01", data)
    loaded = load(spark, tmp_path / "t", "2016-02", [*data, (77, "n"), (None, "m")])
    assert set(written) == {"month", "write"} and written["write"]["as_it_lies"]
    # One for the rows with the held keys among them, one that makes the held keys distinct.
    assert written["month"].count("Exchange hashpartitioning") == 2 and "Join" not in written["month"]
    assert written["month"].count("WindowGroupLimit") == 2
    assert rows(loaded) == rows(spark.createDataFrame([(k, str(k), "2016-01") for k in range(50)] + [(77, "n", "2016-02"), (None, "m", "2016-02")], "k int, v string, m string"))


def test_columns_of_the_loader_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="superseded"):
        load_month(spark.createDataFrame([(1, True)], "k int, Superseded boolean"), str(tmp_path), "m", "k")


def test_keys_stay_and_new_members_follow(spark, tmp_path):
    path = str(tmp_path / "d")
    first = spark.createDataFrame([("b", 1), ("d", 1), ("b", 1)], "m string, n int")
    assert rows(extend_dimension(first, path, ["m", "n"])) == [("b", 1, 0), ("d", 1, 1)]
    second = spark.createDataFrame([("a", 1), ("d", 1), (None, 1), (None, None), ("b", 2)], "m string, n int")
    wanted = sorted([("b", 1, 0), ("d", 1, 1), (None, None, 2), (None, 1, 3), ("a", 1, 4), ("b", 2, 5)], key=repr)
    assert rows(extend_dimension(second, path, ["m", "n"])) == wanted
    before = files(path)
    assert rows(extend_dimension(second.unionByName(first), path, ["m", "n"])) == wanted
    assert files(path) == before


def test_new_members_over_many_partitions(spark, setting):
    setting("spark.sql.adaptive.enabled", "false")
    saved = with_surrogate_key(spark.range(0, 5000, 7).select("id"), "id", "key")
    added = new_members(saved, spark.range(5000).select("id"), "id", "key")
    fresh_ids = [i for i in range(5000) if i % 7]
    assert rows(added) == sorted(((i, 715 + k) for k, i in enumerate(fresh_ids)), key=repr)


def test_calendar_grows_by_days(spark, tmp_path):
    path, day = str(tmp_path / "c"), dt.date
    first = spark.createDataFrame([(day(2016, 4, 2),), (None,)], "arrdate date")
    assert rows(extend_calendar(first, path, folders=["arrival_year"])) == [
        (None, None, None, None, None, None, 0),
        (day(2016, 4, 2), 2, 13, 4, 2016, 7, 1),
    ]
    second = spark.createDataFrame([(day(2016, 4, 2),), (day(2015, 1, 1),), (None,)], "arrdate date")
    got = rows(extend_calendar(second, path, folders=["arrival_year"]))
    assert {r[0]: r[-1] for r in got} == {day(2015, 1, 1): 2, day(2016, 4, 2): 1, None: 0}


def test_immigration_months(spark, tmp_path):
    def arrivals(*given):
        names = [f.split()[0] for f in IMMIGRATION.split(", ")]
        return spark.createDataFrame([tuple(g.get(n) for n in names) for g in given], IMMIGRATION)

    april = arrivals(dict(cicid=1.0, arrdate=20545.0, visatype="B2"), dict(cicid=2.0, arrdate=20546.0, visatype=None), dict(arrdate=1.0))
    march = arrivals(dict(cicid=2.0, arrdate=20520.0, visatype="B1"), dict(cicid=3.0, arrdate=20520.0, visatype="B2"))
    load_immigration_month(april, str(tmp_path), "2016-04")
    built = load_immigration_month(march, str(tmp_path), "2016-03")
    assert rows(built["visatype"]) == [("B1", 2), ("B2", 1), (None, 0)]
    fact = built["immigration_fact"].select("record_id", "visa_type_key", "load_month")
    assert rows(fact) == [(1.0, 1, "2016-04"), (2.0, 2, "2016-03"), (3.0, 1, "2016-03")]
    assert built["immigration_calendar"].count() == 3
