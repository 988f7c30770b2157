from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import (
    check_foreign_key,
    check_not_null,
    check_row_counts,
    check_schema,
    check_source_target,
    check_unique,
    column_overview,
    dedup,
    describe,
    distinct_values,
    drop_columns,
    drop_empty_rows,
    drop_incomplete_rows,
    drop_sparse_columns,
    fail_if_any,
    lookup_join,
    missing_profile,
    only_missing,
    peek,
    rename,
    shape,
    sparse_columns,
    sparse_rows,
    with_missing_count,
    with_surrogate_key,
)
from starloom.operators.joins import _hot_rows, lookup_joins
from starloom.operators.quality import QualityError


@pytest.fixture(scope="module")
def gappy(spark):
    return spark.createDataFrame(
        [
            (1, 1.0, "a", None),
            (2, math.nan, "b", None),
            (3, None, None, None),
            (None, None, None, None),
        ],
        "k int, `Median Age` double, s string, empty string",
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a tenth without one, the rest spread out."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 800)
    fact = spark.range(30000).select("id", key.alias("a"), (F.col("id") % 2).alias("b"))
    lookup = spark.range(1400).select(
        (F.col("id") / 2).cast("int").alias("a"),
        (F.col("id") % 2).alias("b"),
        F.concat(F.lit("x"), "id").alias("text"),
    )
    return fact, lookup


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# rows and columns


def test_drop_empty_rows_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(math.nan, None), (1.0, None), (None, "x")], "a double, b string")
    assert rows(drop_empty_rows(df)) == [(1.0, None), (None, "x")]


def test_drop_incomplete_rows_counts_nan_as_missing(gappy):
    kept = drop_incomplete_rows(gappy, ["Median Age", "s"])
    assert [r.k for r in kept.collect()] == [1]


def test_columns_are_dropped_and_renamed_leniently(gappy):
    df = rename(drop_columns(gappy, ["s", "absent"]), {"Median Age": "median_age", "absent": "x"})
    assert df.columns == ["k", "median_age", "empty"]


def test_sparse_columns_are_above_the_threshold(gappy):
    assert sparse_columns(gappy, 0.9) == ["empty"]
    assert sparse_columns(gappy, 0.7) == ["Median Age", "empty"]
    assert drop_sparse_columns(gappy, 0.75).columns == ["k", "Median Age", "s"]


def test_missing_cells_per_row(gappy):
    got = {r.k: r.n_missing for r in with_missing_count(gappy).collect()}
    assert got == {1: 1, 2: 2, 3: 3, None: 4}
    assert {r.k for r in sparse_rows(gappy, 0.5).collect()} == {3, None}


def test_peek_is_ordered(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in peek(df, 3, "id").collect()] == [0, 1, 2]
    assert peek(df).count() == 5


# distinct and de-duplication


def test_distinct_keeps_null_once(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3), (None, 4)], "v string, w int")
    assert rows(distinct_values(df, "v")) == [("a",), (None,)]


def test_dedup_keeps_the_same_row_whatever_the_layout(spark):
    df = spark.range(2000).select(
        (F.col("id") % 97).alias("k"), (F.col("id") * 7919 % 2003).alias("v"), F.col("id")
    )
    expected = rows(dedup(df.coalesce(1), "k", ["v"]))
    assert len(expected) == 97
    assert rows(dedup(df.repartition(13), "k", ["v"])) == expected
    by_hand = {}
    for k, v, i in df.collect():
        by_hand[k] = min(by_hand.get(k, (v, i)), (v, i))
    assert {r[0]: (r[1], r[2]) for r in expected} == by_hand


def test_dedup_treats_null_nan_and_signed_zero_keys_as_equal(spark):
    keys = [None, None, math.nan, math.nan, 0.0, -0.0, 1.0]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k double, v int")
    for survivor in ("first", "any"):
        assert dedup(df, "k", survivor=survivor).count() == 4
    assert sorted(r.v for r in dedup(df, "k").collect()) == [0, 2, 4, 6]


def test_dedup_of_whole_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(dedup(df, "k")) == [(1,), (2,)]


def test_dedup_ranks_before_the_shuffle(skewed, plan):
    text = plan(dedup(skewed[0], "a"))
    before_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and text.count("Exchange") == 1


# surrogate keys


@pytest.mark.parametrize("partitions", [1, 5, 23])
def test_surrogate_keys_are_dense_ranks(spark, setting, partitions):
    setting("spark.sql.adaptive.enabled", "false")
    df = spark.range(5000).select(F.expr("concat('n', id * 7 % 5000)").alias("name"))
    keyed = with_surrogate_key(df.repartition(partitions), "name", "key")
    got = sorted((r.name, r.key) for r in keyed.collect())
    assert got == [(n, i) for i, n in enumerate(sorted(f"n{i}" for i in range(5000)))]


def test_surrogate_key_of_null_and_of_nothing(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "m string")
    assert rows(with_surrogate_key(df, "m")) == [("a", 1), ("b", 2), (None, 0)]
    assert with_surrogate_key(df.limit(0), "m").count() == 0


# lookups


def test_lookup_join_keeps_the_fact_rows(spark):
    fact = spark.createDataFrame([("a", 1), (None, 2), ("z", 3), ("a", 4)], "m string, v int")
    lookup = spark.createDataFrame([("a", 10), (None, 11), ("b", 12)], "member string, key int")
    joined = lookup_join(fact, lookup, {"m": "member"})
    assert joined.columns == ["m", "v", "key"]
    assert rows(joined) == [("a", 1, 10), ("a", 4, 10), ("z", 3, None), (None, 2, None)]


def test_lookup_join_of_double_and_int_keys(spark):
    fact = spark.createDataFrame([(1.0,), (2.0,), (None,)], "code double")
    lookup = spark.createDataFrame([(1, "one")], "code int, name string")
    assert rows(lookup_join(fact, lookup, "code")) == [(1.0, "one"), (2.0, None), (None, None)]


def test_lookup_join_refuses_or_reduces_duplicates(spark):
    fact = spark.createDataFrame([("a",)], "m string")
    lookup = spark.createDataFrame([("a", 2), ("a", 1), (None, 1), (None, 2)], "m string, key int")
    with pytest.raises(ValueError, match="up to 2 rows per key"):
        lookup_join(fact, lookup, "m")
    assert rows(lookup_join(fact, lookup, "m", duplicates="first")) == [("a", 1)]
    assert rows(lookup_join(fact, lookup.where("m is null"), "m")) == [("a", None)]


@pytest.mark.parametrize(
    ("hot_share", "broadcast_bytes"),
    [(0.05, 2000), (0.0005, 20000), (1e-9, 20000), (1e-9, 0), (1.0, 20000)],
)
def test_lookup_join_large_equals_plain_join(skewed, hot_share, broadcast_bytes):
    fact, lookup = skewed
    plain = fact.join(lookup, ["a", "b"], "left").select("id", "a", "b", "text")
    large = lookup_join(
        fact, lookup, ["a", "b"], broadcast_bytes=broadcast_bytes, hot_share=hot_share
    )
    assert large.columns == ["id", "a", "b", "text"]
    assert rows(large) == rows(plain)
    assert rows(lookup_join(fact, lookup, ["a", "b"])) == rows(plain)


def test_hot_keys_are_the_hottest_that_fit(spark):
    key = F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 3 == 0, 2).otherwise(F.col("id") % 5 + 3)
    used = spark.range(1000).select(key.alias("_key0"))
    right = spark.createDataFrame([(1, "x" * 968), (2, "y" * 968), (5, "z")], "_key0 int, text string")
    for limit, found in ((999, set()), (1000, {1}), (3000, {1, 2, 5})):
        hot = _hot_rows(used, right, ["_key0"], ["text"], 0.02, limit)
        assert {r[0] for r in hot.collect()} == found
    assert rows(_hot_rows(used, right, ["_key0"], ["text"], 0.4, 3000)) == [(1, "x" * 968)]


def test_chained_large_lookups_read_the_fact_once_each(spark, plan, tmp_path):
    fact = spark.range(3000).select("id", *[(F.col("id") % (50 + i)).alias(f"k{i}") for i in range(3)])
    fact.write.parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    lookups = [
        (spark.range(60).select(F.col("id").alias(f"k{i}"), (F.col("id") * 7).alias(f"v{i}")), f"k{i}")
        for i in range(3)
    ]
    joined = lookup_joins(fact, *lookups, broadcast_bytes=200)
    # Paths are shortened in long plans; the columns read tell the fact's scans.
    assert plan(joined).count("ReadSchema: struct<id:bigint,k0:bigint,k1:bigint,k2:bigint>") == 1
    assert sorted(rows(joined)) == sorted((*r, *[7 * k for k in r[1:]]) for r in rows(fact))


def test_lookups_refuse_what_they_cannot_keep(spark):
    fact = spark.createDataFrame([(1, "a")], "k int, name string")
    lookup = spark.createDataFrame([(1, "b")], "k int, Name string")
    with pytest.raises(ValueError, match="name"):
        lookup_join(fact, lookup, "k")
    with pytest.raises(ValueError, match="hot_share"):
        lookup_join(fact, lookup.drop("Name"), "k", hot_share=0)


HELPERS = ("_rank", "_part", "_pos", "_slot", "_size", "_offset", "_n_rows", "_rows", "_n", "_hot", "_key0", "_done", "_salt", "_zero", "_bytes")


def test_columns_named_like_helpers_survive(spark):
    names = ("k", *HELPERS)
    values = [(k, *[10 * k + i for i in range(len(HELPERS))]) for k in (1, 1, 2)]
    df = spark.createDataFrame(values, ", ".join(f"{n} int" for n in names))
    assert rows(dedup(df, "k")) == sorted(set(values))
    assert rows(with_surrogate_key(dedup(df, "k"), "k", "id")) == [(*v, i) for i, v in enumerate(sorted(set(values)))]
    assert {r.column_name: r.missing for r in missing_profile(df).collect()} == dict.fromkeys(names, 0)
    assert rows(check_not_null(df, names))[0][1:] == (3, 0, True)
    assert rows(check_unique(df, ("_n", "_rows")))[0][1:3] == (3, 1)
    lookup = spark.createDataFrame([(1, "x"), (2, "y")], "k int, _shuffled0 string")
    for size in (10**6, 1):
        joined = lookup_join(df, lookup, "k", broadcast_bytes=size)
        assert rows(joined) == sorted((*v, {1: "x", 2: "y"}[v[0]]) for v in values)
    with pytest.raises(ValueError, match="k"):
        with_surrogate_key(df, "_n", "k")


def test_the_more_complete_duplicate_survives_and_maps_are_ordered(spark):
    df = spark.createDataFrame(
        [(1, None, {"a": 2}, ({"b": 1},)), (1, 30.0, {"a": 3}, ({"b": 0},)), (1, 30.0, {"a": 2}, ({"b": 1},))],
        "k int, v double, m map<string,int>, s struct<m: map<string,int>>",
    )
    for layout in (df, df.repartition(3)):
        assert [tuple(r) for r in dedup(layout, "k").collect()] == [(1, 30.0, {"a": 2}, ({"b": 1},))]


def test_quartiles_with_infinities_ties_and_many_values(spark):
    inf = math.inf
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, inf, inf, inf)], "v double")
    assert [tuple(r)[5:] for r in describe(df).collect()] == [(2.0, inf, inf, inf)]
    many = spark.range(300_000).select((F.col("id") * 7919 % 300_000).alias("a"), F.when(F.col("id") % 10 > 0, 5).alias("t"))
    got = {r.column_name: r for r in describe(many).collect()}
    assert (got["a"].p25, got["a"].p50, got["a"].p75) == (74999.75, 149999.5, 224999.25)
    assert (got["t"]["count"], got["t"].p25, got["t"].p75) == (270_000, 5.0, 5.0)


def test_lookup_join_broadcasts_by_measured_size(skewed, plan, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact, lookup = skewed
    small = plan(lookup_join(fact, lookup, ["a", "b"]))
    large = plan(lookup_join(fact, lookup, ["a", "b"], broadcast_bytes=100))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in large


# profiles


def test_missing_profile(gappy):
    assert rows(missing_profile(gappy)) == [
        ("Median Age", 3, 75.0, 4),
        ("empty", 4, 100.0, 4),
        ("k", 1, 25.0, 4),
        ("s", 2, 50.0, 4),
    ]
    full = only_missing(missing_profile(gappy.where("k = 1").drop("empty")))
    assert full.isEmpty()


def test_missing_profile_of_nothing(gappy):
    got = missing_profile(gappy.limit(0)).collect()
    assert {(r.missing, r.pct_missing) for r in got} == {(0, None)}


def test_shape_and_overview(gappy):
    assert tuple(shape(gappy).first()) == (4, 4)
    overview = {r.column_name: r for r in column_overview(gappy).collect()}
    assert overview["Median Age"].data_type == "double"
    assert overview["s"].position == 2 and overview["s"].missing == 2


@pytest.mark.parametrize("partitions", [1, 17])
def test_describe_equals_numpy(spark, partitions):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(3, 2, 1501), np.full(800, 1.5), rng.integers(0, 9, 700)])
    data = [(float(v), int(i % 3), "t") for i, v in enumerate(values)]
    data += [(math.nan, None, None), (None, 2, "t")]
    df = spark.createDataFrame(data, "a double, b int, c string").repartition(partitions)
    got = {r.column_name: r for r in describe(df).collect()}
    assert got.keys() == {"a", "b"}
    for name, column in (("a", values), ("b", np.array([i % 3 for i in range(len(values))] + [2]))):
        row = got[name]
        assert row["count"] == len(column)
        wanted = [column.mean(), column.std(ddof=1), column.min()]
        wanted += [*np.quantile(column, [0.25, 0.5, 0.75]), column.max()]
        assert [row[n] for n in ("mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(
            wanted
        )


def test_describe_over_many_range_partitions(spark, setting):
    setting("spark.sql.adaptive.enabled", "false")
    got = describe(spark.range(1001).select((F.col("id") * 2).alias("v"))).first()
    assert (got["count"], got["min"], got.p25, got.p50, got.p75, got["max"]) == (
        1001,
        0.0,
        500.0,
        1000.0,
        1500.0,
        2000.0,
    )


@pytest.mark.parametrize("order", [["b", "a"], ["a", "b"]])
def test_describe_where_two_neighbours_hold_a_bracket(spark, order):
    """Brackets that hold hundreds of thousands of equal values, beside one that lies elsewhere."""
    i = F.col("id")
    b = F.when(i < 600_000, 0).when(i < 999_740, 1).when(i < 1_000_040, 2).when(i < 1_300_040, 3).otherwise(4)
    df = spark.range(2_000_000).select(b.alias("b"), (i % 2).alias("a"))
    got = {r.column_name: (r.p25, r.p50, r.p75) for r in describe(df, order).collect()}
    assert got == {"b": (0.0, 2.0, 4.0), "a": (0.0, 0.5, 1.0)}


def test_describe_takes_two_scans(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return float(x * x % 1009) if x % 7 else None

    df = spark.range(0, 150_000, 1, 4).select(*[F.udf(look, "double")("id").alias(c) for c in "ab"])
    got = describe(df).collect()
    # One call per row and scan: both columns are the same expression.
    assert seen.value == 2 * 150_000
    values = np.array([x * x % 1009 for x in range(150_000) if x % 7])
    for r in got:
        assert (r.p25, r.p50, r.p75) == tuple(np.quantile(values, [0.25, 0.5, 0.75]))


def test_describe_of_empty_and_single(spark):
    df = spark.createDataFrame([(4.0, None)], "one double, none double")
    got = {r.column_name: tuple(r)[1:] for r in describe(df).collect()}
    assert got == {
        "one": (1, 4.0, None, 4.0, 4.0, 4.0, 4.0, 4.0),
        "none": (0, None, None, None, None, None, None, None),
    }


# quality


def test_row_counts_pass_and_fail(spark):
    report = check_row_counts({"full": spark.range(3), "bare": spark.range(0)})
    assert rows(report) == [("bare", 0, False), ("full", 3, True)]
    with pytest.raises(QualityError, match="bare"):
        fail_if_any(report)
    assert fail_if_any(report.where("passed")).count() == 1


def test_unique_check(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (None,), (2,)], "k int")
    assert tuple(check_unique(df, "k").first()) == ("unique(k)", 6, 3, False)
    assert tuple(check_unique(df.limit(0), "k").first()) == ("unique(k)", 0, 0, True)


def test_not_null_check(gappy):
    assert rows(check_not_null(gappy, ["k", "Median Age"])) == [
        ("not_null(Median Age)", 4, 3, False),
        ("not_null(k)", 4, 1, False),
    ]


def test_foreign_key_check_ignores_null_and_repeated_parents(spark):
    child = spark.createDataFrame([(1,), (1,), (3,), (3,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk int")
    got = check_foreign_key(child, parent, {"fk": "pk"}).first()
    assert tuple(got) == ("foreign_key(fk)", 4, 2, False)


def test_source_target_check(spark):
    assert tuple(check_source_target(spark.range(9), spark.range(7), 2).first()) == (9, 7, True)
    assert not check_source_target(spark.range(9), spark.range(7)).first().passed


def test_schema_check(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, s string, extra double")
    assert rows(check_schema(df, "k bigint, s string, gone date")) == [
        ("extra", None, "double", False),
        ("gone", "date", None, False),
        ("k", "bigint", "int", False),
        ("s", "string", "string", True),
    ]
