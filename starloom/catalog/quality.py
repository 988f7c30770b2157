"""Quality checks on the given data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from starloom.catalog.cleaning import GAPPY, gappy_lines
from starloom.catalog.registry import query, table
from starloom.operators import (
    check_foreign_key,
    check_not_null,
    check_row_counts,
    check_schema,
    check_source_target,
    check_unique,
    dedup,
    drop_incomplete_rows,
)

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query(
    " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count, count(*) > 0 as passed from {t}"
        for t in _TABLES
    )
)
def quality_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_row_counts({t: table(spark, sf_dir, t) for t in _TABLES})


def _check(name: str, rows: str, violations: str, source: str) -> str:
    return f"""
        select '{name}' as check_name, {rows}::bigint as n_checked,
               {violations}::bigint as n_violations, {violations} = 0 as passed
        from {source}
    """


@query(
    _check("unique(o_orderkey)", "count(*)", "count(*) - count(distinct o_orderkey)", "orders")
    + "union all"
    + _check(
        "unique(l_orderkey, l_linenumber)",
        "sum(n)",
        "sum(n - 1)",
        "(select count(*) as n from lineitem group by l_orderkey, l_linenumber)",
    )
)
def quality_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return check_unique(table(spark, sf_dir, "orders"), "o_orderkey").unionByName(
        check_unique(lines, ["l_orderkey", "l_linenumber"])
    )


@query(
    " union all ".join(
        _check(f"not_null({c})", "count(*)", f"(count(*) - count({c}))", f"({GAPPY})")
        for c in ("l_orderkey", "l_discount", "l_returnflag")
    )
)
def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_null(gappy_lines(spark, sf_dir), ["l_orderkey", "l_discount", "l_returnflag"])


@query(
    _check("foreign_key(o_custkey)", "count(*)", "(count(*) - count(c_custkey))",
           "orders left join customer on o_custkey = c_custkey")
    + "union all"
    + _check("foreign_key(l_orderkey)", "count(*)", "(count(*) - count(k))",
             "lineitem left join (select o_orderkey as k from orders "
             "where o_orderstatus <> 'P') on l_orderkey = k")
)
def quality_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    closed = orders.where("o_orderstatus <> 'P'")
    checks = [
        check_foreign_key(orders, table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}),
        check_foreign_key(
            table(spark, sf_dir, "lineitem"), closed, {"l_orderkey": "o_orderkey"}
        ),
    ]
    return reduce(DataFrame.unionByName, checks)


@query(
    f"""
    select count(*) as n_source, count(distinct (l_orderkey, l_linenumber))
               filter (l_discount is not null) as n_target,
           count(*) = n_target as passed
    from ({GAPPY})
    """
)
def quality_source_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = gappy_lines(spark, sf_dir)
    clean = dedup(
        drop_incomplete_rows(lines, "l_discount"), ["l_orderkey", "l_linenumber"], survivor="any"
    )
    return check_source_target(lines, clean)


@query(
    """
    select column_name, expected_type, actual_type, expected_type is not distinct from actual_type as passed
    from (values ('o_orderkey', 'bigint', 'bigint'), ('o_custkey', 'int', 'bigint'),
                 ('o_orderstatus', null, 'string'), ('o_totalprice', 'double', 'double'),
                 ('o_orderdate', 'timestamp_ntz', 'timestamp_ntz'), ('o_orderpriority', null, 'string'),
                 ('o_comment', 'string', null)) t(column_name, expected_type, actual_type)
    where exists (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders)
    """
)
def quality_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored types of orders beside some that are expected, right, wrong and absent."""
    expected = "o_orderkey bigint, o_custkey int, o_totalprice double, o_orderdate timestamp_ntz, o_comment string"
    return check_schema(table(spark, sf_dir, "orders"), expected)
