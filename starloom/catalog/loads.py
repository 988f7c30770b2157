"""Loads that come one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import standins as s
from starloom.catalog.registry import query, table
from starloom.plans.facts import with_dimension_key
from starloom.plans.loads import extend_dimension, load_immigration_month, load_month
from starloom.scratch import scratch_path

# Members of the first load, a little over half of all; the second load has further ones.
_EARLY = "o_orderdate < timestamp '1998-01-01'"
_MEMBER = "case when o_orderpriority <> '5-LOW' or o_orderstatus <> 'O' then o_orderpriority || o_orderstatus end"
_MEMBERS = f"""
    select member, row_number() over (order by later, member nulls first) - 1 as member_key
    from (select {_MEMBER} as member, min(not coalesce({_EARLY}, false)) as later
          from orders group by 1)
"""


def _with_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("member", F.expr(_MEMBER))


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders, path = _with_member(spark, sf_dir), scratch_path(spark, "members")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    extend_dimension(orders.where(early), path, "member", "member_key")
    return orders, extend_dimension(orders.where(~early), path, "member", "member_key")


@query(_MEMBERS)
def keys_over_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the first load keep their keys when the second brings further ones."""
    return _two_loads(spark, sf_dir)[1]


@query(
    f"""
    select o_orderkey, member_key
    from (select o_orderkey, {_MEMBER} as member from orders) o left join ({_MEMBERS}) m on o.member = m.member
    """
)
def fact_over_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the key that its member was given, by whichever load."""
    orders, members = _two_loads(spark, sf_dir)
    return with_dimension_key(orders.select("o_orderkey", "member"), members, "member")


_SLICE = "case when l_shipdate < timestamp '1997-01-01' then '1996' when l_shipdate < timestamp '1999-01-01' then '1998' else '2000' end"
_LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
_FIRST = "partition by l_orderkey, l_linenumber order by load_month, l_partkey, l_suppkey, l_quantity"


def _slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*_LINE, F.expr(_SLICE.replace("timestamp '", "timestamp_ntz '")).alias("slice"))


@query(
    f"""
    select {", ".join(_LINE)}, {_SLICE} as load_month from lineitem
    qualify row_number() over ({_FIRST}) = 1
    """
)
def monthly_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads out of order and one twice; a line of several loads counts in the earliest."""
    lines, path = _slices(spark, sf_dir), scratch_path(spark, "monthly")
    for month in ("1998", "2000", "1996", "1998"):
        loaded = load_month(lines.where(F.col("slice") == month).drop("slice"), path, month, ["l_orderkey", "l_linenumber"])
    return loaded


@query(
    f"""
    with kept as (
        select {", ".join(_LINE)}, {_SLICE} as load_month from lineitem
        where not ({_SLICE} = '1996' and l_partkey % 3 = 0))
    select * from kept qualify row_number() over ({_FIRST}) = 1
    """
)
def monthly_load_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load again with fewer rows: later loads get back what it no longer holds."""
    lines, path = _slices(spark, sf_dir), scratch_path(spark, "monthly")
    keys = ["l_orderkey", "l_linenumber"]
    for month in ("1996", "1998", "2000"):
        load_month(lines.where(F.col("slice") == month).drop("slice"), path, month, keys)
    fewer = lines.where((F.col("slice") == "1996") & (F.col("l_partkey") % 3 != 0)).drop("slice")
    return load_month(fewer, path, "1996", keys)


_RECORDS = f"""
    select *, case when arrdate < 13000 then 199508 else 199999 end as load_month
    from ({s.RAW_ARRIVALS}) where cicid is not null
    qualify row_number() over (partition by cicid order by load_month, i94yr, i94mon, i94res, arrdate,
                               i94addr, depdate, "count", matflag, visatype) = 1
"""


@query(
    f"""
    with types as (
        select visatype, row_number() over (order by later, visatype nulls first) - 1 as visa_type_key
        from (select visatype, min(load_month > 199508) as later from ({_RECORDS}) group by 1))
    select record_id, arrdate, visatype, visa_type_key, load_month
    from (select cicid as record_id, date '1960-01-01' + nullif(arrdate, 0)::int as arrdate, visatype, load_month
          from ({_RECORDS})) left join types using (visatype)
    """
)
def immigration_two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, output = s.raw_arrivals(spark, sf_dir), scratch_path(spark, "months")
    early = F.coalesce(F.col("arrdate") < 13000, F.lit(False))
    load_immigration_month(raw.where(early), output, 199508)
    built = load_immigration_month(raw.where(~early), output, 199999)
    named = built["visatype"].select(F.col("visa_type_key"), "visatype")
    fact = built["immigration_fact"].select("record_id", "arrdate", "visa_type_key", "load_month")
    return fact.join(F.broadcast(named), "visa_type_key", "left")
