"""Files written from the given data and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import standins as s
from starloom.catalog.registry import query, table
from starloom.functions import sas_days
from starloom.plans.dimensions import calendar_dimension, state_population
from starloom.plans.facts import star_join
from starloom.plans.star import Star, StarSources, build_star, open_star, write_calendar
from starloom.scratch import scratch_path
from starloom.sources import (
    file_inventory,
    read_csv,
    read_many,
    read_with_rejects,
    stage,
    write_partitioned,
    write_table,
)


@query("select * from orders")
def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(table(spark, sf_dir, "orders"), scratch_path(spark, "staged"))


@query("select o_orderkey, o_totalprice from orders")
def overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "overwritten")
    orders = table(spark, sf_dir, "orders")
    write_table(orders.select("o_orderkey"), path)
    return write_table(orders.select("o_orderkey", "o_totalprice"), path)


def _csv(df: DataFrame, sep: str) -> str:
    path = scratch_path(df.sparkSession, "csv")
    df.write.options(header=True, sep=sep).csv(path)
    return path


@query("select * from customer")
def csv_comma_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return read_csv(spark, _csv(customer, ","), customer.schema)


@query(s.DEMOGRAPHICS)
def csv_semicolon_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = s.demographics(spark, sf_dir)
    return read_csv(spark, _csv(people, ";"), people.schema, sep=";")


@query("select cast(c_custkey as integer) as c_custkey, c_name, c_acctbal from customer")
def csv_inferred_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return read_csv(spark, _csv(customer, ","))


@query(s.CALENDAR)
def calendar_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    calendar = calendar_dimension(orders.select(sas_days(F.col("o_orderdate")).alias("arrdate")))
    return write_calendar(calendar, scratch_path(spark, "calendar"))


@query(
    """
    select o_orderkey, o_orderstatus,
           case when o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end as o_totalprice
    from orders
    """
)
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-by-status")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_partitioned(orders, path, "o_orderstatus")
    changed = orders.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.expr("o_totalprice + 1"))
    return write_partitioned(changed, path, "o_orderstatus", replace="partitions")


@query(
    """
    select strftime(l_shipdate, '%Y-%m') as month, count(*) as n_rows, 12 as n_columns
    from lineitem group by 1
    """
)
def monthly_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines-by-month")
    lines = table(spark, sf_dir, "lineitem")
    write_partitioned(
        lines.withColumn("month", F.date_format("l_shipdate", "yyyy-MM")), path, "month"
    )
    files = file_inventory(spark, path)
    month = F.regexp_extract("file_path", "month=([0-9-]+)", 1)
    return files.groupBy(month.alias("month")).agg(
        F.sum("n_rows").alias("n_rows"), F.max("n_columns").alias("n_columns")
    )


@query(
    """
    select o_orderkey, o_orderdate,
           case when o_orderdate >= timestamp '1998-01-01' then o_orderpriority end
               as o_orderpriority
    from orders
    """
)
def months_with_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    early, late = scratch_path(spark, "early"), scratch_path(spark, "late")
    is_late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    orders.where(~is_late).drop("o_orderpriority").write.parquet(early)
    orders.where(is_late).write.parquet(late)
    return read_many(spark, [early, late])


@query(
    """
    select o_orderpriority, count(*) as n_rows, count_if(o_orderpriority = '1-URGENT') as n_malformed,
           round(sum(case when o_orderpriority <> '1-URGENT' then o_totalprice end), 2) as total
    from orders group by 1
    """
)
def malformed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1,200 or so"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        price.otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
    )
    schema = "o_orderkey bigint, o_orderpriority string, o_totalprice double"
    lines = read_csv(spark, _csv(orders, ";"), schema, sep=";", malformed="line")
    return lines.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("line").alias("n_malformed"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


@query(
    """
    select o_orderpriority, count(*) as n_rows, 0 as n_rejected,
           round(sum(o_totalprice), 2) as total, null as reason
    from orders where o_orderpriority <> '1-URGENT' or o_orderstatus = 'F' group by 1
    union all
    select o_orderpriority, 0, count(*), null, 'o_totalprice: 1,200 or so is not a double'
    from orders where o_orderpriority = '1-URGENT' and o_orderstatus <> 'F' group by 1
    """
)
def months_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Parquet month holds prices as text, some of which are none; the other loads as it is."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    bad = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "F")
    price = F.when(bad, F.lit("1,200 or so")).otherwise(F.col("o_totalprice").cast("string"))
    text, plain = scratch_path(spark, "text-month"), scratch_path(spark, "plain-month")
    is_text = F.col("o_orderpriority") == "1-URGENT"
    orders.where(is_text).withColumn("o_totalprice", price).write.parquet(text)
    orders.where(~is_text).write.parquet(plain)
    schema = "o_orderkey bigint, o_orderpriority string, o_totalprice double"
    good, rejects = read_with_rejects(spark, [plain, text], schema)
    kept = good.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(0).cast("long").alias("n_rejected"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.lit(None).cast("string").alias("reason"),
    )
    told = rejects.select(F.get_json_object("row", "$.o_orderpriority").alias("o_orderpriority"), F.explode("reasons").alias("reason"))
    lost = told.groupBy("o_orderpriority", "reason").agg(F.count(F.lit(1)).alias("n_rejected"))
    return kept.unionByName(
        lost.select("o_orderpriority", F.lit(0).cast("long").alias("n_rows"), "n_rejected", F.lit(None).cast("double").alias("total"), "reason")
    )


@query("select c_custkey, 'Å' || c_name as c_name from customer")
def csv_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("Å"), "c_name").alias("c_name")
    )
    path = scratch_path(spark, "csv")
    named.write.options(header=True, encoding="ISO-8859-1").csv(path)
    return read_csv(spark, path, named.schema, encoding="ISO-8859-1")


@query(
    """
    select o_orderkey, o_totalprice,
           case when o_orderdate >= timestamp '1998-01-01' then o_orderpriority end
               as o_orderpriority
    from orders
    """
)
def csv_months_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    orders = table(spark, sf_dir, "orders")
    early = orders.where(~is_late).select("o_totalprice", "o_orderkey")
    late = orders.where(is_late).select("o_orderkey", "o_orderpriority", "o_totalprice")
    schema = "o_orderkey bigint, o_totalprice double, o_orderpriority string"
    return read_many(spark, [_csv(early, ","), _csv(late, ",")], "csv", schema)


@query(
    """
    select 2 as n_columns, count(*) as n_rows from orders
    union all select 3, count(*) from customer
    """
)
def inventory_mixed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mixed")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").write.parquet(path)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    customer.write.mode("append").parquet(path)
    return file_inventory(spark, path).groupBy("n_columns").agg(F.sum("n_rows").alias("n_rows"))


def _star(spark: SparkSession, sf_dir: str, output: str | None = None, versioned: bool = False) -> Star:
    arrivals = scratch_path(spark, "arrivals")
    s.arrivals(spark, sf_dir).write.parquet(arrivals)
    sources = StarSources(
        immigration=arrivals,
        temperature=_csv(s.readings(spark, sf_dir), ","),
        demographics=_csv(s.demographics(spark, sf_dir), ";"),
        country_codes=_csv(s.country_codes(spark, sf_dir), ","),
    )
    output = output or scratch_path(spark, "star")
    return build_star(spark, sources, output, fail_on_empty=True, versioned=versioned)


@query(
    " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count, true as passed from ({sql})"
        for name, sql in (
            ("immigration_fact", s.FACT),
            ("immigration_calendar", s.CALENDAR),
            ("country", s.COUNTRIES),
            ("visatype", s.VISA_TYPES),
            ("demographics", s.CLEAN_DEMOGRAPHICS),
        )
    )
)
def star_build_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).quality()


@query(s.CALENDAR)
def star_version_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star as a version of its five tables, found through the pointer."""
    output = scratch_path(spark, "star")
    _star(spark, sf_dir, output, versioned=True)
    return open_star(spark, output).immigration_calendar


@query(
    f"""
    select record_id, f.arrdate, visatype, arrival_week, country_name,
           round(average_temperature, 4) as average_temperature, total_population
    from ({s.FACT}) f
         left join ({s.CALENDAR}) c on f.arrdate = c.arrdate
         left join ({s.COUNTRIES}) on country_residence_code = country_code
         left join ({s.VISA_TYPES}) v on f.visa_type_key = v.visa_type_key
         left join ({s.STATES}) p on f.state_code = p.state_code
    """
)
def star_build_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    joined = star_join(
        star.immigration_fact,
        star.immigration_calendar,
        star.country,
        star.visatype,
        state_population(star.demographics),
    )
    return joined.select(
        "record_id",
        "arrdate",
        "visatype",
        "arrival_week",
        "country_name",
        F.round("average_temperature", 4).alias("average_temperature"),
        "total_population",
    )


@query(
    " union all ".join(
        f"""
        select '{source}' as source, n_in as rows_in, n_in - n_kept as dropped_missing,
               n_kept - n_out as dropped_duplicates, n_out as rows_out
        from (select count(*) as n_in, count_if({kept}) as n_kept, ({out}) as n_out from ({raw}))
        """
        for source, raw, kept, out in (
            ("immigration", s.ARRIVALS, "true", f"select count(*) from ({s.ARRIVALS})"),
            ("temperature", s.READINGS, '"AverageTemperature" is not null', f"select count(*) from ({s.CLEAN_READINGS})"),
            ("demographics", s.DEMOGRAPHICS, '"Number of Veterans" is not null', f"select count(*) from ({s.CLEAN_DEMOGRAPHICS})"),
        )
    )
)
def star_build_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cleaning removed, counted while the star was written."""
    return _star(spark, sf_dir).cleaning
