"""Writing tables, and reading back what was written."""

from __future__ import annotations

from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.names import as_list, col, fresh


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet table at ``path`` and return it as written."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: str | Iterable[str],
    replace: str = "table",
    tasks: int | None = None,
    as_it_lies: bool = False,
) -> DataFrame:
    """Write Parquet in one folder per value of ``by``.

    ``replace="table"`` replaces everything, ``"partitions"`` only the folders
    present in ``df``. The rebalance hint brings each folder's rows together, so
    small folders get one file, and lets adaptive execution split a folder that
    holds a large share of the rows over many tasks. It sizes tasks by bytes; a
    small table with very many folders is written faster by a stated number of
    ``tasks``, each taking a range of folders. ``as_it_lies`` moves no row: meant for
    one folder's rows that already lie in files of good size.
    """
    modes = {"table": "static", "partitions": "dynamic"}
    by = as_list(by)
    folders = [col(name) for name in by]
    if as_it_lies:
        arranged = df
    else:
        arranged = df.repartitionByRange(tasks, *folders) if tasks else df.hint("rebalance", *folders)
    (
        arranged.write.mode("overwrite")
        .option("partitionOverwriteMode", modes[replace])
        .partitionBy(*by)
        .parquet(path)
    )
    return read_partitioned(df.sparkSession, path, df.schema)


def write_bucketed(
    df: DataFrame, path: str, keys: str | Iterable[str], buckets: int | None = None
) -> DataFrame:
    """Write Parquet in hash buckets of ``keys``, sorted in each, as a table of the session's catalog.

    Joins and groups on the keys then need no shuffle of it, however often they run. All
    rows of a key lie in one bucket, so a key (or the missing ones) with more rows than
    four buckets should have is refused: ``lookup_join`` spreads such keys. The default
    number of buckets is that of shuffle partitions; tables joined need the same.
    """
    spark, keys = df.sparkSession, as_list(keys)
    buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = fresh("_rows", keys)
    sizes = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(rows))
    top, total = sizes.agg(F.max(rows), F.sum(rows)).first()
    if total and top * buckets > 4 * total:
        raise ValueError(f"one key of {keys} has {top} of {total} rows: too many for {buckets} buckets")
    name = f"bucketed_{uuid4().hex}"
    arranged = df.repartition(buckets, *[col(k) for k in keys])
    writer = arranged.write.format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a partitioned table in its original column order and types."""
    table = spark.read.schema(schema).parquet(path)
    return table.select(*[col(name) for name in schema.names])


def hadoop_path(spark: SparkSession, path: str):
    """The file system a path belongs to, and the path in its terms."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = hadoop_path(spark, path)
    return files.exists(target)


def publish(table: DataFrame, built: str, path: str) -> DataFrame:
    """Move a finished table from ``built`` to ``path``, in place of what lies there.

    The old table is moved aside first and deleted last. Both paths have to be in one
    file system; otherwise the table is copied.
    """
    spark = table.sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    source, target, aside = hadoop(built), hadoop(path), hadoop(path.rstrip("/") + ".replaced")
    files = source.getFileSystem(conf)
    if not files.getUri().equals(target.getFileSystem(conf).getUri()):
        table.write.mode("overwrite").parquet(path)
        return spark.read.schema(table.schema).parquet(path)
    files.mkdirs(target.getParent())
    files.delete(aside, True)
    if files.exists(target) and not files.rename(target, aside):
        raise OSError(f"{path} cannot be moved aside")
    if not files.rename(source, target):
        files.rename(aside, target)
        raise OSError(f"{built} cannot be moved to {path}")
    files.delete(aside, True)
    return read_partitioned(spark, path, table.schema)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Copy a raw table to Parquet at a new path and continue from the copy.

    Fails if the path exists. Text and binary row formats are parsed once, and
    every later step reads only the columns it needs.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
