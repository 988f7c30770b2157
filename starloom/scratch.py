"""Where intermediate tables go.

Lineage is cut by writing a Parquet table below the shared folder the session
names in ``spark.checkpoint.dir``: the copy outlives any executor, is read back
column by column, and its file sizes give the optimizer true statistics.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; where none is set, one beside its tables."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def session_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_dir(spark)}/starloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below this application's folder that nothing has used before."""
    return f"{session_dir(spark)}/{name}-{uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; results not yet written are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
