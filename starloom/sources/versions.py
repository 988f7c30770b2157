"""Several tables that change together: versions below one folder and a small pointer.

``<path>/versions/<version>/<table>`` holds the data and ``<path>/CURRENT`` names the
version in force, with the schema of each of its tables. The pointer is replaced last,
in one step, so a reader sees all tables of one version or all of another, and a build
that fails at any point before leaves the old one in force.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.sources.writers import hadoop_path, publish, read_partitioned

POINTER = "CURRENT"


def publish_version(spark: SparkSession, path: str, tables: Mapping[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """Move built tables (name to table and the folder it lies in) into a new version and put it in force."""
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid4().hex[:8]}"
    schemas = {}
    for name, (table, built) in tables.items():
        publish(table, built, f"{path}/versions/{version}/{name}")
        schemas[name] = json.loads(table.schema.json())
    _replace(spark, f"{path}/{POINTER}", json.dumps({"version": version, "tables": schemas}))
    return read_version(spark, path)


def read_version(spark: SparkSession, path: str, version: str | None = None) -> dict[str, DataFrame]:
    """All tables of the version in force, or of an older one whose tables have the same schemas."""
    pointer = current(spark, path)
    if pointer is None:
        raise FileNotFoundError(f"no version has been published at {path}")
    folder = f"{path}/versions/{version or pointer['version']}"
    return {
        name: read_partitioned(spark, f"{folder}/{name}", T.StructType.fromJson(schema))
        for name, schema in pointer["tables"].items()
    }


def current(spark: SparkSession, path: str) -> dict | None:
    """What the pointer says: ``version`` and the schemas of its ``tables``."""
    files, pointer = hadoop_path(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[str]:
    """All versions, the oldest first, also those that were never put in force."""
    files, folder = hadoop_path(spark, f"{path}/versions")
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all versions but the newest ``keep`` and the one in force; readers of a deleted one fail."""
    held = (current(spark, path) or {}).get("version")
    found = versions(spark, path)
    gone = [v for v in found[: max(0, len(found) - keep)] if v != held]
    for version in gone:
        files, folder = hadoop_path(spark, f"{path}/versions/{version}")
        files.delete(folder, True)
    return gone


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Write a file aside and rename it over the old one; a rename is one step."""
    files, aside = hadoop_path(spark, f"{path}.{uuid4().hex}")
    stream = files.create(aside)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    over = gateway.new_array(fs.Options.Rename, 1)
    over[0] = fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(aside), context.makeQualified(fs.Path(path)), over)
