"""Which files a source holds, and how large each is."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.names import as_list
from starloom.scratch import materialise
from starloom.sources.readers import read_table

# Tasks carry their code with them: executors need not have this package installed.
register_pickle_by_value(sys.modules[__name__])

# Files whose footers or headers are opened by the driver at the same time.
_OPEN = 16
#: Parquet files up to this size are opened inside tasks; the end of a file that is kept.
IN_TASKS = 32 * 1024 * 1024
_TAIL = 1024 * 1024
_FOOTERS = "file_path string, n_bytes long, n_rows long, names array<string>"


def file_inventory(
    spark: SparkSession, paths: str | Iterable[str], fmt: str = "parquet", **options: str
) -> DataFrame:
    """One row per file: ``file_path, n_bytes, n_rows, n_columns``.

    Folders are expanded to their files, and each file's column count is its own
    (folder columns included). Files without rows are listed with 0 rows.

    The listing stays a table. Parquet files of up to ``IN_TASKS`` bytes are opened inside
    tasks, which take both counts from their footers, so that very many small files are
    no work for the driver. Only Spark can reach every store, and it hands a task
    whole files; so larger ones, and files of other formats, are opened one by one from the
    driver for their columns, and their rows are counted by a scan that reads none.
    """
    paths = as_list(paths)
    bases = [_plain(path) for path in paths]
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    named = F.col("_metadata.file_path").alias("file_path")
    if fmt == "parquet":
        small = listed.where(F.col("length") <= IN_TASKS)
        tail = F.expr(f"substring(content, greatest(1, length(content) - {_TAIL - 1}))").alias("tail")
        ends = small.select(named, F.col("length").alias("n_bytes"), tail)
        footers = materialise(ends.mapInArrow(_footers, _FOOTERS), "file-footers")
        known = footers.where(F.col("names").isNotNull())
        folders = F.array_except(_folder_columns(F.col("file_path"), bases), F.col("names"))
        known = known.select("file_path", "n_bytes", "n_rows", (F.size("names") + F.size(folders)).alias("n_columns"))
        rest = listed.where(F.col("length") > IN_TASKS).select(named, F.col("length").alias("n_bytes"))
        rest = rest.unionByName(footers.where(F.col("names").isNull()).select("file_path", "n_bytes"))
        rest = materialise(rest, "large-files")
        if rest.isEmpty():
            return known
        return known.unionByName(_opened(spark, rest, paths, bases, fmt, options))
    files = listed.select(named, F.col("length").alias("n_bytes"))
    return _opened(spark, files, paths, bases, fmt, options)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and columns of Parquet files from their last bytes; NULL names where the footer is longer."""
    for batch in batches:
        rows, names = [], []
        for end in batch.column(2):
            found = _footer(end.as_py())
            rows.append(found.num_rows if found else None)
            names.append(found.schema.to_arrow_schema().names if found else None)
        columns = [*batch.columns[:2], pa.array(rows, pa.int64()), pa.array(names, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["file_path", "n_bytes", "n_rows", "names"])


def _footer(end: bytes) -> pq.FileMetaData | None:
    # A file ends with its footer, four bytes of the footer's length and the magic word.
    size = int.from_bytes(end[-8:-4], "little") + 8
    if size > len(end):
        return None
    return pq.read_metadata(pa.BufferReader(end[-4:] + end[-size:]))


def _folder_columns(path: Column, bases: list[str]) -> Column:
    """Names of ``name=value`` folders between a given path and the file."""
    inner = F.coalesce(*[F.when(F.contains(path, F.lit(_below(b))), F.substring_index(path, _below(b), -1)) for b in bases], F.lit(""))
    folders = F.filter(F.slice(F.split(inner, "/"), 1, F.greatest(F.size(F.split(inner, "/")) - 1, F.lit(0))), lambda p: F.contains(p, F.lit("=")))
    return F.array_distinct(F.transform(folders, lambda p: F.substring_index(p, "=", 1)))


def _below(base: str) -> str:
    return base.removeprefix("file:").lstrip("/") + "/"


def _opened(spark: SparkSession, files: DataFrame, paths: list[str], bases: list[str], fmt: str, options: dict) -> DataFrame:
    """Columns of each file from its own header or footer, rows by a scan without columns."""
    if fmt == "csv":
        options = {"header": True} | options

    def width(file: str) -> tuple[str, int]:
        base = {} if file.rstrip("/") in bases else {"basePath": _base(file, bases)}
        return file, len(read_table(spark, file, fmt, **base, **options).columns)

    names = [row.file_path for row in files.select("file_path").collect()]
    with ThreadPoolExecutor(_OPEN) as pool:
        widths = list(pool.map(width, names))
    columns = spark.createDataFrame(widths, "file_path string, n_columns int")
    counts = [
        read_table(spark, path, fmt, **options)
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        for path in paths
    ]
    rows = counts[0]
    for more in counts[1:]:
        rows = rows.unionByName(more)
    return files.join(rows, "file_path", "left").join(columns, "file_path").select(
        "file_path", "n_bytes", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "n_columns"
    )


def _plain(path: str) -> str:
    return path.rstrip("/")


def _base(file: str, bases: list[str]) -> str:
    """The given path a file lies below, so that its folder columns are seen."""
    for base in bases:
        if _below(base) in file:
            return base
    return file.rsplit("/", 1)[0]
