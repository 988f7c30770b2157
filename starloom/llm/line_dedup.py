"""Lines that several documents share, kept once, over levelled sorted runs of line hashes.

A line's key is the line without blanks (``[\\x20\\x09-\\x0D]``) at its ends and with A-Z
lower-cased. Keys of at least ``min_chars`` code points found in at least ``min_docs``
documents lose all their lines except those of the largest document id that holds them.

Documents come in batches of falling ids. A run is a table of (hash, documents, largest
id), written in hash buckets and sorted in each, so that joins with a run do not move
it. A new batch is reduced to one row per hash and merge-anti-joined with the runs:
a hash that some run has in ``min_docs`` documents is settled, since later batches hold
smaller ids only; all others are added as a run of the batch's own. ``fan_out`` runs of
one level are merged into one of the next. The sum over the runs left is exact for every
hash that is not settled.

Only DataFrame functions work on documents. A key stands as 128 bits (two 64-bit
hashes), keys are not compared as text: among 10**12 different keys, two agree with a
probability of about 10**-15.

A hash that holds more than 1 / ``HOT`` of a batch's lines is hot. There are at most
``HOT`` of them a batch; they are always added, so no hash that holds such a share of all
lines is missed. Hot hashes are broadcast when lines are looked up, the rest are shuffled.

Defined results: a null or empty text is one empty line. Rows that share an id are one
document: they count once, and if theirs is the largest id, all keep the line. A null id
is one document smaller than all others. An empty table gives an empty table. A text's
lines are handled as one array, so its length is bounded by what one cell may hold only.
Other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.scratch import materialise, scratch_path

BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_CHARS, MIN_DOCS = 20, 3
BATCHES, FAN_OUT = 8, 4
HOT = 20_000
_HASH = ["h1", "h2"]
_ROW = ["r1", "r2"]


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """An array of (h1, h2, pos) of the lines whose key is long enough."""
    lines = F.split(F.translate(text, UPPER, UPPER.lower()), "\n")
    keys = F.transform(lines, lambda line, i: F.struct(F.btrim(line, F.lit(BLANKS)).alias("key"), i.alias("pos")))
    long = F.filter(keys, lambda k: F.char_length(k["key"]) >= min_chars)
    return F.transform(
        long,
        lambda k: F.struct(
            F.xxhash64(k["key"]).alias("h1"), F.xxhash64(F.lit(1), k["key"]).alias("h2"), k["pos"].alias("pos")
        ),
    )


class LineRuns:
    """Levels of runs; each run has one row per hash: ``h1, h2, n, keeper, hot``.

    A run is kept by its path and the name of its bucketed table.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fan_out: int = FAN_OUT) -> None:
        self.spark = spark
        self.min_docs = min_docs
        self.fan_out = fan_out
        self.buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.levels: list[list[tuple[str, str]]] = []
        self.written: list[tuple[str, str]] = []

    def runs(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame, lines: int) -> None:
        """Adds a batch (h1, h2, doc) of so many lines; its documents come before all added so far."""
        hot = F.count("*") * HOT > lines
        own = batch.groupBy(*_HASH).agg(
            F.count_distinct(F.struct("doc")).alias("n"), F.max("doc").alias("keeper"), hot.alias("hot")
        )
        for _, table in self.runs():
            settled = self.spark.table(table).where(F.col("n") >= self.min_docs).select(*[F.col(h).alias(f"_{h}") for h in _HASH])
            same = [F.col(h) == F.col(f"_{h}") for h in _HASH]
            own = own.join(settled.hint("merge"), reduce(Column.__and__, [*same, ~F.col("hot")]), "left_anti")
        self._place(self._write(own), 0)

    def merged(self) -> DataFrame:
        """One row per hash over all runs."""
        return self._merge(self.runs())

    def _place(self, run: tuple[str, str], level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_out:
            merged = self._write(self._merge(self.levels[level]))
            self.levels[level] = []
            self._place(merged, level + 1)

    def _merge(self, runs: list[tuple[str, str]]) -> DataFrame:
        # Read as plain files: a union of bucketed tables is taken for bucketed, which it is not.
        every = self.spark.read.parquet(*[path for path, _ in runs])
        return every.groupBy(*_HASH).agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"), F.max("hot").alias("hot"))

    def _write(self, run: DataFrame) -> tuple[str, str]:
        path, table = scratch_path(self.spark, "line-run"), f"line_run_{uuid4().hex}"
        run.write.format("parquet").option("path", path).bucketBy(self.buckets, *_HASH).sortBy(*_HASH).saveAsTable(table)
        self.written.append((path, table))
        return path, table

    def close(self) -> None:
        """Forgets the tables; the files stay in the shared folder until it is cleared."""
        for _, table in self.written:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def remove_repeated_lines(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_lines``, ``n_dropped``, ``text`` of the lines kept.

    The id must be a number. The texts are read twice: for their keys, and for the result.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"{id_column} must be a number, not {kind.simpleString()}")
    named = docs.select(F.col(id_column).alias("doc"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    named = named.select("*", F.xxhash64("doc", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc").alias("r2"))

    found = named.select("doc", *_ROW, line_keys(F.col("text"), min_chars).alias("lines"))
    found = found.where(F.size("lines") > 0).select("*", _batch(docs, id_column, batches).alias("batch"))
    path = scratch_path(spark, "line-keys")
    schema = found.select("*", F.size("lines").alias("n")).schema
    found.select("*", F.size("lines").alias("n")).write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(schema).parquet(path)

    runs = LineRuns(spark, min_docs, fan_out)
    sizes = {r["batch"]: r["lines"] for r in keys.groupBy("batch").agg(F.sum("n").alias("lines")).collect()}
    for batch in sorted(sizes):
        own = keys.where(F.col("batch") == batch).select("doc", F.explode("lines").alias("line"))
        runs.add(own.select("line.h1", "line.h2", "doc"), sizes[batch])
    if not sizes:
        dropped = keys.select(*_ROW, F.array().cast("array<int>").alias("dropped"))
    else:
        dropped = _dropped(keys, materialise(runs.merged(), "line-runs"), min_docs)
    runs.close()

    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return named.join(dropped, _ROW, "left").select(
        F.col("doc").alias(id_column),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        # Without a dropped line the text is what its lines would be joined to.
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("text"),
    )


def _batch(docs: DataFrame, id_column: str, batches: int) -> Column:
    """The batch of ``doc``, 0 for the largest ids; null ids come last."""
    shares = [i / batches for i in range(1, batches)]
    edges = docs.agg(F.percentile_approx(id_column, shares, 1000)).first()[0] if shares else None
    passed = [F.when(F.col("doc") > F.lit(edge), 0).otherwise(1) for edge in edges or []]
    return F.when(F.col("doc").isNull(), len(passed)).otherwise(reduce(Column.__add__, passed, F.lit(0))).cast("int")


def _dropped(keys: DataFrame, merged: DataFrame, min_docs: int) -> DataFrame:
    """(r1, r2, dropped): the positions of the lines that each text loses."""
    lines = keys.select("doc", *_ROW, F.explode("lines").alias("line")).select("doc", *_ROW, "line.*")
    frequent = F.col("n") >= min_docs
    # At most HOT hashes a batch.
    hot = F.broadcast(merged.where("hot").select(*_HASH, F.when(frequent, F.struct("keeper")).alias("found")))
    cold = merged.where(~F.col("hot") & frequent).select(*_HASH, F.struct("keeper").alias("found"))
    looked_up = lines.join(hot, _HASH).unionByName(lines.join(hot, _HASH, "left_anti").join(cold, _HASH))
    lost = looked_up.where(F.col("found").isNotNull() & ~F.col("doc").eqNullSafe(F.col("found.keeper")))
    return materialise(lost.groupBy(*_ROW).agg(F.collect_set("pos").alias("dropped")), "line-drops")
