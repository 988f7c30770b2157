"""URL rules by a sort-merge range join.

A rule (host, path, verdict) fits the URLs of its host and of all subdomains
whose path starts with the rule's path; of several that fit, the longest
``host + path`` wins, then the longer host. The canonical key of a host is its
labels in reverse, each ended by ``/`` (``a.example.net`` -> ``net/example/a/``),
so that the hosts a rule covers are one interval of sorted keys and intervals
nest. URLs are dealt to key ranges; a rule is copied to each range its interval
touches. Each range is sorted, and one sweep keeps the stack of open intervals.

Defined results: a null URL, or one without ``://``, has an empty host and path;
a URL without a rule gets ``default``. An empty rule host covers every host. Equal rules
keep the smallest verdict text. Repeated URLs each get their row; empty tables
give empty results. Only the identifier and the URL are read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Sampled keys per range, about, that place the ranges' bounds; they decide balance only.
BOUND_SAMPLES = 32
#: Ranges at most, so that the sample stays bounded whatever the tables and settings.
MOST_RANGES = 4096
_LAST = (1 << 63) - 1
_COLUMNS = (
    "range int, key string, kind int, salt long, id {id}, host string, path string, "
    "rule string, verdict string"
)


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) text after the first ``://`` up to ``/``, ``?`` or ``#``."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """The text after the host up to ``?`` or ``#``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_key(host: Column) -> Column:
    """Labels in reverse, each ended by ``/``; no host can hold that character."""
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host == "", "").otherwise(F.concat(F.array_join(labels, "/"), F.lit("/")))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
    ranges: int | None = None,
) -> DataFrame:
    """One row per page: id, host, path, the winning rule's text (or null), verdict.

    ``rules`` has host, path and verdict. A hot host is cut into several ranges
    by a hash of the identifier, so no task holds more than its share.
    """
    spark = pages.sparkSession
    ranges = min(MOST_RANGES, ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    id_type = pages.schema[id_column].dataType.simpleString()
    url = F.col(url_column)
    keyed = pages.select(F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    keyed = keyed.select(
        F.lit(0).alias("range"),
        host_key(F.col("host")).alias("key"),
        F.lit(1).alias("kind"),
        F.xxhash64("id").alias("salt"),
        "id",
        "host",
        "path",
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"),
    )
    share = min(1.0, BOUND_SAMPLES * ranges / max(1, pages.count()))
    spread = keyed.select("key", "salt").sample(share, seed=1).collect() if ranges > 1 else []
    keys = sorted((row.key, row.salt) for row in spread)
    bounds = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []

    rule_host = F.translate(F.coalesce("host", F.lit("")), UPPER, UPPER.lower())
    rule_path = F.coalesce("path", F.lit(""))
    ruled = rules.groupBy(rule_host.alias("host"), rule_path.alias("path")).agg(F.min("verdict").alias("verdict"))
    ruled = ruled.select(
        F.lit(0).alias("range"),
        host_key(F.col("host")).alias("key"),
        F.lit(0).alias("kind"),
        F.lit(0).cast("long").alias("salt"),
        F.lit(None).cast(id_type).alias("id"),
        "host",
        "path",
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    schema = _COLUMNS.format(id=id_type)
    dealt = keyed.mapInArrow(_ranges(bounds), schema).unionByName(ruled.mapInArrow(_copies(bounds), schema))
    ordered = dealt.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions("range", "key", "kind")
    return ordered.mapInArrow(
        _sweep(default), f"{id_column} {id_type}, host string, path string, rule string, verdict string"
    )


def _ranges(bounds: list[tuple[str, int]]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("key").to_pylist(), batch.column("salt").to_pylist(), strict=True)
            at = pa.array([bisect_right(bounds, pair) for pair in pairs], pa.int32())
            yield pa.RecordBatch.from_arrays([at, *batch.columns[1:]], schema=batch.schema)

    return place


def _copies(bounds: list[tuple[str, int]]):
    """Each rule once for each range from its interval's first key to its last."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, at = [], []
            for i, key in enumerate(batch.column("key").to_pylist()):
                first = bisect_left(bounds, (key, -_LAST - 1))
                last = bisect_right(bounds, (key + chr(0x10FFFF), _LAST)) if key else len(bounds)
                take += [i] * (last - first + 1)
                at += range(first, last + 1)
            rows = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *rows.columns[1:]], schema=batch.schema)

    return copy


def _sweep(default: str):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, stack = None, []
        for batch in batches:
            out = {name: [] for name in ("id", "host", "path", "rule", "verdict")}
            rows = zip(*(batch.column(n).to_pylist() for n in ("range", "key", "kind", *out)), strict=True)
            for at, key, kind, row_id, host, path, rule, verdict in rows:
                if at != here:
                    here, stack = at, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, len(host), {}, set()))
                    stack[-1][2][path] = (rule, verdict)
                    stack[-1][3].add(len(path))
                    continue
                best = None
                for _, host_size, paths, sizes in stack:
                    for size in sizes:
                        if size <= len(path) and path[:size] in paths:
                            rank = (host_size + size, host_size)
                            if best is None or rank > best[0]:
                                best = (rank, *paths[path[:size]])
                out["id"].append(row_id)
                out["host"].append(host)
                out["path"].append(path)
                out["rule"].append(best and best[1])
                out["verdict"].append(best[2] if best else default)
            kinds = [batch.schema.field("id").type] + [pa.string()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)],
                names=[f"c{i}" for i in range(5)],
            )

    return sweep
