"""WARC archives: writing, reading, and a capture index by external merge.

Writing: one WARC/1.1 record per row in gzip files, through Spark's own text
writer (a record ends with two CRLF, which is the line separator). Of rows with
equal payloads the one with the largest id becomes a ``response``; the others
become ``revisit`` records without the payload. Payloads below ``min_bytes`` are
always written.

Reading: the files are read as a stream of pieces between CRLF CRLF; a parser
glues them by each record's Content-Length, holding one record at a time, and
checks the digest of every payload.

Index: every reading task sorts its captures by (URL key, timestamp, id) and
stores them as sorted runs of bounded size. Spark's range partitioner deals the runs to
ranges, and each range merges its slices of the runs with a loser tree (ids as text). Rows
ordered by (range, position) are in global order: all captures of a URL key in sequence.

Defined results: a null payload is empty; a null URL is written as an empty one and has an
empty key; CR and LF in a URL are percent-encoded; a null id makes a response
that nothing refers to; equal rows with the largest id are all responses. An
empty table makes an empty archive. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.url_filters import host_key, host_of
from starloom.scratch import materialise

BREAK = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Captures in one sorted run, and aimed at in one merged range.
RUN_ROWS = 50_000
RANGE_ROWS = 100_000
ORDER = ("url_key", "captured", "record_id")
CAPTURE = (
    "record_id string, url string, captured string, record_type string, refers_to string, "
    "payload_bytes long, payload_digest string, url_key string, file string, offset long, length long"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: 10 hexadecimal digits are 8 base-32 digits."""
    code = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(code, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    captured: Column,
    min_bytes: int = 0,
) -> None:
    """Writes a record per row below ``path``; ``captured`` is a timestamp column.

    Which rows are revisits is decided on digests and ids alone; payloads move
    once, dealt by id and digest, so copies of one payload are spread.
    """
    payload = F.coalesce(F.col(payload_column), F.lit(""))
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(url_column), F.lit("")).alias("url"),
        F.coalesce(captured, F.lit("1970-01-01").cast("timestamp")).alias("captured"),
        payload.alias("payload"),
        base32_sha1(payload).alias("digest"),
        F.octet_length(payload).alias("bytes"),
    )
    keys = rows.select("id", "digest").where((F.col("bytes") >= min_bytes) & F.col("id").isNotNull())
    groups = keys.groupBy("digest").agg(F.max("id").alias("response"), F.min("id").alias("first"))
    groups = groups.where(F.col("first") < F.col("response")).drop("first")
    revisits = keys.distinct().join(groups, "digest").where(F.col("id") < F.col("response"))
    decided = rows.join(revisits, ["id", "digest"], "left")
    decided.select(_record().alias("record")).write.option("lineSep", BREAK).option("compression", "gzip").text(path)


def _record() -> Column:
    revisit = F.col("response").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    uri = lambda c: F.concat(F.lit("<urn:capture:"), c.cast("string"), F.lit(">"))
    block = F.lit(len(HTTP_HEAD)) + F.when(revisit, 0).otherwise(F.col("bytes"))
    lines = [
        F.lit("WARC/1.1"),
        F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(uri(F.col("id")), F.lit("<urn:capture:>"))),
        F.concat(F.lit("WARC-Date: "), F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), uri(F.col("response")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    body = F.concat(F.lit(HTTP_HEAD), F.when(revisit, "").otherwise(F.col("payload")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(BREAK), body)


def read_archive(spark: SparkSession, path: str, *, payloads: bool = False) -> DataFrame:
    """One row per record, with ``payload`` (binary, null for revisits) if asked for.

    Raises if a record is cut off or a payload does not match its digest.
    """
    line_end = BREAK.encode()
    pieces = spark.read.option("lineSep", BREAK).text(path).select("_metadata.file_name", "value")
    columns = CAPTURE.replace("url_key string, ", "") + (", payload binary" if payloads else "")
    names = [part.split()[0] for part in columns.split(", ")]

    def ended(rest: bytearray, file: str | None, at: int) -> None:
        """Checks and clears what is left of a file after its last record, which ended at ``at``.

        After a payload that ends in CRLF, Spark splits the last three CRLF into a break
        and a piece of one CRLF, so the break that is added to that piece is left over.
        """
        if rest and not (at and rest == line_end):
            raise ValueError(f"{file} ends inside a record")
        rest.clear()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, here, at = bytearray(), None, 0
        for batch in batches:
            rows = []
            values = batch.column(1).cast(pa.binary())
            for file, value in zip(batch.column(0).to_pylist(), values, strict=True):
                if file != here:
                    ended(rest, here, at)
                    here, at = file, 0
                rest += value.as_py() + line_end
                # A break alone may be the file's end; before further pieces it is damage.
                while rest != line_end and (found := _take(rest)) is not None:
                    row, size = found
                    rows.append(row | {"file": here, "offset": at, "length": size})
                    at += size
                    del rest[:size]
            out = {name: [row[name] for row in rows] for name in names}
            kinds = {"payload_bytes": pa.int64(), "offset": pa.int64(), "length": pa.int64(), "payload": pa.binary()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()})
        ended(rest, here, at)

    return pieces.mapInArrow(parse, columns)


def _take(data: bytearray) -> tuple[dict, int] | None:
    """The first record and its size, once it is there in full."""
    head = data.find(BREAK.encode())
    if head < 0:
        return None
    lines = bytes(data[:head]).decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    start, size = head + len(BREAK), int(fields["Content-Length"])
    end = start + size + len(BREAK)
    if len(data) < end:
        return None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if fields["WARC-Type"] == "response":
        payload = bytes(data[data.index(BREAK.encode(), start) + len(BREAK) : start + size])
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    bare = lambda v: v and v.removeprefix("<urn:capture:").removesuffix(">")
    row = {
        "record_id": bare(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "captured": fields["WARC-Date"],
        "record_type": fields["WARC-Type"],
        "refers_to": bare(fields.get("WARC-Refers-To")),
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "payload": payload,
    }
    return row, end


class LoserTree:
    """Merges sorted lists; each step replays one path of k runs' losers."""

    def __init__(self, runs: list[list]) -> None:
        self.runs = runs
        self.at = [0] * len(runs)
        self.loser = [-1] * max(1, len(runs))
        for run in range(len(runs)):
            self._replay(run, building=True)

    def _before(self, a: int, b: int) -> bool:
        """Run ``a`` comes before ``b``; exhausted runs come last, ties by number."""
        if self.at[a] >= len(self.runs[a]):
            return False
        if self.at[b] >= len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return (x, a) < (y, b)

    def _replay(self, winner: int, building: bool = False) -> None:
        node = (winner + len(self.runs)) // 2
        while node > 0:
            if building and self.loser[node] < 0:
                self.loser[node] = winner
                return
            if self._before(self.loser[node], winner):
                self.loser[node], winner = winner, self.loser[node]
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, position) of every element in order."""
        while self.runs and self.at[run := self.loser[0]] < len(self.runs[run]):
            yield run, self.at[run]
            self.at[run] += 1
            self._replay(run)


def index_captures(captures: DataFrame, *, run_rows: int = RUN_ROWS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures in global order of URL key, timestamp and id, as (range, position)."""
    path = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*(.*)$", 1)
    keyed = captures.withColumn("url_key", F.concat(host_key(host_of(F.col("url"))), F.lit(" "), path))
    columns = keyed.select(*[part.split()[0] for part in CAPTURE.split(", ")])
    runs = materialise(columns.mapInArrow(_sorted_runs(run_rows), f"run string, {CAPTURE}"), "capture-runs")
    ranges = max(1, -(-runs.count() // range_rows))
    dealt = runs.repartitionByRange(ranges, *ORDER).sortWithinPartitions("run", *ORDER)
    return dealt.mapInArrow(_merge, f"range int, position long, {CAPTURE}")


def _order(batch: pa.RecordBatch | pa.Table) -> list[tuple]:
    return list(zip(*(batch.column(n).to_pylist() for n in ORDER), strict=True))


def _sorted_runs(run_rows: int):
    """Buffers up to ``run_rows`` captures, sorts them and names the run by its first record."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        order = _order(table)
        table = table.take(pa.array(sorted(range(len(order)), key=order.__getitem__), pa.int64()))
        name = f"{held[0].column('file')[0]}:{held[0].column('offset')[0]}"
        run = pa.array([name] * table.num_rows, pa.string())
        arrays = [run, *(column.combine_chunks() for column in table.columns)]
        return pa.RecordBatch.from_arrays(arrays, names=["run", *table.column_names])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, run_rows):
                part = batch.slice(start, run_rows)
                if held and rows + part.num_rows > run_rows:
                    yield flush(held)
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            yield flush(held)

    return sort


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the slices of runs that one range holds, which arrive run by run, each in order."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    names = table.column("run").to_pylist()
    table = table.drop_columns("run").combine_chunks()
    keys, slices, starts = _order(table), [], []
    for _, members in groupby(range(len(names)), key=names.__getitem__):
        first, *rest = members
        starts.append(first)
        slices.append(keys[first : first + len(rest) + 1])
    order = [starts[run] + i for run, i in LoserTree(slices)]
    table = table.take(pa.array(order, pa.int64())).combine_chunks()
    at = TaskContext.get().partitionId()
    place = [pa.array([at] * len(order), pa.int32()), pa.array(range(len(order)), pa.int64())]
    arrays = [column.combine_chunks() for column in table.columns]
    yield pa.RecordBatch.from_arrays([*place, *arrays], names=["range", "position", *table.column_names])
