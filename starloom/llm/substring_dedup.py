"""Repeated passages across documents, found through a count-min prefilter.

A window is ``size`` consecutive words of one text. Each word of a window whose
words also start earlier (smaller id, or earlier in the same text) is removed.

1. Documents are written once in chunks of bounded size.
2. A window is counted through its anchor, the 8-word run in it with the smallest
   hash: equal windows have equal anchors at equal offsets, so an anchor is seen at
   least as often as any window it stands for. Each chunk makes a count-min sketch of its anchors,
   stored by shards of cells; shards of all chunks are merged, and the cells seen
   twice or more go back to the chunks that touched them. The merged sketch never
   underestimates, so no repeated window is lost.
3. Windows estimated repeated are grouped exactly, by 96 bits of hash (not by their
   words: among 10**12 windows two collide with a probability of about 10**-5). A chunk sends the first of its
   equal windows only, so a passage in very many documents is one row per chunk.
   The group's earliest window stays; chunks are told which of theirs are later.
4. Chunks remove the words covered by later windows.

Texts equal to an earlier one are not searched: all their windows start earlier
in that one. Chunks, shards and groups are bounded, whatever the input; one text is
never cut, so a longer one is a chunk of its own.

Defined results: a null, empty or blank text has no words. A null id counts as the
largest; of rows with equal ids the one read first is the earlier. Repeated rows
each get a result. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.words import WordHashes, Windows, mix, texts
from starloom.scratch import materialise

SIZE = 20
ANCHOR = 8
#: Bytes of text in a chunk; cells of one sketch row in a shard (a power of two).
CHUNK_BYTES = 8 << 20
SHARD_BITS = 24
DEPTH = 2
#: Sketch cells for each expected anchor; windows aimed at in one exact group.
CELLS = 16
GROUP_WINDOWS = 4_000_000
_BLOCK = 1 << 20
_POSITION = np.uint64((1 << 24) - 1)
_SPREAD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_LAST = (1 << 63) - 1


def _chunked(chunk_bytes: int):
    """Adds a chunk number: task and counter, a new one when the texts fill a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            out = []
            for size in pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist():
                if filled and filled + size > chunk_bytes:
                    chunk, filled = chunk + 1, 0
                filled += size
                out.append(chunk)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), *batch.columns], names=["chunk", *batch.schema.names])

    return run


class Anchors:
    """Of every window the position of its anchor, and the hashes at such positions."""

    def __init__(self, size: int = SIZE) -> None:
        self.size = size
        self.grams = Windows(min(ANCHOR, size))
        self.reach = size - self.grams.size + 1

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor hash of each window, hashes of the distinct anchor positions)."""
        grams = self.grams.of(hashes)
        if len(grams) < self.reach:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        each, distinct = [], []
        for start in range(0, len(grams) - self.reach + 1, _BLOCK):
            part = grams[start : start + _BLOCK + self.reach - 1]
            # The position in the low bits: of equal hashes the leftmost is smallest.
            least = (part & ~_POSITION) | np.arange(len(part), dtype=np.uint64)
            width = 1
            while 2 * width <= self.reach:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < self.reach:
                rest = self.reach - width
                least = np.minimum(least[:-rest], least[rest:])
            at = (least & _POSITION).astype(np.int64)
            each.append(part[at])
            distinct.append(part[np.unique(at)])
        return np.concatenate(each), np.concatenate(distinct)


def cells_of(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell numbers of one sketch row of 2**bits cells."""
    return mix(anchors * _SPREAD[row]) >> np.uint64(64 - bits)


def _pack(cells: np.ndarray) -> bytes:
    return np.sort(cells).astype("<u4").tobytes()


def _sketches(bits: int, shard_bits: int, size: int):
    """(shard, chunk, once, twice): cells a chunk's anchors touch, and those touched again."""

    def emit(chunk: int, anchors: list[np.ndarray]) -> pa.RecordBatch:
        own = np.concatenate(anchors)
        out = []
        for row in range(DEPTH):
            cells, counts = np.unique(cells_of(own, row, bits), return_counts=True)
            shards = (cells >> np.uint64(shard_bits)).astype(np.int64)
            edges = np.flatnonzero(np.diff(shards, prepend=-1))
            ends = np.append(edges[1:], len(cells))[: len(edges)]  # none for a chunk of short texts
            for start, end in zip(edges, ends, strict=True):
                low = cells[start:end] & np.uint64((1 << shard_bits) - 1)
                again = low[counts[start:end] > 1]
                out.append((int(shards[start]) * DEPTH + row, chunk, _pack(low), _pack(again)))
        columns = zip(*out, strict=True) if out else ([],) * 4
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "chunk", "once", "twice"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, anchors = WordHashes(), Anchors(size)
        here, held = None, []
        for batch in batches:
            for chunk, text in zip(batch.column(0).to_pylist(), texts(batch, 1), strict=True):
                if chunk != here and held:
                    yield emit(here, held)
                    held = []
                here = chunk
                held.append(anchors.of(hashes.of(text.split()))[1])
        if held:
            yield emit(here, held)

    return run


def _merge(shard_bits: int):
    """Adds up one shard of all chunks; each chunk gets its cells with a count above one."""

    def merge(table: pa.Table) -> pa.Table:
        counts = np.zeros(1 << shard_bits, np.uint8)
        once = [np.frombuffer(x.as_py(), "<u4") for x in table.column("once")]
        for cells, twice in zip(once, table.column("twice"), strict=True):
            counts[cells] = np.minimum(counts[cells] + 1, 2)
            counts[np.frombuffer(twice.as_py(), "<u4")] = 2
        hot = [cells[counts[cells] > 1].tobytes() for cells in once]
        out = pa.table({"chunk": table.column("chunk"), "shard": table.column("shard"), "data": pa.array(hot, pa.binary())})
        return out.filter(pa.array([len(x) > 0 for x in hot]))

    return merge


class _Chunk:
    """Texts of one chunk in document order; words are split one text at a time."""

    def __init__(self, table: pa.Table, copies: set[int], size: int) -> None:
        self.size = size
        order = sorted(zip(table.column("ord").to_pylist(), table.column("rid").to_pylist(), range(table.num_rows), strict=True))
        self.column = table.column("text").cast(pa.binary())
        self.rows = [i for _, _, i in order]
        self.keys = [(o, r) for o, r, _ in order]
        self.lengths = [len(self.words(d)) for d in range(len(self.rows))]
        self.copy = [rid in copies for _, rid in self.keys]
        self.first, self.second = WordHashes(), WordHashes(seed=1)
        self.windows = (Windows(size), Windows(size, base=1))

    def words(self, d: int) -> list[bytes]:
        return (self.column[self.rows[d]].as_py() or b"").split()

    def searched(self) -> list[int]:
        return [d for d, n in enumerate(self.lengths) if n >= self.size and not self.copy[d]]

    def check(self, words: list[bytes]) -> np.ndarray:
        """32 more bits of hash of each window; needed only where the first ones repeat."""
        return self.windows[1].of(self.second.of(words)) >> np.uint64(32)


def _grouped(h: np.ndarray, g: np.ndarray, *later: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the two hashes (then by ``later``, least significant first) and where groups begin.

    Equal keys keep the order they come in.
    """
    order = np.lexsort((*later, g, h))
    h, g = h[order], g[order]
    begins = np.ones(len(order), bool)
    begins[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    return order, begins


def _control(table: pa.Table) -> tuple[set[int], dict[int, list[bytes]]]:
    """Copies (shard -1: row ids) and per shard the data sent to a chunk."""
    copies: set[int] = set()
    data: dict[int, list[bytes]] = {}
    for shard, value in zip(table.column("shard").to_pylist(), table.column("data").to_pylist(), strict=True):
        if shard == -1:
            copies.add(int.from_bytes(value, "big"))
        else:
            data.setdefault(shard, []).append(value)
    return copies, data


def _candidates(bits: int, shard_bits: int, size: int, parts: int):
    """Per exact group the chunk's first windows of those estimated repeated."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        copies, data = _control(right)
        hot = []
        for row in range(DEPTH):
            own = [
                np.frombuffer(value, "<u4").astype(np.uint64) | np.uint64((shard // DEPTH) << shard_bits)
                for shard, values in data.items()
                if shard % DEPTH == row
                for value in values
            ]
            hot.append(np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64))
        out = []
        if left.num_rows and all(map(len, hot)):
            chunk = _Chunk(left, copies, size)
            anchors = Anchors(size)
            found = []
            for d in chunk.searched():
                words = chunk.words(d)
                hashes = chunk.first.of(words)
                each, _ = anchors.of(hashes)
                wanted = np.ones(len(each), bool)
                for row in range(DEPTH):
                    wanted &= _within(cells_of(each, row, bits), hot[row])
                at = np.flatnonzero(wanted)
                if len(at):
                    h = chunk.windows[0].of(hashes)
                    found.append((h[at], chunk.check(words)[at], np.full(len(at), d), at))
            if found:
                h, g, doc, at = (np.concatenate(x) for x in zip(*found, strict=True))
                order, begins = _grouped(h, g)
                own = np.sort(order[begins])
                h, g, doc, at = h[own], g[own], doc[own], at[own]
                part = (h % np.uint64(parts)).astype(np.int64)
                keys = np.array(chunk.keys, np.int64)
                name = left.column("chunk")[0].as_py()
                for p in np.unique(part).tolist():
                    x = part == p
                    out.append((p, name, h[x].astype("<u8").tobytes(), g[x].astype("<u4").tobytes(),
                                keys[doc[x], 0].tobytes(), keys[doc[x], 1].tobytes(), at[x].astype("<i4").tobytes()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 7
        names = ("part", "chunk", "h", "g", "ord", "rid", "at")
        kinds = [pa.int64()] * 2 + [pa.binary()] * 5
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    return run


def _within(values: np.ndarray, members: np.ndarray) -> np.ndarray:
    at = np.searchsorted(members, values)
    at[at == len(members)] = 0
    return members[at] == values if len(members) else np.zeros(len(values), bool)


def _group(table: pa.Table) -> pa.Table:
    """Tells each chunk which of its windows start earlier elsewhere."""
    read = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
    h, g, ord_, rid, at = (read(n, k) for n, k in (("h", "<u8"), ("g", "<u4"), ("ord", "<i8"), ("rid", "<i8"), ("at", "<i4")))
    source = np.repeat(np.arange(len(h)), [len(x) for x in h])
    h, g = np.concatenate(h), np.concatenate(g)
    order, begins = _grouped(h, g, np.concatenate(at), np.concatenate(rid), np.concatenate(ord_))
    later = np.zeros(len(h), bool)
    later[order[~begins]] = True
    chunks = table.column("chunk").to_pylist()
    out = []
    for i in np.unique(source[later]).tolist():
        start, end = np.searchsorted(source, (i, i + 1))
        own = start + np.flatnonzero(later[start:end])
        packed = np.empty(len(own), [("h", "<u8"), ("g", "<u4")])
        packed["h"], packed["g"] = h[own], g[own]
        out.append((chunks[i], packed.tobytes()))
    columns = list(zip(*out, strict=True)) if out else [[], []]
    return pa.table(
        {
            "chunk": pa.array(columns[0], pa.int64()),
            "shard": pa.array([0] * len(out), pa.int64()),
            "data": pa.array(columns[1], pa.binary()),
        }
    )


def _removal(size: int, names: list[str] | None, id_column: str, text_column: str):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        copies, data = _control(right)
        out = {n: [] for n in ("row", "n_words", "n_removed", "kept_sha256", "text")}
        if left.num_rows:
            chunk = _Chunk(left, copies, size)
            sent = np.frombuffer(b"".join(data.get(0, [])), [("h", "<u8"), ("g", "<u4")])
            docs = chunk.searched()
            each = [chunk.windows[0].of(chunk.first.of(chunk.words(d))) for d in docs]
            starts = np.cumsum([0, *map(len, each)])
            later = np.zeros(starts[-1], bool)
            if docs:
                # Windows sent back come first in their group, so all of the chunk's are later.
                h = np.concatenate([sent["h"], *each])
                order = np.argsort(h)
                sorted_ = h[order]
                same = sorted_[1:] == sorted_[:-1]
                again = np.sort(order[np.append(same, False) | np.append(False, same)])
                own = again[again >= len(sent)] - len(sent)
                g = np.zeros(len(h), np.uint64)
                g[: len(sent)] = sent["g"]
                for k in np.unique(np.searchsorted(starts, own, "right") - 1).tolist():
                    g[len(sent) + starts[k] : len(sent) + starts[k + 1]] = chunk.check(chunk.words(docs[k]))
                order, begins = _grouped(h[again], g[again])
                hit = again[order[~begins]]
                later[hit[hit >= len(sent)] - len(sent)] = True
            spans = {d: np.flatnonzero(later[starts[k] : starts[k + 1]]) for k, d in enumerate(docs)}
            for d in range(len(chunk.rows)):
                words = chunk.words(d)
                gone = np.zeros(len(words) + 1, np.int32)
                if chunk.copy[d] and len(words) >= size:
                    gone[0] = 1
                elif len(at := spans.get(d, ())):
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + size, -1)
                lost = np.cumsum(gone[:-1]) > 0
                n = int(lost.sum())
                kept = b" ".join([w for w, x in zip(words, lost.tolist(), strict=True) if not x] if n else words)
                out["row"].append(chunk.rows[d])
                out["n_words"].append(len(words))
                out["n_removed"].append(n)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if names is not None:
                    # An untouched text keeps its white space.
                    out["text"].append(kept.decode() if n else left.column("text")[chunk.rows[d]].as_py())
        rest = left.column("rest").take(pa.array(out["row"], pa.int64())).combine_chunks()
        if names is None:
            return pa.table(
                {
                    id_column: rest.field(0),
                    "n_words": pa.array(out["n_words"], pa.int64()),
                    "n_removed": pa.array(out["n_removed"], pa.int64()),
                    "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
                }
            )
        columns = {name: rest.field(i) for i, name in enumerate(n for n in names if n != text_column)}
        return pa.table({n: pa.array(out["text"], pa.string()) if n == text_column else columns[n] for n in names})

    return run


def remove_repeats(
    docs: DataFrame,
    *,
    size: int = SIZE,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
    shard_bits: int = SHARD_BITS,
    group_windows: int = GROUP_WINDOWS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256.

    The id must be an integer column. With ``rows`` the result is the rows of ``docs``
    themselves with what is kept of their texts, words joined by one space; a text
    that loses nothing is returned as it was, and one that loses all is empty.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_column].dataType.simpleString()
    named = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)).alias("ord"),
        F.struct(*([c for c in docs.columns if c != text_column] if rows else [id_column])).alias("rest"),
        F.col(text_column).alias("text"),
    )
    schema = T.StructType([T.StructField("chunk", T.LongType()), *named.schema.fields])
    table = materialise(named.mapInArrow(_chunked(chunk_bytes), schema), "substring-chunks")

    keys = table.select("chunk", "rid", "ord", F.md5(F.col("text").cast("binary")).alias("same")).where(F.length("text") > 0)
    first = keys.groupBy("same").agg(F.min(F.struct("ord", "rid")).alias("first"), F.count("*").alias("n"))
    copies = keys.join(first.where(F.col("n") > 1), "same").where(F.struct("ord", "rid") != F.col("first"))
    rid = F.unhex(F.lpad(F.hex("rid"), 16, "0"))
    copies = copies.select("chunk", F.lit(-1).cast("long").alias("shard"), rid.alias("data"))

    total = table.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    words = total // 4 + 1  # about; sets sizes, not results
    bits = max(shard_bits, int(CELLS * words // 6).bit_length())
    parts = max(1, -(-words // group_windows))
    sketch = table.select("chunk", "text").mapInArrow(
        _sketches(bits, shard_bits, size), "shard long, chunk long, once binary, twice binary"
    )
    answer = "chunk long, shard long, data binary"
    hot = sketch.groupBy("shard").applyInArrow(_merge(shard_bits), answer)

    found = table.groupBy("chunk").cogroup(hot.unionByName(copies).groupBy("chunk")).applyInArrow(
        _candidates(bits, shard_bits, size, parts),
        "part long, chunk long, h binary, g binary, ord binary, rid binary, at binary",
    )
    # Not written: in one plan both passes over the chunks share one shuffle of the texts.
    later = found.groupBy("part").applyInArrow(_group, answer)
    names = docs.columns if rows else None
    columns = docs.schema if rows else f"{id_column} {id_type}, n_words long, n_removed long, kept_sha256 string"
    return table.groupBy("chunk").cogroup(later.unionByName(copies).groupBy("chunk")).applyInArrow(
        _removal(size, names, id_column, text_column), columns
    )
