"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents become token ids plus an end id; only documents longer than a sequence
are cut. Full pieces are sequences of their own. The other pieces are dealt by a
hash to pools of about ``POOL`` pieces, and every pool is one bin-packing problem
solved by several islands, each a task with a population of its own:

* an individual is a set of bins; the start is best fit in decreasing order, the
  rest best fit in disturbed orders;
* crossover injects whole well-filled bins of one parent into the other, removes
  the bins that hold duplicates, and best-fits the displaced pieces;
* mutation dissolves the least-filled bins and best-fits their pieces;
* after an epoch the best individuals of an island move to the next island.

At last the least-filled bins of neighbouring pools are solved together once more,
starting from what they had, so that no pool keeps a half-empty tail.

Defined results: a null, empty or blank text is one piece that holds the end id
alone. Repeated rows are packed separately. An empty table gives an empty table.
Seeds come from pool, island and epoch, so a lost task is redone the same way.
"""

from __future__ import annotations

import os
import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import texts
from starloom.scratch import materialise

#: Pieces in a pool; islands of a pool; epochs and generations in each.
POOL = 3000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 10
POPULATION = 4
ELITES = 1
#: Pools whose least-filled bins, so many of each, are solved together at last.
NEIGHBOURS = 24
TAIL_BINS = 12
#: Words whose ids a Python worker remembers during a task, and after it: the worker may idle
#: beside others, its memory counts all the same.
_REMEMBERED, _KEPT = 800_000, 400_000
#: Words encoded in one text, and the word that stands after each of them there.
_JOINED = 256
_MARK = b"~"


def _encoder(text: str):
    """The tokenizer of this worker process and its memory of words.

    Both outlive a task: they are kept with the library, as task code is not.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    held = vars(tokenizers).setdefault("_starloom_held", {})
    key = zlib.crc32(text.encode())
    if key not in held:
        held.clear()
        held[key] = (tokenizers.Tokenizer.from_str(text), {})
    return held[key]


def _forget(memory: dict[bytes, bytes]) -> None:
    """Leaves the words met first: frequent words come early."""
    if len(memory) > _KEPT:
        first = dict(islice(memory.items(), _KEPT))
        memory.clear()
        memory.update(first)


def _encoded(encoder, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Each word with its ids.

    Words are joined with a mark after each that no word holds and that is one id of its
    own; words that hold it, and texts whose marks do not tell the words apart, go one by one.
    """
    mark = encoder.encode(_MARK.decode(), add_special_tokens=False).ids
    plain = [w for w in words if _MARK not in w] if len(mark) == 1 else []
    alone = [w for w in words if _MARK in w] if len(mark) == 1 else words
    runs = [plain[k : k + _JOINED] for k in range(0, len(plain), _JOINED)]
    joined = [b"".join([w + b" " + _MARK + b" " for w in run]).decode() for run in runs]
    for run, encoding in zip(runs, encoder.encode_batch_fast(joined, add_special_tokens=False), strict=True):
        ids = np.array(encoding.ids, "<u4")
        ends = np.flatnonzero(ids == mark[0])
        if len(ends) != len(run):
            alone = alone + run
            continue
        data = ids.tobytes()
        starts = np.concatenate([[0], 4 * ends[:-1] + 4])
        for word, start, end in zip(run, starts.tolist(), (4 * ends).tolist(), strict=True):
            yield word, data[start:end]
    found = encoder.encode_batch_fast([w.decode() for w in alone], add_special_tokens=False)
    for word, encoding in zip(alone, found, strict=True):
        yield word, np.array(encoding.ids, "<u4").tobytes()


def tokenize(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 4096,
    end_id: int = 1,
    ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces: id, piece, start, length, ids_crc32 (and the ids, if asked for).

    ``tokenizer`` is the JSON text of a tokenizer whose tokens never hold ASCII
    white space, so words are encoded one by one and remembered.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    given = docs.sparkSession.sparkContext.broadcast(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    names = [id_column, "piece", "start", "length", "ids_crc32"] + ["ids"] * ids

    def pieces(batches: Iterator[pa.RecordBatch], encoder, memory: dict) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                split = [text.split() for text in texts(part, 1)]
                distinct = set().union(*split)
                new = [word for word in distinct if word not in memory]
                if len(memory) + len(new) > _REMEMBERED:
                    _forget(memory)
                    new = [word for word in distinct if word not in memory]
                memory.update(_encoded(encoder, new))
                take, rows = [], []
                for i, words in enumerate(split):
                    data = b"".join(map(memory.__getitem__, words)) + end
                    for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                        own = data[at : at + 4 * capacity]
                        take.append(i)
                        rows.append((piece, at // 4, len(own) // 4, zlib.crc32(own), own))
                piece, start, length, crc, own = zip(*rows, strict=True) if rows else [()] * 5
                columns = [
                    part.column(0).take(pa.array(take, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in own], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, memory = _encoder(given.value)
        try:
            yield from pieces(batches, encoder, memory)
        finally:
            _forget(memory)

    schema = f"{id_column} {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return docs.select(id_column, text_column).mapInArrow(encode, schema)


def pack(pieces: DataFrame, *, capacity: int = 4096, pool: int = POOL, islands: int = ISLANDS) -> DataFrame:
    """``pieces`` (with a ``length`` of at most ``capacity``) with sequence_id and offset.

    Input columns of these two names, or ``packing_row``, are replaced.
    """
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset", "packing_row")]
    written = materialise(
        pieces.select(*kept).withColumn("packing_row", F.monotonically_increasing_id()), "packing-pieces"
    )
    alone = written.where(F.col("length") >= capacity)
    rest = written.where(F.col("length") < capacity).select("packing_row", "length")
    pools = max(1, -(-rest.count() // pool))
    own = F.pmod(F.xxhash64("packing_row"), F.lit(pools))
    problems = rest.groupBy(own.alias("pool")).agg(F.collect_list(F.struct("packing_row", "length")).alias("items"))
    solved = materialise(_evolve(problems, capacity, islands), "packing-pools")

    bins = solved.select("pool", F.posexplode("bins").alias("bin", "items"))
    bins = bins.withColumn("free", capacity - F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["length"]))
    tail = (F.size("items") > 0) & (F.col("free") > 0) & (F.col("bin") < TAIL_BINS)
    together = bins.where(tail).groupBy(F.floor(F.col("pool") / NEIGHBOURS).alias("pool"))
    again = _evolve(together.agg(F.collect_list("items").alias("start")), capacity, islands, restart=True)
    final = again.select((-1 - F.col("pool")).alias("pool"), F.posexplode("bins").alias("bin", "items"))
    placed = bins.where(~tail).select("pool", "bin", "items").unionByName(final)
    placed = placed.select(
        (F.col("pool") * F.lit(1 << 20) + F.col("bin")).cast("long").alias("sequence_id"), "items"
    ).where(F.size("items") > 0)
    places = placed.mapInArrow(_offsets, "packing_row long, sequence_id long, offset long")
    # Full pieces take odd numbers, packed ones even numbers.
    single = alone.select(*kept, (2 * F.col("packing_row") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    shared = written.join(places, "packing_row").select(*kept, (2 * F.col("sequence_id")).alias("sequence_id"), "offset")
    return single.unionByName(shared)


_ITEMS = "array<array<struct<packing_row:bigint,length:bigint>>>"


def _evolve(problems: DataFrame, capacity: int, islands: int, *, restart: bool = False) -> DataFrame:
    """(pool, bins): the best individual of all islands, its least-filled bins first."""
    source = problems if restart else problems.withColumn("start", F.array("items"))
    source = materialise(source.select(F.col("pool").cast("long").alias("pool"), "start"), "packing-problems")
    ring = source.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    state = ring.withColumn("elites", F.lit(None).cast("array<binary>"))
    tasks = max(1, int(problems.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    best = None
    for epoch in range(EPOCHS):
        dealt = state.select("pool", "island", "start", "elites").repartition(tasks, "pool", "island")
        best = materialise(
            dealt.mapInArrow(_island(capacity, epoch, restart), "pool long, island int, worth double, elites array<binary>"),
            "packing-elites",
        )
        moved = best.select("pool", ((F.col("island") + 1) % islands).cast("int").alias("island"), "elites")
        state = ring.join(moved.unionByName(best.select("pool", "island", "elites"))
                          .groupBy("pool", "island").agg(F.flatten(F.collect_list("elites")).alias("elites")),
                          ["pool", "island"])
    winner = best.groupBy("pool").agg(F.max_by("elites", F.struct("worth", -F.col("island"))).alias("elites"))
    return source.join(winner, "pool").mapInArrow(_bins(capacity), f"pool long, bins {_ITEMS}")


def _items(start: list[list[dict]]) -> list[tuple[int, int]]:
    """(length, row) of a problem, longest first."""
    return sorted(((x["length"], x["packing_row"]) for group in start for x in group), key=lambda x: (-x[0], x[1]))


class Packing:
    """One problem: lengths in decreasing order and the operators on individuals."""

    def __init__(self, lengths: list[int], capacity: int, seed: int) -> None:
        self.lengths = lengths
        self.capacity = capacity
        self.random = random.Random(seed)

    def fit(self, bins: list[list[int]], items: list[int]) -> list[list[int]]:
        """Puts each item, in the given order, into the open bin it fills best."""
        lengths, capacity = self.lengths, self.capacity
        spaces = sorted((capacity - sum([lengths[i] for i in b]), k) for k, b in enumerate(bins))
        for item in items:
            size = lengths[item]
            at = bisect_left(spaces, (size, -1))
            if at == len(spaces):
                bins.append([item])
                left, k = capacity - size, len(bins) - 1
            else:
                left, k = spaces.pop(at)
                bins[k].append(item)
                left -= size
            if left:
                insort(spaces, (left, k))
        return bins

    def disturbed(self) -> list[list[int]]:
        noise = self.random.uniform
        return self.fit([], sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i] * noise(0.9, 1.1)))

    def fill(self, bin_: list[int]) -> int:
        lengths = self.lengths
        return sum([lengths[i] for i in bin_])

    def worth(self, bins: list[list[int]]) -> float:
        """Fewer bins first; then fuller ones, by the mean square of their fill."""
        square = sum([(self.fill(b) / self.capacity) ** 2 for b in bins])
        return -len(bins) + square / max(1, len(bins))

    def crossover(self, first: list[list[int]], second: list[list[int]]) -> list[list[int]]:
        """Whole well-filled bins of ``second`` enter; duplicates' bins leave; the rest is best-fitted."""
        ranked = sorted(range(len(second)), key=lambda k: (-self.fill(second[k]), k))[: max(1, len(second) // 2)]
        chosen = self.random.sample(ranked, max(1, len(ranked) // 4))
        injected = [list(second[k]) for k in chosen]
        inside = {i for b in injected for i in b}
        bins, displaced = injected, []
        for b in first:
            if inside.isdisjoint(b):
                bins.append(list(b))
            else:
                displaced += [i for i in b if i not in inside]
        return self.fit(bins, sorted(displaced))

    def mutate(self, bins: list[list[int]]) -> list[list[int]]:
        """Dissolves the least-filled bins and a few others."""
        order = sorted(range(len(bins)), key=lambda k: (self.fill(bins[k]), k))
        gone = set(order[:3]) | set(self.random.sample(order, min(len(order), 1 + len(order) // 50)))
        displaced = [i for k in gone for i in bins[k]]
        return self.fit([list(b) for k, b in enumerate(bins) if k not in gone], sorted(displaced))

    def evolve(self, given: list[list[list[int]]], generations: int = GENERATIONS) -> list[list[list[int]]]:
        """The population after some generations, the best first."""
        lower = -(-sum(self.lengths) // self.capacity)
        herd = [*given, self.fit([], list(range(len(self.lengths))))]
        while len(herd) < POPULATION:
            herd.append(self.disturbed())
        herd.sort(key=self.worth, reverse=True)
        for _ in range(generations):
            if len(herd[0]) <= lower:
                break
            first, second = self.random.sample(herd, 2)
            herd += [self.mutate(self.crossover(first, second)), self.mutate(herd[0])]
            herd = sorted(herd, key=self.worth, reverse=True)[:POPULATION]
        return herd


def _coded(bins: list[list[int]], size: int) -> bytes:
    of = np.zeros(size, "<i4")
    for k, b in enumerate(bins):
        of[b] = k
    return of.tobytes()


def _decoded(data: bytes) -> list[list[int]]:
    of = np.frombuffer(data, "<i4")
    bins: list[list[int]] = [[] for _ in range(int(of.max()) + 1 if len(of) else 0)]
    for i, k in enumerate(of.tolist()):
        bins[k].append(i)
    return [b for b in bins if b]


def _island(capacity: int, epoch: int, restart: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pool, island, start, elites = (batch.column(k)[i].as_py() for k in range(4))
                items = _items(start)
                problem = Packing([size for size, _ in items], capacity, hash((pool, island, epoch)))
                given = [_decoded(data) for data in elites or ()]
                if restart and not given:
                    place = {row: k for k, (_, row) in enumerate(items)}
                    given = [[[place[x["packing_row"]] for x in group] for group in start if group]]
                herd = problem.evolve(given)
                best = [_coded(bins, len(items)) for bins in herd[:ELITES]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "pool": pa.array([pool], pa.int64()),
                        "island": pa.array([island], pa.int32()),
                        "worth": pa.array([problem.worth(herd[0])], pa.float64()),
                        "elites": pa.array([best], pa.list_(pa.binary())),
                    }
                )

    return run


def _bins(capacity: int):
    del capacity
    item = pa.struct([("packing_row", pa.int64()), ("length", pa.int64())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pool, start, elites = (batch.column(k)[i].as_py() for k in range(3))
                items = _items(start)
                bins = _decoded(elites[0])
                bins.sort(key=lambda b: sum(items[k][0] for k in b))
                named = [[{"packing_row": items[k][1], "length": items[k][0]} for k in b] for b in bins]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pool], pa.int64()), pa.array([named], pa.list_(pa.list_(item)))],
                    names=["pool", "bins"],
                )

    return decode


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for sequence, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            at = 0
            for x in items:
                out.append((x["packing_row"], sequence, at))
                at += x["length"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in out], pa.int64()) for k in range(3)],
            names=["packing_row", "sequence_id", "offset"],
        )
