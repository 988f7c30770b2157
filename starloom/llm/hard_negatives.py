"""Hard negatives by exact integer products of packed vectors.

A component ``x`` becomes ``floor(256 * x)``. A score is the inner product of two such
vectors. An anchor's positives are the ``positives`` best other rows of its label; the
hard negatives of a pair are the first ``negatives`` rows of other labels whose score is
at most the positive's and at least ``share`` hundredths of it. Higher scores come
first, ties by the smaller id.

Products are Kronecker-packed: components are biased to be at least 0, those of
several candidates are put into separated fields of one wide number, and one
multiplication by an anchor's component serves them all. A field is as wide as the
largest sum it can get, so fields never carry into each other, and the exact scores are
cut out of the sum and freed of the bias. The wide number is a double where the fields
fit its 53 bits (a double holds such integers exactly, and the products are one matrix
product), else 64 bits, else a whole number of any length.

The anchors are a stated query set, met with all rows in blocks: up to ``BLOCK`` anchors
are sent to every task at a time, and every task goes through its rows once for the
positives and once for the negatives. A task gives the best few rows per anchor (and
positive), which a window then merges.

Defined results: rows with a null id, label or vector, or with a component that is null,
NaN or infinite take no part. Rows that share an id count once, with the least label and
then the least vector. A shorter vector is filled up with zeros. A negative positive
score has no hard negatives. A score beyond 64 bits counts as the nearest long. Without rows, anchors, positives or negatives the result is empty.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.scratch import materialise, scratch_path

#: Anchors sent to the tasks at a time, and the rows and anchors of one matrix product.
BLOCK, ROWS, ANCHORS = 16_384, 4_096, 256
POSITIVES, NEGATIVES, SHARE = 5, 5, 80
SCALE = 256
_FOUND = "anchor_id long, slot int, score long, id long"
_LONG = 2**63 - 1


class Packing:
    """How vectors of ``width`` whole components up to ``limit`` are packed and multiplied."""

    def __init__(self, width: int, limit: int) -> None:
        self.width, self.limit = width, limit
        self.bits = max(1, (width * (2 * limit) ** 2).bit_length())
        if 2 * self.bits <= 53:
            self.kind, self.fields = np.float64, 53 // self.bits
        elif 2 * self.bits <= 64:
            self.kind, self.fields = np.uint64, 2
        else:
            self.kind, self.fields = object, 4

    def biased(self, vectors: np.ndarray) -> np.ndarray:
        """Components (whole doubles) plus the limit, as the numbers that are multiplied."""
        if self.kind is object:
            return np.array([[int(x) + self.limit for x in v] for v in vectors], object).reshape(vectors.shape)
        return (vectors + self.limit).astype(self.kind)

    def pack(self, biased: np.ndarray) -> np.ndarray:
        """One row of wide numbers for every ``fields`` rows."""
        rows = -(-len(biased) // self.fields)
        wide = biased[:rows].copy()
        for f in range(1, self.fields):
            part = biased[f * rows : (f + 1) * rows]
            wide[: len(part)] += part * self._number(1 << (self.bits * f))
        return wide

    def scores(self, anchors: np.ndarray, wide: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The exact scores of biased anchors (rows) and packed candidates (columns) of these biased sums."""
        product = anchors @ wide.T
        if self.kind is np.float64:
            product = product.astype(np.uint64)
        mask = self._number((1 << self.bits) - 1, whole=True)
        shifts = [self._number(self.bits * f, whole=True) for f in range(self.fields)]
        fields = np.concatenate([(product >> s) & mask for s in shifts], axis=1)[:, : len(sums)]
        if self.kind is not object:
            fields = fields.astype(np.int64)
        # sum((a + L) * (c + L)) = sum(a * c) + L * (sum(a + L) + sum(c + L)) - width * L * L
        own = self.sums(anchors)
        exact = fields - self.limit * (own[:, None] + sums[None, :]) + self.width * self.limit**2
        return np.clip(exact, -_LONG - 1, _LONG).astype(np.int64)

    def sums(self, biased: np.ndarray) -> np.ndarray:
        total = biased.sum(axis=1)
        return total if self.kind is object else total.astype(np.int64)

    def _number(self, value: int, whole: bool = False):
        kind = np.uint64 if whole and self.kind is np.float64 else self.kind
        return value if kind is object else kind(value)


class Best:
    """The first ``most`` (score, id) of every slot among all that were added."""

    def __init__(self, slots: int, most: int) -> None:
        self.slots, self.most = slots, most
        self.slot = self.id = np.zeros(0, np.int64)
        self.score = self.slot
        #: A score below this cannot enter a slot; none stands for a slot with room.
        self.least: list = [None] * slots

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.isin(self.slot, slot)
        rest = [x[~touched] for x in (self.slot, self.score, self.id)]
        slot, score, ids = (np.concatenate(p) for p in ((self.slot[touched], slot), (self.score[touched], score), (self.id[touched], ids)))
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        place = np.arange(len(slot)) - np.repeat(starts, np.diff(np.r_[starts, len(slot)]))
        for k in np.flatnonzero(place == self.most - 1):
            self.least[slot[k]] = int(score[k])
        kept = place < self.most
        self.slot, self.score, self.id = (np.concatenate(p) for p in zip(rest, (slot[kept], score[kept], ids[kept]), strict=True))


class Anchors:
    """A block of anchors: ids, labels, quantised vectors and, once known, positive scores."""

    def __init__(self, ids: list[int], labels: list[int], vectors: np.ndarray, positives: dict[int, list[int]] | None = None) -> None:
        self.ids, self.labels = np.array(ids, np.int64), np.array(labels, np.int64)
        self.vectors = vectors
        self.positives = positives


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, quantised vectors) of about ROWS rows each."""
    held: list[tuple] = []
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            vectors = quantised(part.column(2), width)
            held.append((part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False), vectors))
            if sum(len(h[0]) for h in held) >= ROWS:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def quantised(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 * x) of every component, filled up with zeros to ``width``."""
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    for row, (end, n) in enumerate(zip(np.cumsum(lengths), lengths, strict=True)):
        out[row, :n] = flat[end - n : end]
    return out


def _emit(best: Best, anchors: Anchors, slots: int) -> pa.RecordBatch:
    arrays = [anchors.ids[best.slot // slots], (best.slot % slots).astype(np.int32), best.score, best.id]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["anchor_id", "slot", "score", "id"])


def _positives(sent, packing: Packing, most: int):
    """A task that finds the best rows of each anchor's own label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = sent.value
        own = packing.biased(anchors.vectors)
        best = Best(len(anchors.ids), most)
        for ids, labels, vectors in _blocks(batches, packing.width):
            for label in np.intersect1d(labels, anchors.labels):
                rows = np.flatnonzero(labels == label)
                biased = packing.biased(vectors[rows])
                wide, sums = packing.pack(biased), packing.sums(biased)
                mine = np.flatnonzero(anchors.labels == label)
                for chosen in np.split(mine, range(ANCHORS, len(mine), ANCHORS)):
                    scores = packing.scores(own[chosen], wide, sums)
                    other = ids[rows][None, :] != anchors.ids[chosen][:, None]
                    a, c = np.nonzero(other & (scores >= _entering(best, chosen, scores, most + 1)[:, None]))
                    best.add(chosen[a], scores[a, c], ids[rows][c])
        yield _emit(best, anchors, 1)

    return run


def _entering(best: Best, chosen: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Per anchor a score below which no row of this block can be among the first."""
    if scores.shape[1] > most:
        floor = np.partition(scores, scores.shape[1] - most, axis=1)[:, scores.shape[1] - most]
    else:
        floor = scores.min(axis=1)
    known = [best.least[k] for k in chosen]
    return np.array([f if b is None else max(b, f) for b, f in zip(known, floor, strict=True)])


def _negatives(sent, packing: Packing, positives: int, most: int, share: int):
    """A task that finds the hard negatives of each anchor's positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = sent.value
        own = packing.biased(anchors.vectors)
        best = Best(len(anchors.ids) * positives, most)
        # Highest first; a slot without a positive, or with one below 0, has no range.
        tops = {k: [s for s in anchors.positives.get(int(i), []) if s >= 0] for k, i in enumerate(anchors.ids)}
        wanted = np.array([k for k, own_tops in tops.items() if own_tops], np.int64)
        for ids, labels, vectors in _blocks(batches, packing.width):
            biased = packing.biased(vectors)
            wide, sums = packing.pack(biased), packing.sums(biased)
            for chosen in np.split(wanted, range(ANCHORS, len(wanted), ANCHORS)):
                if not len(chosen):
                    continue
                scores = packing.scores(own[chosen], wide, sums)
                lows = [[_low(s, share, best.least[k * positives + j]) for j, s in enumerate(tops[k])] for k in chosen]
                low, high = np.array([min(x) for x in lows]), np.array([tops[k][0] for k in chosen])
                fits = (scores >= low[:, None]) & (scores <= high[:, None])
                a, c = np.nonzero(fits & (labels[None, :] != anchors.labels[chosen][:, None]))
                found = scores[a, c]
                for j in range(positives):
                    # No score lies in (1, 0).
                    ends = [(lows[i][j], tops[k][j]) if j < len(lows[i]) else (1, 0) for i, k in enumerate(chosen)]
                    bottom, top = (np.array(x) for x in zip(*ends, strict=True))
                    inside = (found >= bottom[a]) & (found <= top[a])
                    best.add(chosen[a[inside]] * positives + j, found[inside], ids[c[inside]])
        yield _emit(best, anchors, positives)

    return run


def _low(score: int, share: int, least: int | None) -> int:
    """The least score that is ``share`` hundredths of ``score``, and may still enter."""
    low = -(-share * score // 100)
    return low if least is None else max(low, least)


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    share: int = SHARE,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on ``id``, the anchor's id. One row per hard negative
    of each anchor and positive; ``rank`` starts from 1.
    """
    spark = vectors.sparkSession
    named = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), F.col(vector_column).alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(finite)
    one = usable.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("one")).select("id", "one.*")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = materialise(one.repartition(tasks, "id"), "hard-negative-rows")

    largest = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
    stats = rows.agg(F.max(F.size("vector")).alias("width"), largest.alias("largest"), F.count_if(is_anchor).alias("anchors")).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not stats["anchors"] or not stats["width"]:
        # Vectors without components all score 0, and so does every pair.
        packing = Packing(0, 0)
    else:
        packing = Packing(stats["width"], int(np.floor(SCALE * stats["largest"])) + 1)
    path = scratch_path(spark, "hard-negatives")
    spark.createDataFrame([], result).write.parquet(path)
    blocks = -(-stats["anchors"] // block)
    for k in range(blocks):
        # About ``block`` anchors, whatever the number of rows.
        mine = rows.where(is_anchor).where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k)
        _mine_block(rows, mine, packing, positives, negatives, share, path)
    return spark.read.schema(result).parquet(path)


def _mine_block(
    rows: DataFrame, mine: DataFrame, packing: Packing, positives: int, negatives: int, share: int, path: str
) -> None:
    """Appends the hard negatives of one block of anchors to the table at ``path``."""
    spark = rows.sparkSession
    anchors = mine.toArrow().combine_chunks().to_batches()
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, packing.width)))
    parts = [(b.column(0).to_pylist(), b.column(1).to_pylist(), quantised(b.column(2), packing.width)) for b in anchors]
    ids, labels, vectors = parts[0] if parts else empty
    sent = spark.sparkContext.broadcast(Anchors(ids, labels, vectors))
    found = _first(rows.mapInArrow(_positives(sent, packing, positives), _FOUND), positives)
    chosen = materialise(found, "hard-positives")
    sent.unpersist()
    # At most ``positives`` short rows an anchor of the block.
    scores: dict[int, list[int]] = {}
    for r in chosen.orderBy("anchor_id", "place").collect():
        scores.setdefault(r["anchor_id"], []).append(r["score"])
    sent = spark.sparkContext.broadcast(Anchors(ids, labels, vectors, scores))
    found = _first(rows.mapInArrow(_negatives(sent, packing, positives, negatives, share), _FOUND), negatives)
    pairs = chosen.select("anchor_id", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = found.select("anchor_id", "slot", F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = best.join(pairs, ["anchor_id", "slot"]).drop("slot")
    joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.mode("append").parquet(path)
    sent.unpersist()


def _first(found: DataFrame, most: int) -> DataFrame:
    """The first rows of each anchor and slot among those of all tasks."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
