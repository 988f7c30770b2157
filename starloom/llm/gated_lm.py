"""Log-likelihood of whole documents under a gated recurrent language model.

Text is lower-cased (A-Z); tokens are its words and one end. Counts of all training
tokens are made by Spark. The model is a GRU in numpy:

* output: a softmax over classes, then within the class. Frequent words (``FREQUENT``) have
  classes of their own with a softmax over their words; other words fall in tail
  classes by their first three bytes, with smoothed training counts within the class.
* training: truncated back-propagation over windows of ``WINDOW`` steps, with Adam.
  Every task trains a replica on its documents; replicas are averaged over all
  tasks, in a tree of bounded fan-in, after each round. Every training document is
  learned from once: the rounds share them out by a hash of id and text, so copies
  of one text are spread over the rounds.
* scoring: documents are laid on lanes that advance together; the state is carried from
  window to window and is reset only where a document begins.

Words beyond the ``KNOWN`` most frequent are looked up in the counts by a join on
the words, so nothing that grows with the corpus is sent to the tasks.

Defined results: a null, empty or blank text is the end token alone. Repeated rows are
each counted and scored. Without training documents all counts are 0.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.scratch import materialise, scratch_path

#: The end token; no word holds a line feed.
END = b"\n"
#: Words with an output of their own, in classes of CLASS; tail classes; words sent to tasks.
FREQUENT, CLASS, TAIL = 2048, 64, 64
KNOWN = 50_000
HIDDEN, EMBEDDING = 32, 16
WINDOW, SCORE_LANES = 24, 256
#: Lanes in training, at least and at most; between them a batch takes about UPDATES windows.
TRAIN_LANES, UPDATES = (16, 256), 256
ROUNDS = 4
FAN_IN = 64
#: Rows whose outputs are taken at once, for the caches' sake.
BLOCK = 1024
#: Rows whose words are held at once.
SLICE = 2500


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[:3]) % TAIL


class Network:
    """Parameters as views of one flat vector, with forward and backward windows."""

    def __init__(self, words: int, flat: np.ndarray | None = None, shares: np.ndarray | None = None) -> None:
        self.words = words
        self.classes = -(-words // CLASS)
        outputs = self.classes + TAIL
        shapes = {
            "embed": (words + TAIL, EMBEDDING),
            "input": (EMBEDDING, 3 * HIDDEN),
            "gate": (3 * HIDDEN,),
            "state": (HIDDEN, 3 * HIDDEN),
            "class": (HIDDEN, outputs),
            "class_bias": (outputs,),
            "word": (self.classes, HIDDEN, CLASS),
            "word_bias": (self.classes, CLASS),
        }
        sizes = [int(np.prod(s)) for s in shapes.values()]
        self.flat = np.zeros(sum(sizes), np.float32) if flat is None else flat
        parts = np.split(self.flat, np.cumsum(sizes)[:-1])
        self.p = {n: part.reshape(s) for (n, s), part in zip(shapes.items(), parts, strict=True)}
        if flat is None:
            random = np.random.default_rng(1)
            for name, scale in (("embed", 0.3), ("input", 0.25), ("state", 0.15), ("class", 0.02), ("word", 0.02)):
                self.p[name][...] = random.normal(0, scale, self.p[name].shape)
            self.p["word_bias"].reshape(-1)[words:] = -30  # the last class's empty places
            if shares is not None:  # start at the training frequencies
                self._start(shares)

    def _start(self, shares: np.ndarray) -> None:
        logs = np.log(np.maximum(shares, 1e-9))
        padded = np.full(self.classes * CLASS, -30.0)
        padded[: self.words] = logs[: self.words]
        grid = padded.reshape(self.classes, CLASS)
        self.p["word_bias"][...] = grid - grid.max(axis=1, keepdims=True)
        mass = np.concatenate([np.exp(grid).sum(axis=1), np.exp(logs[self.words :])])
        self.p["class_bias"][...] = np.log(mass + 1e-9)

    def gates(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the gates by (embedding, 1) and by state, so that a gate is 1 / (1 + exp(a)), the candidate 1 - 2 / (1 + exp(a))."""
        scale = np.repeat(np.array([-1, -1, 2], self.flat.dtype), HIDDEN)
        by_input = np.concatenate([self.p["input"], self.p["gate"][None]]) * scale
        return np.ascontiguousarray(by_input.T), np.ascontiguousarray((self.p["state"] * scale).T)

    def run(self, before: np.ndarray, first: np.ndarray, h: np.ndarray, room: Room, keep: bool = False) -> Steps:
        """All steps of a window from state ``h``; arrays are (step, unit, lane), so that every gate is contiguous.

        Without ``keep`` gates and candidates are those of the last step.
        """
        steps, lanes = before.shape
        by_input, by_state = self.gates()
        inputs = room.of("inputs", steps, lanes, EMBEDDING + 1)
        inputs[:, :, :-1] = self.p["embed"].take(before, axis=0)
        inputs[:, :, -1] = 1
        x = room.of("x", 3 * HIDDEN, lanes)
        kept = steps if keep else 1
        gates, n = room.of("gates", kept, 3 * HIDDEN, lanes), room.of("n", kept, HIDDEN, lanes)
        states = room.of("states", steps + 1, HIDDEN, lanes)
        states[0] = h
        resets = first.any(axis=1).tolist()
        for t in range(steps):
            earlier, u, m, after = states[t], gates[t % kept], n[t % kept], states[t + 1]
            if resets[t]:
                earlier = np.where(first[t], earlier.dtype.type(0), earlier)
            np.dot(by_input, inputs[t].T, out=x)
            np.dot(by_state, earlier, out=u)
            zr = u[: 2 * HIDDEN]
            zr += x[: 2 * HIDDEN]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.multiply(u[HIDDEN : 2 * HIDDEN], u[2 * HIDDEN :], out=m)
            m += x[2 * HIDDEN :]
            np.exp(m, out=m)
            m += 1
            np.divide(-2, m, out=m)
            m += 1
            np.subtract(earlier, m, out=after)
            after *= u[:HIDDEN]
            after += m
        return Steps(inputs, gates, n, states)

    def outputs(self, hidden: np.ndarray, target: np.ndarray, room: Room, grad: Network | None = None) -> np.ndarray:
        """Natural log-probabilities of targets (tail words: of their class); with ``grad`` d loss / d hidden instead."""
        kind = np.where(target < self.words, target // CLASS, target - self.words + self.classes).astype(np.uint16)
        order = np.argsort(kind, kind="stable")
        size = len(order)
        hidden = hidden.take(order, axis=0, out=room.of("sorted", size, HIDDEN), mode="clip")
        target, kind = target[order], kind[order]
        edges = np.searchsorted(kind, np.arange(self.classes + 1)).tolist()
        value = np.empty(size, hidden.dtype)
        delta = room.of("delta", size, HIDDEN)
        weights, bounded = self.p["class"], self._bounded("class")
        every, ones = np.arange(size), np.ones(max(BLOCK, self.classes + TAIL), hidden.dtype)
        for start in range(0, size, BLOCK):
            rows = slice(start, min(start + BLOCK, size))
            at, own = every[: rows.stop - start], kind[rows]
            logits = np.dot(hidden[rows], weights, out=room.of("logits", len(at), self.classes + TAIL))
            logits += self.p["class_bias"]
            total = _exponentials(logits, bounded, ones)
            if grad is None:
                value[rows] = np.log(logits[at, own] / total)
                continue
            logits *= (1 / total)[:, None]
            logits.reshape(-1)[at * logits.shape[1] + own] -= 1
            grad.p["class"] += np.dot(logits.T, hidden[rows]).T
            grad.p["class_bias"] += np.dot(ones[: len(at)], logits)
            np.dot(logits, weights.T, out=delta[rows])
        # Frequent words stand first, by their classes.
        size = edges[-1]
        classes = [(k, slice(*edges[k : k + 2])) for k in range(self.classes) if edges[k] < edges[k + 1]]
        inner, at, place = room.of("inner", size, CLASS), every[:size], target[:size] % CLASS
        for k, rows in classes:
            part = np.dot(hidden[rows], self.p["word"][k], out=inner[rows])
            part += self.p["word_bias"][k]
        total = _exponentials(inner, self._bounded("word"), ones)
        if grad is None:
            value[:size] += np.log(inner[at, place] / total)
            out = np.empty_like(value)
            out[order] = value
            return out
        inner *= (1 / total)[:, None]
        inner.reshape(-1)[at * CLASS + place] -= 1
        within = room.of("within", size, HIDDEN)
        for k, rows in classes:
            np.dot(hidden[rows].T, inner[rows], out=grad.p["word"][k])
            np.dot(np.ones(rows.stop - rows.start, inner.dtype), inner[rows], out=grad.p["word_bias"][k])
            np.dot(inner[rows], self.p["word"][k].T, out=within[rows])
        delta[:size] += within
        back = np.empty_like(order)
        back[order] = every
        return delta.take(back, axis=0, out=room.of("unsorted", *delta.shape), mode="clip")

    def _bounded(self, name: str) -> bool:
        """Whether no logit can leave -80 to 80, the range of exponentials; states lie between -1 and 1."""
        return float(np.abs(self.p[name]).sum(axis=-2).max() + np.abs(self.p[f"{name}_bias"]).max()) < 80


def _exponentials(logits: np.ndarray, bounded: bool, ones: np.ndarray) -> np.ndarray:
    """Turns rows into their exponentials, in place; returns the sums."""
    if not bounded:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    return np.dot(logits, ones[: logits.shape[1]])


class Steps(NamedTuple):
    """A window's inputs (step, lane, embedding and 1), gates with twice the candidate's part by state, candidates, and states before and after."""

    inputs: np.ndarray
    gates: np.ndarray
    n: np.ndarray
    states: np.ndarray

    def rows(self, real: np.ndarray, room: Room) -> np.ndarray:
        """The state after every real step."""
        after = self.states[1:].transpose(0, 2, 1)
        if real.all():
            out = room.of("rows", *after.shape)
            out[...] = after
            return out.reshape(-1, HIDDEN)
        return after[real]


class Room:
    """Arrays that are used again and again, by name."""

    def __init__(self, kind: type) -> None:
        self.kind = kind
        self.held: dict[str, np.ndarray] = {}

    def of(self, name: str, *shape: int) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, self.kind)
        return self.held[name][:size].reshape(shape)


class Lanes:
    """Documents laid end to end on lanes, the longest lanes first; memory is that of their tokens."""

    def __init__(self, docs: list[np.ndarray], count: int) -> None:
        order = sorted(range(len(docs)), key=lambda d: -len(docs[d]))
        heap = [(0, lane) for lane in range(min(count, len(docs)))]
        lanes: list[list[int]] = [[] for _ in heap]
        for d in order:
            size, lane = heapq.heappop(heap)
            lanes[lane].append(d)
            heapq.heappush(heap, (size + len(docs[d]), lane))
        lanes.sort(key=lambda lane: -sum(len(docs[d]) for d in lane))
        self.lengths = np.array([sum(len(docs[d]) for d in lane) for lane in lanes], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        order = [d for lane in lanes for d in lane]
        sizes = [len(docs[d]) for d in order]
        self.tokens = np.concatenate([docs[d] for d in order]) if order else np.zeros(0, np.int32)
        self.docs = np.repeat(np.array(order, np.int32), sizes)
        self.starts = np.zeros(len(self.tokens), bool)
        self.starts[np.cumsum(sizes, dtype=np.int64) - np.array(sizes, np.int64)] = True

    def windows(self, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(inputs, targets, documents, first steps) of the lanes still running, step by step.

        A document's first input is the end token; a target behind a lane's end is -1.
        """
        for start in range(0, int(self.lengths[0]) if len(self.lengths) else 0, WINDOW):
            running = int((self.lengths > start).sum())
            step = np.arange(start, min(start + WINDOW, int(self.lengths[0])))[:, None]
            real = step < self.lengths[:running]
            at = np.where(real, self.begins[:running] + step, 0)
            first = self.starts[at] & real
            before = np.where(first, end, np.where(real, self.tokens[at - 1], 0))
            yield before, np.where(real, self.tokens[at], -1), self.docs[at], first


def score_documents(network: Network, docs: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log-likelihood of each document, without the counts within tail classes."""
    lanes = Lanes(docs, SCORE_LANES)
    scores = np.zeros(len(docs))
    room = Room(network.flat.dtype.type)
    h = np.zeros((HIDDEN, len(lanes.lengths)), network.flat.dtype)
    for before, target, doc, first in lanes.windows(end):
        steps = network.run(before, first, h[:, : before.shape[1]], room)
        h = steps.states[-1].copy()
        real = target >= 0
        logs = network.outputs(steps.rows(real, room), target[real], room)
        scores += np.bincount(doc[real], weights=logs, minlength=len(docs))
    return scores


class Trainer:
    """Adam on one replica."""

    def __init__(self, network: Network, rate: float) -> None:
        self.network, self.rate = network, rate
        self.grad = Network(network.words, np.zeros_like(network.flat))
        self.mean, self.square = np.zeros_like(network.flat), np.zeros_like(network.flat)
        self.room = Room(network.flat.dtype.type)
        self.updates = 0
        self.tokens = 0

    def learn(self, docs: list[np.ndarray], end: int) -> None:
        least, most = TRAIN_LANES
        lanes = Lanes(docs, min(most, max(least, sum(map(len, docs)) // (WINDOW * UPDATES))))
        h = np.zeros((HIDDEN, len(lanes.lengths)), self.network.flat.dtype)
        for before, target, _, first in lanes.windows(end):
            h = self._window(before, target, first, h[:, : before.shape[1]])

    def _window(self, before: np.ndarray, target: np.ndarray, first: np.ndarray, h: np.ndarray) -> np.ndarray:
        net, grad, room = self.network, self.grad, self.room
        grad.flat[:] = 0
        inputs, gates, n, states = steps = net.run(before, first, h, room, keep=True)
        real = target >= 0
        delta = net.outputs(steps.rows(real, room), target[real], room, grad)
        back = room.of("back", *n.shape)
        if len(delta) < real.size:
            whole = np.zeros((*real.shape, HIDDEN), delta.dtype)
            whole[real] = delta
            delta = whole
        back[...] = delta.reshape(*real.shape, HIDDEN).transpose(0, 2, 1)
        h = states[-1].copy()
        earlier = states[:-1]
        earlier.transpose(0, 2, 1)[first] = 0
        z, r, v = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        # d gate / d state of every step; times d loss / d state these become the gradients at the gates by state.
        slopes = room.of("slopes", *gates.shape)
        by_z, by_r, by_n = slopes[:, :HIDDEN], slopes[:, HIDDEN : 2 * HIDDEN], slopes[:, 2 * HIDDEN :]
        rest, direct = np.subtract(1, z, out=room.of("rest", *n.shape)), room.of("direct", *n.shape)
        np.subtract(earlier, n, out=by_z)
        by_z *= z
        by_z *= rest
        np.multiply(n, n, out=direct)
        np.subtract(1, direct, out=direct)
        direct *= rest
        np.multiply(direct, r, out=by_n)
        np.subtract(0.5, np.multiply(r, 0.5, out=rest), out=by_r)
        by_r *= by_n
        by_r *= v
        resets = first.any(axis=1).tolist()
        state = net.p["state"]
        into = np.zeros(n.shape[1:], n.dtype)
        through = np.empty_like(into)
        for t in reversed(range(len(before))):
            dh, du = back[t], slopes[t]
            dh += into
            units = du.reshape(3, HIDDEN, -1)
            units *= dh
            np.matmul(state, du, out=through)
            np.multiply(dh, z[t], out=into)
            into += through
            if resets[t]:
                into[:, first[t]] = 0
        grad.p["state"] += np.matmul(slopes, earlier.transpose(0, 2, 1)).sum(axis=0).T
        np.multiply(back, direct, out=by_n)  # by input, the candidate's part is not gated
        by_input = np.matmul(slopes, inputs).sum(axis=0).T
        grad.p["input"] += by_input[:-1]
        grad.p["gate"] += by_input[-1]
        ids = before.ravel().astype(np.uint16 if len(grad.p["embed"]) <= 1 << 16 else np.int32)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        edges = np.flatnonzero(np.diff(ids, prepend=ids[0] + 1))
        embedded = np.matmul(slopes.transpose(0, 2, 1), np.ascontiguousarray(net.p["input"].T), out=room.of("embedded", *before.shape, EMBEDDING))
        grad.p["embed"][ids[edges]] = np.add.reduceat(embedded.reshape(-1, EMBEDDING).take(order, axis=0), edges)
        self._adam(int(real.sum()))
        return h

    def _adam(self, count: int) -> None:
        self.updates += 1
        self.tokens += count
        norm = float(np.sqrt(self.grad.flat @ self.grad.flat)) / max(1, count)
        scale = 1 / (max(1, count) * max(1, norm))
        rate, spread = self.rate / (1 - 0.9**self.updates), 1 / (1 - 0.99**self.updates)
        for start in range(0, len(self.grad.flat), 16 * BLOCK):
            flat, grad, mean, square = (x[start : start + 16 * BLOCK] for x in (self.network.flat, self.grad.flat, self.mean, self.square))
            g, size = grad * scale, self.room.of("size", len(grad))
            np.subtract(g, mean, out=size)
            size *= 0.1
            mean += size
            g *= g
            g -= square
            g *= 0.01
            square += g
            np.multiply(square, spread, out=size)
            np.sqrt(size, out=size)
            size += 1e-6
            np.divide(mean, size, out=size)
            size *= rate
            flat -= size


class TokenIds:
    """Model ids of words: frequent ones have their own, others that of their tail class."""

    def __init__(self, frequent: list[bytes]) -> None:
        self.base = len(frequent)
        self.frequent = pa.array(frequent, pa.binary())

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return self.of_array(pa.array(tokens, pa.binary()))

    def of_array(self, words: pa.Array) -> np.ndarray:
        ids = _places(words, self.frequent)
        other = np.flatnonzero(ids < 0)
        ids[other] = self.base + tail_classes(words.take(pa.array(other)))
        return ids


def _places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """The place of every word in ``among``, or -1."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy(zero_copy_only=False).astype(np.int32)


def tail_classes(words: pa.Array) -> np.ndarray:
    """``tail_class`` of every word; words share few beginnings."""
    begins = pc.binary_slice(words, 0, 3).dictionary_encode()
    classes = np.fromiter((tail_class(w.as_py()) for w in begins.dictionary), np.int32, len(begins.dictionary))
    return classes[begins.indices.to_numpy()] if len(words) else np.zeros(0, np.int32)


def _words(batch: pa.RecordBatch, column: int) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z lower-cased, and the text of each; null counts as empty."""
    text = pc.fill_null(batch.column(column).cast(pa.binary()), b"").view(pa.string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(text))
    owner = np.repeat(np.arange(len(text), dtype=np.int32), np.diff(split.offsets.to_numpy()))
    words = split.flatten().view(pa.binary())
    # White space at an end of a text leaves an empty word there.
    filled = np.flatnonzero(pc.binary_length(words).to_numpy())
    return (words, owner) if len(filled) == len(words) else (words.take(pa.array(filled)), owner[filled])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most SLICE rows, which bound the memory that words take."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _documents(ids: np.ndarray, owner: np.ndarray, count: int, end: int) -> list[np.ndarray]:
    """The ids of each document, an end behind its words."""
    tokens = np.full(len(ids) + count, end, np.int32)
    tokens[np.arange(len(ids)) + owner] = ids
    return np.split(tokens, np.cumsum(np.bincount(owner, minlength=count) + 1)[:-1]) if count else []


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = _words(batch, 0)[0].dictionary_encode()
        times = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([words.dictionary, pa.array(times)], names=["word", "c"])
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([batch.num_rows], pa.int64())], names=["word", "c"])


def _replica(given):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, flat, rate = given.value
        ids = TokenIds(frequent)
        end = frequent.index(END)
        trainer = Trainer(Network(len(frequent), flat.copy()), rate)
        for batch in batches:
            docs: list[np.ndarray] = []
            for part in _slices([batch]):
                words, owner = _words(part, 0)
                docs += _documents(ids.of_array(words), owner, part.num_rows, end)
            trainer.learn(docs, end)
        if trainer.tokens:
            weights = pa.array([(trainer.network.flat * np.float32(trainer.tokens)).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([trainer.tokens], pa.int64()), weights], names=["tokens", "weights"])

    return train


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(w.as_py(), np.float32) for w in table.column("weights"))
    tokens = sum(table.column("tokens").to_pylist())
    return pa.table({"tokens": pa.array([tokens], pa.int64()), "weights": pa.array([total.tobytes()], pa.binary())})


def _averaged(replicas: DataFrame) -> np.ndarray | None:
    """Token-weighted mean of the replicas, summed in groups of at most about FAN_IN."""
    level = materialise(replicas, "gated-replicas")
    n = level.count()
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        key = F.pmod(F.xxhash64("weights"), F.lit(n)).alias("key")
        level = materialise(level.groupBy(key).applyInArrow(_add, "tokens long, weights binary"), "gated-replicas")
        n = level.count()
    rows = level.collect()
    if not rows:
        return None
    return sum(np.frombuffer(r.weights, np.float32) for r in rows) / np.float32(sum(r.tokens for r in rows))


def score_texts(
    docs: DataFrame,
    training: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    frequent_words: int = FREQUENT,
    known_words: int = KNOWN,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score.

    ``base_score`` is the smoothed unigram, ``score`` the model's log10 probability.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_column].dataType.simpleString()
    text = training.select(F.col(text_column).alias("text"))
    counts = text.mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counts = materialise(counts, "gated-counts")
    known = [(bytes(r.word), r.c) for r in counts.orderBy(F.desc("c"), "word").limit(known_words).collect()]
    frequent = [w for w, _ in known[:frequent_words] if w != END]
    frequent = [END, *frequent][: max(1, frequent_words)]
    bucket = F.crc32(F.substring("word", 1, 3)) % TAIL
    mass, size, ends = np.zeros((TAIL, 2)), [0, 0], 0
    ended = F.sum(F.when(F.col("word") == F.lit(END), F.col("c")).otherwise(0))
    for row in counts.groupBy(bucket.alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("v"), ended.alias("ends")).collect():
        mass[row.k] = row.c, row.v
        size = [size[0] + row.c, size[1] + row.v]
        ends += row.ends
    by_word = {**dict(known), **({END: ends} if ends else {})}
    for word in frequent:
        if word in by_word:
            mass[tail_class(word)] -= by_word[word], 1
    tail = mass[:, 0] + 0.1 * (mass[:, 1] + 1)
    shares = np.array([*(by_word.get(w, 0) for w in frequent), *mass[:, 0]], float) + 0.5
    network = Network(len(frequent), shares=shares / shares.sum())

    slice_of = F.pmod(F.xxhash64(id_column, text_column), F.lit(rounds)).alias("slice")
    # Each round reads its own rows alone.
    path = scratch_path(spark, "gated-training")
    training.select(F.col(text_column).alias("text"), slice_of).write.partitionBy("slice").parquet(path)
    shared = spark.read.schema("text string, slice long").parquet(path)
    for round_ in range(rounds):
        given = spark.sparkContext.broadcast((frequent, network.flat, 0.01 / (1 + round_)))
        own = shared.where(F.col("slice") == round_).select("text")
        mean = _averaged(own.mapInArrow(_replica(given), "tokens long, weights binary"))
        if mean is not None:
            network = Network(len(frequent), mean.astype(np.float32))

    known = [(w, c) for w, c in known if w != END]
    logs = np.log10(np.array([c for _, c in known], float) + 0.1)
    end_log = float(np.log10(ends + 0.1)) if ends else None
    given = spark.sparkContext.broadcast((frequent, network.flat, [w for w, _ in known], logs, np.log10(tail), end_log))
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    scored = materialise(
        numbered.mapInArrow(
            _score(given),
            f"rid long, id {id_type}, n_tokens long, n_known long, known double, model double, "
            "rare array<binary>, times array<int>",
        ),
        "gated-scores",
    )
    # One row per document and rare word; the counts come to the words by a join.
    pairs = scored.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    pairs = pairs.select("rid", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    looked = pairs.join(counts, "word", "left")
    value = F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))
    rest = looked.groupBy("rid").agg(
        F.sum(value).alias("rest"), F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("found")
    )
    joined = scored.drop("rare", "times").join(rest, "rid", "left")
    rest_, found = F.coalesce("rest", F.lit(0.0)), F.coalesce("found", F.lit(0))
    scale = float(np.log10(size[0] + 0.1 * (size[1] + 1)))
    return joined.select(
        F.col("id").alias(id_column),
        "n_tokens",
        (F.col("n_known") + found).cast("long").alias("n_known"),
        F.lit(size[0]).cast("long").alias("train_tokens"),
        (F.col("known") + rest_ - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("model") + rest_).alias("score"),
    )


def _score(given):
    """Sums that need no rare counts, and each document's rare words with their numbers."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, flat, known, logs, tail, end_log = given.value
        network, end = Network(len(frequent), flat), frequent.index(END)
        known = pa.array(known, pa.binary())
        # The last place stands for words that are not known; END is not among them.
        id_of = np.append(TokenIds(frequent).of_array(known), -1)
        log_of = np.append(logs, 0)
        for batch in _slices(batches):
            words, owner = _words(batch, 2)
            count = batch.num_rows
            place = _places(words, known)
            rare = np.flatnonzero(place < 0)
            spelled = words.take(pa.array(rare))
            own, value = id_of[place], log_of[place]
            own[rare] = len(frequent) + tail_classes(spelled)
            # Within a tail class: log10 of the smoothed count over the class's mass.
            outside = np.flatnonzero(own >= len(frequent))
            inner = np.bincount(owner[outside], value[outside] - tail[own[outside] - len(frequent)], count)
            sizes = np.bincount(owner, minlength=count)
            found = sizes - np.bincount(owner[rare], minlength=count) + (end_log is not None)
            base = np.bincount(owner, value, count) + (np.log10(0.1) if end_log is None else end_log)
            spelled = spelled.dictionary_encode()
            distinct = max(1, len(spelled.dictionary))
            pairs, times = np.unique(owner[rare].astype(np.int64) * distinct + spelled.indices.to_numpy(), return_counts=True)
            offsets = pa.array(np.searchsorted(pairs, np.arange(count + 1) * distinct), pa.int32())
            docs = _documents(own, owner, count, end)
            model = score_documents(network, docs, end) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(sizes + 1, pa.int64()),
                    pa.array(found, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(model + inner, pa.float64()),
                    pa.ListArray.from_arrays(offsets, spelled.dictionary.take(pa.array(pairs % distinct))),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                ],
                names=["rid", "id", "n_tokens", "n_known", "known", "model", "rare", "times"],
            )

    return score
