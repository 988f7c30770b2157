"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

Text is lower-cased (A-Z) and split into words. A passage matches an item if the
weighted Jaccard similarity of their 5-word shingles reaches ``threshold``; a
shingle's weight is its number of occurrences. Passages are as long as the item, or
shorter where a document's beginning or end cuts them off.

* Windows: a passage at the threshold shares so many shingles with an item of ``n`` words
  that it has at least ``w`` words itself; items whose ``w`` differ by less than ``SHARED``
  take the smallest of them. All windows of ``w`` words of an item are fingerprinted
  (64-bit SimHash of the words, by frequency), and so are windows of ``w`` words of every
  document, at multiples of ``n - w + 1`` and at both its ends: every passage holds one of
  them in full.
* Fingerprints are looked up by four blocks of 16 bits: two fingerprints within ``radius``
  agree in at least one block up to ``radius // 4`` bits, so every pair within it is found.
* Places: around each window found, the similarity of all passages that begin or end
  with a shingle of the item is counted exactly; the earliest best one is reported.

A passage whose window lies outside the radius is missed: copies never are, and
changed passages down to the threshold rarely (the tests measure recall).

Defined results: null, empty and blank texts match nothing. An item of fewer
than five words is one shingle. ``n_words`` is the length of the passage. Equal items each give their row; repeated
documents give theirs. Of equal similarities the earliest passage is reported. A document of any
length is fingerprinted in pieces, so only its words are held. An empty table gives no
rows. Only id and text columns of the two tables are read; a null id is kept.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from starloom.llm.words import WordHashes, Windows, texts

SHINGLE = 5
THRESHOLD = 0.75
RADIUS = 11
BLOCKS = 4
#: Part by which window sizes of items may differ that share one size.
SHARED = 1 / 12
#: Bytes of benchmark text one pass over the documents takes; more items take more passes.
PASS_BYTES = 1 << 20
#: Windows fingerprinted at once, and words of short documents laid end to end.
_ROWS = 32_768
_TOGETHER = 1 << 16
_STEPS = 256


def running_bits(hashes: np.ndarray, longest: int) -> np.ndarray:
    """Running sums of every bit; 16 bits are enough for differences over short windows."""
    kind = np.int16 if longest < 1 << 15 else np.int32
    n = len(hashes)
    # Many runs are summed side by side, and then each is raised by the totals before it.
    steps = _STEPS if n > 16 * _STEPS else 1
    out = np.zeros((1 + -(-n // steps) * steps, 64), kind)
    out[1 : n + 1] = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    runs = out[1:].reshape(-1, steps, 64)
    for t in range(1, steps):
        runs[:, t] += runs[:, t - 1]
    runs[1:] += np.cumsum(runs[:-1, -1], axis=0, dtype=kind)[:, None]
    return out[: n + 1]


def simhash(sums: np.ndarray, starts: np.ndarray | slice, size: int) -> np.ndarray:
    """Fingerprints of windows of ``size`` words: a bit is set if it is in most of the words."""
    ones = sums[size:][starts] - sums[: len(sums) - size][starts]
    return np.packbits(ones > size // 2, axis=1).view(np.uint64).ravel()


class HammingIndex:
    """All indexed fingerprints within a radius of a query, by blocks of 16 bits.

    Every block lists the fingerprints by all values that differ from theirs in
    ``radius // BLOCKS`` bits at most.
    """

    def __init__(self, prints: np.ndarray, radius: int) -> None:
        self.prints = prints
        self.radius = radius
        spread = np.arange(1 << 16, dtype=np.uint16)
        ball = spread[np.bitwise_count(spread) <= radius // BLOCKS]
        self.tables = []
        for part in prints.view(np.uint16).reshape(-1, BLOCKS).T:
            values = (part[:, None] ^ ball).ravel()
            order = np.argsort(values, kind="stable")
            count = np.bincount(values, minlength=1 << 16)
            starts = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            entries = (order // len(ball)).astype(np.int32)
            self.tables.append((count > 0, starts, entries, prints[entries]))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, indexed fingerprint) of all pairs within the radius, each once."""
        found = []
        parts = queries.view(np.uint16).reshape(-1, BLOCKS)
        for block, (seen, starts, entries, prints) in enumerate(self.tables):
            hit = np.flatnonzero(seen[parts[:, block]])
            value = parts[hit, block].astype(np.int32)
            first = starts[value]
            count = starts[value + 1] - first
            ends = np.cumsum(count)
            at = np.arange(ends[-1] if len(ends) else 0)
            at += np.repeat(first - (ends - count), count)
            apart = np.repeat(queries[hit], count)
            apart ^= prints[at]
            near = np.flatnonzero(np.bitwise_count(apart) <= self.radius)
            query = hit[np.searchsorted(ends, near, "right")]
            found.append(query * np.int64(len(self.prints)) + entries[at[near]])
        pairs = np.unique(np.concatenate(found))
        return np.divmod(pairs, max(1, len(self.prints)))


class ItemIndex:
    """Fingerprints and shingle weights of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], radius: int = RADIUS, threshold: float = THRESHOLD) -> None:
        self.hashes = WordHashes()
        self.windows = {size: Windows(size) for size in range(1, SHINGLE + 1)}
        self.threshold = threshold
        self.ids, self.sizes, self.weights = [], [], []
        hashed, shared, least = [], [], []
        for item_id, text in items:
            words = (text or "").encode().lower().split()
            if not words:
                continue
            number, n = len(self.ids), len(words)
            size = min(SHINGLE, n)
            hashes = self.hashes.of(words)
            weights = Counter(self.windows[size].of(hashes).tolist())
            self.ids.append(item_id)
            self.sizes.append(n)
            self.weights.append(weights)
            hashed.append(hashes)
            # The union has at least the item's total, so this many shingles have to be shared.
            shared.append(max(1, math.ceil(threshold * weights.total() - 1e-9)))
            least.append(shared[-1] + size - 1)
        self.shared = shared
        self.known = [np.sort(np.fromiter(weights, np.uint64, len(weights))) for weights in self.weights]
        self.longest = max(least, default=1)
        members: dict[int, list[int]] = {}
        for number in sorted(range(len(least)), key=least.__getitem__):
            near = members and least[number] < (1 + SHARED) * max(members)
            members.setdefault(max(members) if near else least[number], []).append(number)
        self.groups = []
        for size, numbers in members.items():
            stride = min(self.sizes[n] for n in numbers) - size + 1
            prints = [simhash(running_bits(hashed[n], size), slice(None), size) for n in numbers]
            number = np.repeat(numbers, [len(own) for own in prints])
            self.groups.append((size, stride, HammingIndex(np.concatenate(prints), radius), number))

    def matches(self, documents: list[bytes]) -> list[dict[int, tuple[float, int, int]]]:
        """Per document and item number the best (similarity, first word, words) at or over the threshold."""
        out: list[dict[int, tuple[float, int, int]]] = []
        words: list[bytes] = []
        bounds: list[tuple[int, int]] = []
        for document in documents:
            own = document.lower().split()
            if len(words) + len(own) > _TOGETHER and bounds:
                out += self._verified(words, bounds)
                words, bounds = [], []
            bounds.append((len(words), len(words) + len(own)))
            words += own
        return out + (self._verified(words, bounds) if bounds else [])

    def _verified(self, words: list[bytes], bounds: list[tuple[int, int]]) -> list[dict[int, tuple[float, int, int]]]:
        best: list[dict[int, tuple[float, int, int]]] = [{} for _ in bounds]
        hashes = self.hashes.of(words)
        shingles: dict[int, np.ndarray] = {}
        for (at, number), places in self.candidates(hashes, np.array(bounds)).items():
            first, last = bounds[at]
            size = min(SHINGLE, self.sizes[number])
            if size not in shingles:
                shingles[size] = self.windows[size].of(hashes)
            found = self._best(number, shingles[size][first : last - size + 1], np.array(sorted(set(places))) - first)
            if found:
                best[at][number] = found
        return best

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """Places of windows near a window of an item, by document and item number.

        Documents are laid end to end; windows that reach over an end are left out.
        """
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for start in range(0, len(hashes), _ROWS):
            # Windows that begin in this block; the largest reaches into the next one.
            sums = running_bits(hashes[start : start + _ROWS + self.longest - 1], self.longest)
            for size, stride, index, number in self.groups:
                last = min(_ROWS, len(sums) - size)
                if last <= 0:
                    continue
                regular = slice(-start % stride, last, stride)
                edges = np.concatenate([bounds[:, 0], bounds[:, 1] - size]) - start
                edges = edges[(edges >= 0) & (edges < last)]
                begin = np.concatenate([np.arange(last)[regular], edges]) + start
                prints = np.concatenate([simhash(sums, part, size) for part in (regular, edges)])
                query, entry = index.search(prints)
                begin = begin[query]
                at = np.searchsorted(bounds[:, 0], begin, "right") - 1
                inside = begin + size <= bounds[at, 1]
                rows = (at[inside], number[entry[inside]], begin[inside])
                for document, item, place in zip(*(row.tolist() for row in rows), strict=True):
                    places[document, item].append(place)
        return places

    def _best(self, number: int, shingles: np.ndarray, places: np.ndarray) -> tuple[float, int, int] | None:
        """The earliest best (similarity, first word, words) of an item around places in one document."""
        n, weights, known = self.sizes[number], self.weights[number], self.known[number]
        size, total = min(SHINGLE, n), weights.total()
        words = len(shingles) + size - 1
        # Positions of all of the item's shingles, as far as a passage around a place reaches.
        low, high = np.maximum(places - n, 0), np.minimum(places + 2 * n, words - size + 1)
        cut = np.flatnonzero(low[1:] > high[:-1]) + 1
        spans = zip(low[[0, *cut]].tolist(), high[[*(cut - 1), -1]].tolist(), strict=True)
        near = np.concatenate([np.arange(*span) for span in spans])
        kind = np.minimum(np.searchsorted(known, shingles[near]), len(known) - 1)
        hit = known[kind] == shingles[near]
        hits, kind = near[hit], kind[hit]
        if len(hits) < self.shared[number]:
            return None

        starts = np.unique(np.concatenate([hits - (n - size), hits[hits + n > words]]))
        # A passage's shingles begin in [low, high); it is cut off at both ends of the document.
        low, high = np.maximum(starts, 0), np.minimum(starts + n, words) - size + 1
        low, high = low[low < high], high[low < high]
        most = np.minimum(np.searchsorted(hits, high) - np.searchsorted(hits, low), total)
        keep = most / (total + high - low - most) >= self.threshold
        low, high = low[keep], high[keep]
        if not len(low):
            return None
        both = np.zeros(len(low), np.int64)
        for k in np.unique(kind).tolist():
            own = hits[kind == k]
            both += np.minimum(np.searchsorted(own, high) - np.searchsorted(own, low), weights[int(known[k])])
        value = both / (total + high - low - both)
        top = int(np.argmax(value))
        found = float(value[top]), int(low[top]), int(high[top] - low[top]) + size - 1
        return found if value[top] >= self.threshold else None


def _passes(benchmark: DataFrame, item_column: str, text_column: str, pass_bytes: int) -> Iterator[list[tuple]]:
    """The items, collected in parts of about ``pass_bytes`` of text at most."""
    items = benchmark.select(F.col(item_column).alias("item"), F.col(text_column).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = -(-total // pass_bytes) or 1
    for number in range(passes):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == number) if passes > 1 else items
        yield sorted(((r.item, r.text) for r in own.collect()), key=str)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    pass_bytes: int = PASS_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """(document, item, start, n_words, similarity) of each item found in a document.

    The items of a pass are sent to every task; their bytes are bounded by
    ``pass_bytes`` (about), and a larger benchmark is searched in several passes.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    item_type = benchmark.schema[item_column].dataType.simpleString()
    item_kind = to_arrow_type(benchmark.schema[item_column].dataType)
    schema = f"{id_column} {id_type}, {item_column} {item_type}, start long, n_words long, similarity double"
    result = None
    for rows in _passes(benchmark, item_column, item_text_column, pass_bytes):
        given = docs.sparkSession.sparkContext.broadcast(rows)
        found = docs.select(id_column, text_column).mapInArrow(_search(given, item_kind, threshold, radius), schema)
        result = found if result is None else result.unionByName(found)
    return result


def _search(given, item_kind: pa.DataType, threshold: float, radius: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(given.value, radius, threshold)
        for batch in batches:
            take, rows = [], []
            for i, found in enumerate(index.matches(list(texts(batch, 1)))):
                for number, (value, start, length) in sorted(found.items()):
                    take.append(i)
                    rows.append((index.ids[number], start, length, value))
            item, start, size, value = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(take, pa.int64())),
                    pa.array(item, item_kind),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(value, pa.float64()),
                ],
                names=["document", "item", "start", "n_words", "similarity"],
            )

    return search


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    pass_bytes: int = PASS_BYTES,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns."""
    column = docs.columns.index(text_column)
    for rows in _passes(benchmark, item_column, item_text_column, pass_bytes):
        given = docs.sparkSession.sparkContext.broadcast(rows)
        docs = docs.mapInArrow(_clean(given, column, threshold, radius), docs.schema)
    return docs


def _clean(given, column: int, threshold: float, radius: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(given.value, radius, threshold)
        for batch in batches:
            found = index.matches(list(texts(batch, column)))
            yield batch.filter(pa.array([not own for own in found], pa.bool_()))

    return keep
