"""Toxicity by weak supervision.

Many voters look at a text: lexicon voters (a word, or a word beginning such as
``lowei-``, that is far more frequent in documents labelled toxic) and pattern
voters (nothing of the lexicon, several hits, shouting, repeated exclamation). A
generative label model estimates, without labels, how each voter votes on either
class and how far voters agree beyond their class; correlated voters share their
weight. A linear classifier over word features is then trained on the posterior
labels and scores every document.

A beginning also counts with the number of
different words that share it. The lexicon and the features come from a bounded sample of labelled rows
(``max_labelled``, by a hash of the id). Labels of other rows are not read.

Defined results: a null or empty text has no features and gets the classifier's
base rate. Without labelled rows of both classes every score is the share of toxic
labels (0 without labels). A document with several labels counts as toxic if one
says so. Repeated rows are each scored. Labels, language and source are never inputs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import texts
from starloom.scratch import materialise

#: Labelled rows learned from; features of the classifier; lexicon voters.
MAX_LABELLED = 16_000
MAX_FEATURES = 4_096
LEXICON = 192
MIN_DOCUMENTS = 4
#: Evidence for a feature; share of toxic documents among those with a lexicon entry;
#: correlation within the classes above which two voters depend on each other.
LEAST_Z = 3.0
PRECISION = 0.93
DEPENDENT = 0.5
BEGINNINGS = (4, 5, 6, 7)
PATTERNS = ("none", "several", "shouting", "exclaiming")
_PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_REMEMBERED = 300_000


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % parts


def words_of(text: bytes) -> set[bytes]:
    return set(text.decode("utf-8", "replace").lower().encode().translate(_PUNCTUATION).split())


def parts_of(word: bytes) -> list[str]:
    """The word and its beginnings (``xxxx-``)."""
    letters = word.decode("utf-8", "replace")
    return [letters, *(f"{letters[:n]}-" for n in BEGINNINGS if len(letters) > n)]


def features_of(text: bytes) -> list[str]:
    """Words and beginnings; a beginning of several words also with their number (up to 4)."""
    counts = Counter(part for word in words_of(text) for part in parts_of(word))
    return [*counts, *(f"{part}{n}" for part, k in counts.items() for n in range(2, min(k, 4) + 1))]


class FeatureIds(dict):
    """The parts of a word that belong to known features, remembered."""

    def __init__(self, ids: dict[str, int]) -> None:
        super().__init__()
        self.ids = ids
        self.parts = {f.rstrip("234") if f.rstrip("234").endswith("-") else f for f in ids}

    def __missing__(self, word: bytes) -> tuple[str, ...]:
        if len(self) >= _REMEMBERED:
            self.clear()
        found = self[word] = tuple(part for part in parts_of(word) if part in self.parts)
        return found

    def of(self, text: bytes) -> list[int]:
        counts = Counter(part for word in words_of(text) for part in self[word])
        named = [*counts, *(f"{part}{n}" for part, k in counts.items() for n in range(2, min(k, 4) + 1))]
        return sorted({self.ids[f] for f in named if f in self.ids})


@dataclass(frozen=True)
class ToxicityModel:
    """Features with weights; the score is the logistic of bias + their sum."""

    ids: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """(id, score) of every row."""
        id_type = docs.schema[id_column].dataType.simpleString()
        used = {f: i for f, i in self.ids.items() if self.weights[i]}
        given = docs.sparkSession.sparkContext.broadcast((used, self.weights, self.bias))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, weights, bias = given.value
            known = FeatureIds(ids)
            for batch in batches:
                sums = np.array([bias + weights[known.of(text)].sum() for text in texts(batch, 1)], np.float64)
                scores = pa.array(_logistic(sums))
                yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=[id_column, "score"])

        return docs.select(id_column, text_column).mapInArrow(run, f"{id_column} {id_type}, score double")

    def keep_clean(self, docs: DataFrame, threshold: float, *, text_column: str = "text") -> DataFrame:
        """The rows of ``docs`` that score below ``threshold``, with all their columns."""
        used = {f: i for f, i in self.ids.items() if self.weights[i]}
        given = docs.sparkSession.sparkContext.broadcast((used, self.weights, self.bias))
        column = docs.columns.index(text_column)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, weights, bias = given.value
            known = FeatureIds(ids)
            for batch in batches:
                sums = np.array([bias + weights[known.of(t)].sum() for t in texts(batch, column)], np.float64)
                yield batch.filter(pa.array(_logistic(sums) < threshold))

        return docs.mapInArrow(run, docs.schema)


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_column: str = "toxic",
    id_column: str = "doc_id",
    text_column: str = "text",
    max_labelled: int = MAX_LABELLED,
    max_features: int = MAX_FEATURES,
) -> ToxicityModel:
    """Learns from at most ``max_labelled`` rows of ``labels``; pass the training rows only."""
    given = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    given = given.groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).cast("int").alias("label"))
    chosen = given.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    named = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # At most max_labelled pairs of an id and a label are broadcast.
    found = named.join(F.broadcast(chosen), "id")
    # One row per id: of repeated ids the text with the smallest hash.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    found = found.groupBy("id", "label").agg(one).select("id", F.col("one.text").alias("text"), "label")
    sample = materialise(found, "toxicity-sample")
    sizes = {row.label: row["count"] for row in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        rate = toxic / max(1, toxic + clean)
        return ToxicityModel({}, np.zeros(0), float(np.log((rate + 1e-12) / (1 - rate + 1e-12))))

    counts = sample.select("label", "text").mapInArrow(_count, "feature string, clean long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = lambda a, n: (F.col(a) + 0.5) / (n + 1)
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    z = F.log(share("toxic", toxic) / share("clean", clean)) / spread
    ranked = counts.where(F.col("clean") + F.col("toxic") >= MIN_DOCUMENTS).withColumn("z", z)
    rows = ranked.where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(max_features).collect()
    ids = {row.feature: i for i, row in enumerate(rows)}
    lexicon = [i for i, row in enumerate(rows) if row.toxic >= PRECISION * (row.toxic + row.clean)][:LEXICON]

    seen = sample.select("id", "text").mapInArrow(_look(ids, lexicon), "id string, features array<int>, votes array<int>")
    seen = sorted(seen.collect(), key=lambda row: row.id)
    posterior = label_model(np.array([row.votes for row in seen], np.int8), toxic / (toxic + clean))
    weights, bias = train([row.features for row in seen], posterior, len(ids))
    return ToxicityModel(ids, weights, bias)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for label, text in zip(batch.column(0).to_pylist(), texts(batch, 1), strict=True):
            counts[label > 0].update(features_of(text))
        features = list(counts[0].keys() | counts[1].keys())
        arrays = [pa.array([c[f] for f in features], pa.int64()) for c in counts]
        yield pa.RecordBatch.from_arrays([pa.array(features, pa.string()), *arrays], names=["f", "clean", "toxic"])


def _look(ids: dict[str, int], lexicon: list[int]):
    """Features and votes of each text: 1 toxic, -1 clean, 0 abstains."""
    places = {i: k for k, i in enumerate(lexicon)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = FeatureIds(ids)
        for batch in batches:
            features, votes = [], []
            for text in texts(batch, 1):
                own = known.of(text)
                hits = [places[i] for i in own if i in places]
                vote = [0] * len(lexicon)
                for k in hits:
                    vote[k] = 1
                upper = len(text) - len(text.translate(None, _CAPITALS))
                vote += [0 if hits else -1, int(len(hits) > 2), int(upper > 0.2 * len(text)), int(text.count(b"!!") > 2)]
                features.append(own)
                votes.append(vote)
            names = batch.column(0).cast(pa.string())
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(features, kind), pa.array(votes, kind)], names=["id", "features", "votes"]
            )

    return look


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def label_model(votes: np.ndarray, balance: float, rounds: int = 25) -> np.ndarray:
    """Posterior of class 1 from votes by expectation maximisation.

    Each voter has a propensity to vote either way on either class; ``balance`` is
    the known share of class 1. A voter's weight is divided by one plus its
    correlations, within the classes, with the voters that depend on it, so voters
    that repeat each other do not add up. Voters are taken to be better than chance.
    """
    side = np.sign(votes.sum(0))
    alike = np.equal.outer(side, side)
    up, down = (votes == 1).astype(float), (votes == -1).astype(float)
    posterior = _logistic(2.0 * up.sum(1) - 4.0 * down.sum(1))
    for _ in range(rounds):
        mass = np.array([(1 - posterior).sum(), posterior.sum()]) + 2
        rates = {}
        for name, seen in (("up", up), ("down", down)):
            hit = np.stack([(1 - posterior) @ seen, posterior @ seen])
            rates[name] = (hit + 0.1) / mass[:, None]
        expected = np.outer(1 - posterior, rates["up"][0] - rates["down"][0])
        expected += np.outer(posterior, rates["up"][1] - rates["down"][1])
        rest = votes - expected
        scale = np.sqrt((rest**2).mean(0)) + 1e-9
        correlation = (rest.T @ rest) / len(rest) / np.outer(scale, scale)
        np.fill_diagonal(correlation, 0)
        share = 1 / (1 + np.where(alike & (correlation > DEPENDENT), correlation, 0).sum(1))
        odds = np.log(balance / (1 - balance))
        odds = odds + up @ (share * np.log(np.maximum(rates["up"][1] / rates["up"][0], 1.0)))
        odds = odds + down @ (share * np.log(np.minimum(rates["down"][1] / rates["down"][0], 1.0)))
        posterior = _logistic(odds)
    return posterior


def train(
    rows: list[list[int]], target: np.ndarray, size: int, *, rounds: int = 300, sparsity: float = 5e-5
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels with an L1 penalty, by accelerated proximal steps."""
    lengths = np.array([len(row) for row in rows])
    at = np.repeat(np.arange(len(rows)), lengths)
    feature = np.concatenate([np.asarray(row, np.int64) for row in rows] or [np.zeros(0, np.int64)])
    often = np.bincount(feature, minlength=size)
    scale = (np.maximum(often, 1) / max(1, len(rows))) ** -0.25  # rare features move faster
    values = scale[feature]
    ahead = np.ones(size)
    for _ in range(20):  # the largest curvature, by power iteration
        norm = np.sqrt((ahead**2).sum()) + 1e-12
        inner = np.bincount(at, weights=values * ahead[feature] / norm, minlength=len(rows))
        ahead = np.bincount(feature, weights=values * inner[at], minlength=size) / max(1, len(rows))
    step = 4 / (1.3 * np.sqrt((ahead**2).sum()) + 1)
    weights, bias = np.zeros(size), float(np.log((target.mean() + 1e-6) / (1 - target.mean() + 1e-6)))
    ahead, bias_ahead, pace = weights, bias, 1.0
    for _ in range(rounds):
        margin = bias_ahead + np.bincount(at, weights=values * ahead[feature], minlength=len(rows))
        error = (_logistic(margin) - target) / len(rows)
        slope = np.bincount(feature, weights=values * error[at], minlength=size)
        moved = ahead - step * slope
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * sparsity, 0)
        new_bias = bias_ahead - step * error.sum()
        new_pace = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = new + (pace - 1) / new_pace * (new - weights)
        bias_ahead = new_bias + (pace - 1) / new_pace * (new_bias - bias)
        weights, bias, pace = new, new_bias, new_pace
    return weights * scale, float(bias)
