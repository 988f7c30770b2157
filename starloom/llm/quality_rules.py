"""Learned decision lists of threshold conjunctions, as Spark expressions.

Everything that touches documents is a DataFrame expression. Statistics of the
labelled rows are learned from by sequential covering: a rule for the bad class
grows by the condition with the best information gain on two thirds of the rows,
is pruned on the last third by dropping final conditions while that raises its
worth there, and removes the rows it covers; rules that are not right more often
than ``min_precision`` on rows they were not grown on end the list. The list is
emitted as one ordered ``CASE``.

Defined results: a null, empty or blank text has no words, so all counts are 0.
Without labelled rows of both classes the list is empty and keeps everything.
A document with several labels counts once, with the lowest. Repeated documents
are each judged. Only id, text and label columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Labelled rows the list is learned from, chosen by a hash of their id.
MAX_LABELLED = 12_000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "n_words",
    "mean_word",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "stop_share",
)


def text_statistics(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The identifier with the counts in ``BASE`` and the shares in ``FEATURES``.

    A repeated window is found by sorting a text's windows by two hashes of their
    three words: equal neighbours are repeats, and the words they cover are counted
    from the gaps between their positions. Nothing is exploded or shuffled.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    named = docs.select(F.col(id_column), text.alias("text"))
    words = F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda s: s.rlike(rf"[^\x20\x09-\x0D]"))
    held = F.translate("text", BLANKS, "")
    counted = named.select(
        id_column,
        words.alias("words"),
        lines.alias("lines"),
        F.length(held).alias("word_chars"),
        F.length(F.translate("text", SYMBOLS, "")).alias("other"),
        F.length("text").alias("chars"),
        F.length(F.regexp_replace("text", "[A-Z]", "")).alias("no_upper"),
        F.length(F.regexp_replace("text", "[0-9]", "")).alias("no_digit"),
    )
    size = F.size("words")
    windows = F.when(
        size >= 3,
        F.transform(
            F.sequence(F.lit(0), size - 3),
            lambda i: F.struct(_hash("xxhash64", i).alias("h"), _hash("hash", i).alias("g"), i.alias("p")),
        ),
    ).otherwise(F.expr("array()").cast("array<struct<h:bigint,g:int,p:int>>"))
    sorted_ = counted.select("*", F.sort_array(windows).alias("windows"))
    same = lambda a, b: (a["h"] == b["h"]) & (a["g"] == b["g"])
    at = lambda i: F.get("windows", i)
    repeated = F.filter(
        "windows",
        lambda x, i: F.coalesce(same(at(i - 1), x), F.lit(False)) | F.coalesce(same(at(i + 1), x), F.lit(False)),
    )
    places = sorted_.select("*", F.sort_array(F.transform(repeated, lambda x: x["p"])).alias("places"))
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    counts = places.select(
        id_column,
        size.cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        (F.col("chars") - F.col("other")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").alias("lines"),
        (F.col("chars") - F.col("no_upper")).alias("upper"),
        (F.col("chars") - F.col("no_digit")).alias("digit"),
        F.size(F.filter("words", lambda w: F.length(w) <= 3)).alias("short"),
    )
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)).cast("double")
    return counts.select(
        id_column,
        *BASE,
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("upper", "word_chars").alias("upper_share"),
        share("digit", "word_chars").alias("digit_share"),
        share("short", "n_words").alias("stop_share"),
    )


def _hash(function: str, i: Column) -> Column:
    return getattr(F, function)(*(F.get("words", i + k) for k in range(3)))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


class DecisionList:
    """Ordered rules; the first whose conditions all hold rejects the document."""

    def __init__(self, rules: list[tuple[Condition, ...]]) -> None:
        self.rules = rules

    def column(self) -> Column:
        """True to keep: an ordered CASE over the rules."""
        verdict = None
        for rule in self.rules:
            test = rule[0].column()
            for condition in rule[1:]:
                test = test & condition.column()
            verdict = F.when(test, False) if verdict is None else verdict.when(test, False)
        return F.lit(True) if verdict is None else verdict.otherwise(True)

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, rule)) for rule in self.rules)


def learn_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_column: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    max_labelled: int = MAX_LABELLED,
    **settings,
) -> DecisionList:
    """A list that rejects label 0, learned from at most ``max_labelled`` labelled rows."""
    labelled = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    labelled = labelled.groupBy(id_column).agg(F.min(label_column).alias("label"))
    chosen = labelled.orderBy(F.xxhash64(id_column), id_column).limit(max_labelled)
    # At most max_labelled pairs of an id and a label.
    found = docs.select(id_column, text_column).join(F.broadcast(chosen), id_column)
    # One row per id: of repeated ids the text with the smallest hash.
    one = F.min(F.struct(F.xxhash64(text_column).alias("hash"), F.col(text_column).alias("text"))).alias("one")
    found = found.groupBy(id_column, "label").agg(one)
    carried = found.select(F.struct(id_column, "label").alias("key"), F.col("one.text").alias("text"))
    rows = text_statistics(carried, id_column="key", text_column="text").select("key.*", *FEATURES).collect()
    rows = sorted(rows, key=lambda r: r[0])
    values = np.array([[r[f] for f in FEATURES] for r in rows], float).reshape(-1, len(FEATURES))
    return cover(values, np.array([r["label"] == 0 for r in rows], bool), **settings)


def cover(
    values: np.ndarray,
    bad: np.ndarray,
    *,
    names: tuple[str, ...] = FEATURES,
    max_rules: int = 12,
    max_conditions: int = 4,
    min_precision: float = 0.9,
    min_covered: int = 5,
) -> DecisionList:
    """Sequential covering: grow, prune, keep, remove what is covered, repeat."""
    rules: list[tuple[Condition, ...]] = []
    fold = np.arange(len(bad)) % 3
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        grow, prune = left & (fold != 2), left & (fold == 2)
        rule = _grow(values, bad, grow, names, max_conditions)
        best, worth = None, -1.0
        for size in range(len(rule), 0, -1):
            held = prune & _covered(values, rule[:size], names)
            good, wrong = (held & bad).sum(), (held & ~bad).sum()
            if good + wrong and (good - wrong) / (good + wrong) >= worth:
                best, worth = rule[:size], (good - wrong) / (good + wrong)
        if best is None:
            break
        held = prune & _covered(values, best, names)
        if (held & bad).sum() < min_precision * held.sum() or held.sum() < min_covered:
            break
        rules.append(tuple(best))
        left &= ~_covered(values, best, names)
    return DecisionList(rules)


def _covered(values: np.ndarray, rule: list[Condition], names: tuple[str, ...]) -> np.ndarray:
    held = np.ones(len(values), bool)
    for c in rule:
        column = values[:, names.index(c.feature)]
        held &= column > c.threshold if c.above else column <= c.threshold
    return held


def _grow(
    values: np.ndarray, bad: np.ndarray, rows: np.ndarray, names: tuple[str, ...], most: int
) -> list[Condition]:
    """Adds the condition of best gain until only bad rows are covered."""
    rule: list[Condition] = []
    held = rows.copy()
    while len(rule) < most and (held & bad).any() and (held & ~bad).any():
        before = log2((held & bad).sum() / held.sum())
        best: tuple[float, Condition] | None = None
        for j, name in enumerate(names):
            order = np.argsort(values[held, j], kind="stable")
            column, hit = values[held, j][order], bad[held][order]
            ends = np.flatnonzero(column[1:] > column[:-1])
            up = np.cumsum(hit)
            for above in (False, True):
                p = up[-1] - up[ends] if above else up[ends]
                n = (len(hit) - 1 - ends if above else ends + 1).astype(float)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / n) - before), 0.0)
                if len(gain) and (k := int(gain.argmax())) >= 0 and gain[k] > (best[0] if best else 1e-9):
                    middle = float((column[ends[k]] + column[ends[k] + 1]) / 2)
                    best = (float(gain[k]), Condition(name, above, middle))
        if best is None:
            break
        rule.append(best[1])
        held &= _covered(values, [best[1]], names)
    return rule


def judge_quality(statistics: DataFrame, rules: DecisionList, *, id_column: str = "doc_id") -> DataFrame:
    """The id, the counts in ``BASE``, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = statistics.select(id_column, *BASE, failed.alias("base_failed"), rules.column().alias("passes"))
    kept = ~F.col("base_failed") & F.col("passes")
    return judged.select(id_column, *BASE, "base_failed", kept.alias("kept"))
