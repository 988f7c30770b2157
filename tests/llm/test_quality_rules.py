from __future__ import annotations

from collections import Counter

import numpy as np
from llm_cases import edge_rows, prose

from starloom.llm.quality_rules import BASE, FEATURES, cover, judge_quality, learn_rules, text_statistics


def brute(text):
    words = [w.decode() for w in (text or "").encode().split()]
    lines = [s for s in (text or "").split("\n") if s.encode().split()]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


ROWS = [
    *edge_rows(),
    (20, "a b c a b c a b"),
    (21, "l1 x\n\nl1 x\nl2\n \n \nl1 x"),
    (22, "#* <b>|& 100% $"),
    (23, prose(7, 3000, vocabulary=9)),
]


def test_counts_agree_with_brute_force(documents):
    got = text_statistics(documents(ROWS)).collect()
    key = lambda r: (r[0] is None, r[0], *r[1:])
    assert sorted(((r.doc_id, *(r[c] for c in BASE)) for r in got), key=key) == sorted(
        ((doc_id, *brute(text)) for doc_id, text in ROWS), key=key
    )
    assert all(r[f] is not None for r in got for f in FEATURES)
    assert text_statistics(documents([])).count() == 0


def test_rules_find_planted_conditions():
    own = np.random.default_rng(4)
    values = own.random((3000, len(FEATURES)))
    bad = (values[:, 1] > 0.8) & (values[:, 2] <= 0.4) | (values[:, 4] > 0.95)
    rules = cover(values, bad)
    assert 2 <= len(rules.rules) <= 5
    assert {c.feature for rule in rules.rules for c in rule} == {FEATURES[1], FEATURES[2], FEATURES[4]}


def test_learned_list_is_one_native_expression(spark, documents, plan):
    good = [(3000 + i, prose(i, 80)) for i in range(150)]
    junk = [(1000 + i, " ".join(f"{w}%%%" for w in prose(i, 80).split())) for i in range(150)]
    docs = documents(good + junk + edge_rows())
    labels = spark.createDataFrame(
        [(i, 1) for i, _ in good] + [(i, 0) for i, _ in junk] + [(0, None), (None, 0), (5, 1), (5, 1)],
        "doc_id long, quality int",
    )
    rules = learn_rules(docs, labels)
    judged = judge_quality(text_statistics(docs), rules)
    assert "Python" not in plan(judged) and "Arrow" not in plan(judged)
    rows = judged.collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk)
    assert not any(kept[i] for i in (1, 2, 3, 4, 12)) and len(rows) == docs.count()
    assert "reject if" in str(rules)


def test_without_both_classes_everything_passes(spark, documents):
    docs = documents([(1, prose(1, 60)), (2, "short")])
    for labels in ([], [(1, 1)], [(1, 0), (2, 0)]):
        rules = learn_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        kept = {r.doc_id: r.kept for r in judge_quality(text_statistics(docs), rules).collect()}
        assert kept == {1: True, 2: False}
