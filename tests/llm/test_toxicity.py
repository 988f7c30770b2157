from __future__ import annotations

import numpy as np
from llm_cases import edge_rows, prose

from starloom.llm.toxicity import label_model, learn_toxicity

INSULTS = ("blorgish", "snarfle", "grunkus", "quazzle")


def corpus():
    clean = [(i, prose(i, 60)) for i in range(300)]
    toxic = [(1000 + i, f"{prose(i, 30)} {INSULTS[i % 4]}! {prose(i + 1, 30)} {INSULTS[(i + 1) % 4].upper()}") for i in range(60)]
    stems = [(2000 + i, f"{prose(i, 40)} zorkel{i % 7}a and zorkel{i % 5}b") for i in range(60)]
    return clean, toxic + stems


def test_held_out_texts_are_told_apart(spark, documents):
    clean, toxic = corpus()
    docs = documents(clean + toxic + edge_rows())
    labels = [(i, 0) for i, _ in clean] + [(i, 1) for i, _ in toxic]
    labels = spark.createDataFrame([r for r in labels if r[0] % 3] + [(5, None), (None, 1), (1, 0), (1, 0)], "doc_id long, toxic int")
    model = learn_toxicity(docs, labels)
    rows = model.score(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    held = [i for i, _ in toxic if i % 3 == 0]
    assert np.mean([scores[i] >= 0.3 for i in held]) > 0.95
    assert np.mean([scores[i] >= 0.3 for i, _ in clean]) < 0.02
    assert scores[1] == scores[2] < 0.3
    left = model.keep_clean(docs, 0.3)
    assert left.columns == docs.columns
    assert left.count() == sum(r.score < 0.3 for r in rows)


def test_without_labels_the_score_is_the_base_rate(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    for labels, rate in (([], 0), ([(1, 1)], 1), ([(1, 0), (2, 0)], 0)):
        model = learn_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert all(abs(r.score - rate) < 1e-9 for r in model.score(docs).collect())
    assert model.score(documents([])).count() == 0


def test_repeated_voters_count_once():
    own = np.random.default_rng(1)
    truth = own.random(4000) < 0.2
    votes = [np.where(own.random(4000) < 0.8, truth, ~truth) for _ in range(3)]
    columns = [2 * v.astype(np.int8) - 1 for v in votes]
    alone = label_model(np.stack(columns, 1), 0.2)
    repeated = label_model(np.stack([columns[0]] * 8 + columns[1:], 1), 0.2)
    assert ((alone > 0.5) == truth).mean() > 0.85
    assert ((repeated > 0.5) == truth).mean() > 0.8
