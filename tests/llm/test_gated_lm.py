from __future__ import annotations

import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import edge_rows, prose

from starloom.llm import gated_lm
from starloom.llm.gated_lm import END, Network, Trainer, TokenIds, score_documents, score_texts


def test_scores_agree_with_counts(documents):
    rows = [*edge_rows(), *((100 + i, prose(i, 50, 60)) for i in range(40))]
    docs = documents(rows)
    training = docs.where("doc_id % 10 != 0")
    counts = Counter()
    for i, text in rows:
        if i is not None and i % 10:
            counts.update([*(text or "").encode().lower().split(), END])
    total, distinct = sum(counts.values()), len(counts)
    wanted = []
    for i, text in rows:
        tokens = [*(text or "").encode().lower().split(), END]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        wanted.append((i, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 5)))
    for known in (50_000, 30):
        got = score_texts(docs, training, known_words=known, frequent_words=20).collect()
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(
            ((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=key
        ) == sorted(wanted, key=key)
        assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_empty_tables(documents):
    docs = documents([(1, "a"), (2, None)])
    got = {r.doc_id: r for r in score_texts(docs, docs.limit(0)).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[2].n_tokens) == (2, 0, 0, 1)
    assert score_texts(documents([]), documents([])).count() == 0


def test_gradient_agrees_with_differences(monkeypatch):
    monkeypatch.setattr(gated_lm, "HIDDEN", 4)
    monkeypatch.setattr(gated_lm, "EMBEDDING", 3)
    monkeypatch.setattr(gated_lm, "CLASS", 3)
    monkeypatch.setattr(gated_lm, "TAIL", 4)
    own = np.random.default_rng(2)
    start = Network(7).flat.astype(np.float64)
    start += own.normal(0, 0.2, len(start))
    docs = [own.integers(0, 11, n).astype(np.int32) for n in (5, 9, 3)]
    trainer = Trainer(Network(7, start.copy()), 0.0)
    trainer.learn(docs, 0)
    count = sum(map(len, docs))
    exact = trainer.grad.flat / count
    loss = lambda flat: -score_documents(Network(7, flat), docs, 0).sum() / count
    for i in own.choice(len(start), 60, replace=False):
        up, down = start.copy(), start.copy()
        up[i] += 1e-3
        down[i] -= 1e-3
        assert exact[i] == pytest.approx((loss(up) - loss(down)) / 2e-3, abs=2e-3)


def test_probabilities_sum_to_one_and_state_crosses_windows():
    network = Network(100)
    every = np.arange(100 + gated_lm.TAIL, dtype=np.int32)
    long = np.arange(70, dtype=np.int32)
    for prefix in ([], [5, 3], long.tolist()):
        docs = [np.array([*prefix, t], np.int32) for t in every]
        before = score_documents(network, [np.array(prefix, np.int32)], 0)[0] if prefix else 0.0
        assert np.exp(score_documents(network, docs, 0) - before).sum() == pytest.approx(1, abs=1e-3)
    alone = [score_documents(network, [d], 0)[0] for d in (long, every[:30], long[::-1].copy())]
    together = score_documents(network, [long, every[:30], long[::-1].copy()], 0)
    assert together == pytest.approx(alone, rel=1e-4)


def test_training_beats_the_unigram():
    ids = TokenIds([END, *(b"w%d" % i for i in range(40))])
    texts = [[*(b"w%d" % ((s + k) % 40) for k in range(30)), END] for s in range(40)]
    docs = [ids.of(t) for t in texts * 20]
    network = Network(41, shares=np.bincount(np.concatenate(docs), minlength=41 + gated_lm.TAIL) / sum(map(len, docs)))
    before = score_documents(network, docs[:40], 0).sum()
    Trainer(network, 0.01).learn(docs, 0)
    assert score_documents(network, docs[:40], 0).sum() > 0.6 * before


def test_the_network_learns_from_every_training_row(documents, monkeypatch):
    # Half of the rows are copies of one text.
    docs = documents([*edge_rows(), *((100 + i, prose(i, 30)) for i in range(60)), *((200 + i, prose(7, 30)) for i in range(60))])
    rounds = []

    def averaged(replicas, inner=gated_lm._averaged):
        rounds.append(sum(r.tokens for r in replicas.select("tokens").collect()))
        return inner(replicas)

    monkeypatch.setattr(gated_lm, "_averaged", averaged)
    tokens = score_texts(docs, docs).first().train_tokens
    assert len(rounds) == gated_lm.ROUNDS and sum(rounds) == tokens
    rounds.clear()
    copies = docs.where("doc_id >= 200")
    score_texts(copies, copies).first()
    assert sum(rounds) == 60 * 31 and max(rounds) < 30 * 31


def test_a_text_of_a_million_words_takes_the_memory_of_its_tokens():
    docs = [np.arange(1_000_000, dtype=np.int32) % 50, *(np.arange(20, dtype=np.int32) for _ in range(255))]
    tracemalloc.start()
    lanes = gated_lm.Lanes(docs, 256)
    seen = np.zeros(len(docs), np.int64)
    for before, target, doc, first in lanes.windows(0):
        real = target >= 0
        assert (before[first] == 0).all() and (target[first] == 0).all()
        seen += np.bincount(doc[real], minlength=len(docs))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen.tolist() == [len(d) for d in docs]
    assert peak < 40 << 20


def test_lanes_hold_every_token_once_in_order():
    own = np.random.default_rng(5)
    docs = [own.integers(0, 90, n).astype(np.int32) for n in own.integers(1, 200, 60)]
    for count in (1, 7, 100):
        got = [[] for _ in docs]
        for before, target, doc, first in gated_lm.Lanes(docs, count).windows(91):
            for t, lane in zip(*np.nonzero(target >= 0), strict=True):
                d = doc[t, lane]
                assert before[t, lane] == (got[d][-1] if got[d] else 91) and first[t, lane] == (not got[d])
                got[d].append(target[t, lane])
        assert got == [d.tolist() for d in docs]
    assert list(gated_lm.Lanes([], 3).windows(0)) == []


def test_each_round_reads_its_own_rows_alone(documents, monkeypatch):
    docs = documents([(i, prose(i, 30)) for i in range(200)])
    plans = []

    def averaged(replicas, inner=gated_lm._averaged):
        plans.append(replicas._jdf.queryExecution().executedPlan().toString())
        return inner(replicas)

    monkeypatch.setattr(gated_lm, "_averaged", averaged)
    score_texts(docs, docs)
    assert len(plans) == gated_lm.ROUNDS
    assert all(re.search(rf"PartitionFilters: \[[^\]]*slice#\d+L? = {k}\)", plan) for k, plan in enumerate(plans))


def test_words_are_those_of_python():
    texts = [None, "", "  ", "A b", "\tÉ Z\x0b\x0cz\x1cY\u00a0x \r\n", "x" * 70_000, "a\x85b\u2003C"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    for part, wanted in ((batch, texts), (batch.slice(3, 3), texts[3:6])):
        words, owner = gated_lm._words(part, 0)
        split = [(t or "").encode().lower().split() for t in wanted]
        assert words.to_pylist() == [w for ws in split for w in ws]
        assert owner.tolist() == [i for i, ws in enumerate(split) for _ in ws]


def test_exponentials_beyond_the_range_of_floats():
    network = Network(100)
    docs = [np.arange(60, dtype=np.int32)]
    plain = score_documents(network, docs, 0)
    network.p["class_bias"] += 200
    network.p["word_bias"] -= 200
    assert score_documents(network, docs, 0) == pytest.approx(plain, rel=1e-4)
