from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import edge_rows, prose
from tokenizers import Tokenizer

from starloom.llm import packing
from starloom.llm.packing import Packing, pack, tokenize

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return open(FILE, encoding="utf-8").read()


def check_places(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_ids_are_those_of_whole_texts(documents, tokenizer):
    rows = edge_rows() + [(30, "It's 12 o'clock!! <|endoftext|> ÀÉ x  don't’s")]
    encoder = Tokenizer.from_file(str(FILE))
    wanted = []
    for doc_id, text in rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096]
            wanted.append((doc_id, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), own))
    got = tokenize(documents(rows), tokenizer, ids=True).collect()
    key = lambda r: (r[0] is None, *(r[0] or 0, *r[1:5]))
    assert sorted(map(tuple, got), key=key) == sorted(wanted, key=key)
    packed = pack(tokenize(documents(rows), tokenizer)).collect()
    assert len(packed) == len(wanted)
    check_places(packed, 4096)


@pytest.mark.parametrize("mark", [b"~", b"the", b"~~~~~~~~~unlike", b"<|endoftext|>"])
def test_joined_words_have_the_ids_of_single_ones(monkeypatch, mark):
    monkeypatch.setattr(packing, "_MARK", mark)
    monkeypatch.setattr(packing, "_JOINED", 7)
    encoder = Tokenizer.from_file(str(FILE))
    words = {w for _, text in edge_rows() for w in (text or "").encode().split()}
    words |= {w.encode() for w in ("~", "a~", "~~", "\u00a0", "\u0301x", "e\u0301", "\uff5e", "<|endoftext|>", "x<|endoftext|>y", "The", "don't")}
    words |= set(prose(3, 200).encode().split())
    found = dict(packing._encoded(encoder, sorted(words)))
    wanted = {w: np.array(encoder.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes() for w in words}
    assert found == wanted


@pytest.mark.parametrize("pool", [40, 1000])
def test_packing_is_near_the_bound(spark, pool):
    own = np.random.default_rng(1)
    sizes = [*own.integers(1, 100, 600).tolist(), *[100] * 20]
    pieces = spark.createDataFrame([(i, n, "x", i) for i, n in enumerate(sizes)], "doc_id long, length long, pool string, offset long")
    rows = pack(pieces, capacity=100, pool=pool).collect()
    assert sorted(r.doc_id for r in rows) == list(range(620))
    used = check_places(rows, 100)
    assert used <= -(-sum(sizes) // 100) * 1.05


def test_a_worker_forgets_most_words_after_a_task(spark, documents, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED", 300, raising=False)
    monkeypatch.setattr(packing, "_KEPT", 100, raising=False)
    rows = [(i, prose(i, 300) + f" only{i}") for i in range(40)]
    encoder = Tokenizer.from_file(str(FILE))
    wanted = {i: [*encoder.encode(text, add_special_tokens=False).ids, 1] for i, text in rows}
    # Other text of the same tokenizer, so that the workers begin without words.
    own = tokenizer + "\n"
    assert {r.doc_id: r.ids for r in tokenize(documents(rows), own, ids=True).collect()} == wanted

    def remembered(batches):
        import tokenizers

        for batch in batches:
            sizes = [len(memory) for _, memory in vars(tokenizers).get("_starloom_held", {}).values()]
            yield pa.RecordBatch.from_pydict({"n": pa.array([max(sizes, default=0)] * batch.num_rows, pa.int64())})

    found = [r.n for r in spark.range(0, 32, 1, 8).mapInArrow(remembered, "n long").collect()]
    assert 0 < max(found) <= 100


def test_empty_table(documents, tokenizer):
    assert pack(tokenize(documents([]), tokenizer)).count() == 0


def test_operators_keep_every_piece_and_whole_bins():
    lengths = sorted((int(x) for x in np.random.default_rng(2).integers(1, 90, 300)), reverse=True)
    problem = Packing(lengths, 100, seed=3)
    first, second = problem.fit([], list(range(300))), problem.disturbed()
    for child in (problem.crossover(first, second), problem.mutate(first), problem.evolve([second])[0]):
        assert sorted(i for b in child for i in b) == list(range(300))
        assert max(problem.fill(b) for b in child) <= 100
    assert problem.worth(problem.evolve([first])[0]) >= problem.worth(first)
    whole = {frozenset(b) for b in second}
    assert sum(frozenset(b) in whole for b in problem.crossover(first, second)) >= len(second) // 8
