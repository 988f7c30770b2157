from __future__ import annotations

import random

from llm_cases import edge_rows
from starloom.llm.token_counts import UNKNOWN, Trie, count_tokens

PIECES = {"▁": -3.0, "▁a": -2.0, "a": -2.5, "b": -2.0, "ab": -3.0, "ba": -3.5, "abb": -4.0, "▁ab": -2.5, "w": -1.0} | {
    str(i): -1.5 for i in range(10)
}


def brute(word):
    """Best segmentation by trying all: largest score, then shortest last pieces."""
    text = "▁" + word
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        ways = [
            (best[end - n][0] + PIECES[text[end - n : end]], -n, best[end - n][1] + 1)
            for n in range(1, end + 1)
            if text[end - n : end] in PIECES
        ]
        if ways:
            score, _, count = max(ways)
            best.append((score, count))
        else:
            best.append((best[-1][0] + UNKNOWN, best[-1][1] + len(text[end - 1].encode())))
    return best[-1][::-1]


def test_trie_agrees_with_brute_force_also_when_it_starts_anew():
    own = random.Random(3)
    words = ["".join(own.choices("abcé", k=own.randint(1, 9))) for _ in range(800)]
    for limit in (40, 10**6):
        trie = Trie(PIECES, limit)
        assert [trie(w.encode()) for w in words] == [brute(w) for w in words]


def test_shared_prefixes_are_computed_once():
    trie = Trie(PIECES)
    trie(b"abab")
    before = len(trie.score)
    trie(b"aba")
    assert len(trie.score) == before
    trie(b"ababb")
    assert len(trie.score) == before + 1


def test_documents(documents):
    rows = edge_rows()
    got = count_tokens(documents(rows), PIECES).collect()
    wanted = []
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        counts = [brute(w) for w in words[:100_000]] if "x" * 99 not in (text or "") else [Trie(PIECES)(text.encode())]
        wanted.append((doc_id, len(words), sum(c for c, _ in counts)))
    key = lambda r: (r[0] is None, r[0], r[2])
    assert sorted(((r.doc_id, r.n_pretokens, r.n_tokens) for r in got), key=key) == sorted(wanted, key=key)
    assert count_tokens(documents([]), PIECES).count() == 0
