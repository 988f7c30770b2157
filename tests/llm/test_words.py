from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm.words import WordHashes, Windows, shingles


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(1, 6))
def test_equal_windows_have_equal_hashes_and_others_do_not(words, size):
    found = Windows(size).of(WordHashes().of(words)).tolist()
    wanted = [tuple(words[i : i + size]) for i in range(max(0, len(words) - size + 1))]
    assert len(found) == len(wanted)
    assert len(set(zip(found, wanted, strict=True))) == len(set(found)) == len(set(wanted))


def test_short_texts_are_one_shingle_and_empty_ones_none():
    hashes, windows = WordHashes(), Windows(5)
    short = shingles(hashes.of([b"a", b"b"]), 5, windows)
    assert len(short) == 1
    assert short != shingles(hashes.of([b"a", b"b", b"c"]), 5, windows)
    assert len(shingles(np.zeros(0, np.uint64), 5, windows)) == 0


def test_full_memory_does_not_change_hashes(monkeypatch):
    monkeypatch.setattr("starloom.llm.words._CACHE", 3)
    words = [b"%d" % (i % 7) for i in range(50)]
    assert WordHashes().of(words).tolist() == [WordHashes()[w] for w in words]
