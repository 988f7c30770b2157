from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import edge_rows, prose

from starloom.llm.substring_dedup import Anchors, remove_repeats
from starloom.llm.words import WordHashes


def brute(rows, size):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        words = (rows[i][1] or "").encode().split()
        gone = set()
        for at in range(len(words) - size + 1):
            window = tuple(words[at : at + size])
            if window in seen:
                gone.update(range(at, at + size))
            seen.add(window)
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((rows[i][0], len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=120))
def test_an_anchor_is_seen_as_often_as_its_windows(words):
    own = Anchors(20)
    each, distinct = own.of(WordHashes().of(words))
    windows = [tuple(words[i : i + 20]) for i in range(max(0, len(words) - 19))]
    assert len(each) == len(windows)
    counts = {a: int((distinct == np.uint64(a)).sum()) for a in set(each.tolist())}
    for w, a in zip(windows, each.tolist(), strict=True):
        assert counts[a] >= windows.count(w)


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


@pytest.mark.parametrize(("chunk_bytes", "shard_bits", "group"), [(16 << 20, 24, 4_000_000), (900, 8, 50)])
def test_agrees_with_brute_force(documents, chunk_bytes, shard_bits, group):
    own = random.Random(1)
    passages = [prose(500 + i, 30) for i in range(5)]
    rows = edge_rows()
    for i in range(60):
        parts = [prose(own.randrange(10**6), own.randrange(40)) for _ in range(3)]
        parts.insert(own.randrange(3), own.choice(passages))
        rows.append((100 + own.randrange(50), " ".join(parts)))
    rows += [(200, prose(9, 10) + " " + "x y " * 40), (201, " ".join(["same"] * 300)), (202, "tail " + "x y " * 12)]
    got = remove_repeats(documents(rows), chunk_bytes=chunk_bytes, shard_bits=shard_bits, group_windows=group).collect()
    wanted = brute(rows, 20)
    # Rows with equal ids come in any order; their sum of removed words is fixed for equal texts only.
    unique = {i for i, _ in rows if sum(i == j for j, _ in rows) == 1}
    assert len(got) == len(wanted)
    assert sorted((tuple(r) for r in got if r[0] in unique), key=key) == sorted((r for r in wanted if r[0] in unique), key=key)
    same = lambda rows_: sorted((r[0], r[1], r[2]) for r in rows_ if r[0] == 5)
    assert same(got) == same(wanted)


def test_rows_keep_their_columns(documents):
    same = prose(1, 40)
    docs = documents([(1, f"a  {same}"), (2, f"b\n{same}\nc"), (3, None), (4, same)])
    left = remove_repeats(docs, rows=True)
    assert left.columns == docs.columns
    got = {r.doc_id: r for r in left.collect()}
    assert [got[i].text for i in (1, 2, 3, 4)] == [f"a  {same}", "b c", None, ""]
    assert got[2].chunk == docs.where("doc_id = 2").first().chunk
    assert remove_repeats(documents([])).count() == 0
