from __future__ import annotations

import random
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_cases import edge_rows, prose

from starloom.llm import near_dedup
from starloom.llm.components import connected_components
from starloom.llm.near_dedup import keep_one_each, near_duplicates


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components_agree_with_union_find(spark, links):
    edges = spark.createDataFrame([*links, (None, 3), (4, None)], "u long, v long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == groups({n for e in links for n in e}, links)


def test_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain + star, "u long, v long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(200)} == {1000}


def shingle_set(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, shingle_set(text)) for i, text in rows if i is not None]
    links = [
        (a, b)
        for (a, x), (b, y) in combinations(sets, 2)
        if x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    return groups({i for i, _ in sets}, links)


def near_copies(count, words, changes, seed):
    own = random.Random(seed)
    base = prose(seed, words, 5000).split()
    out = []
    for _ in range(count):
        text = list(base)
        for at in own.sample(range(words), own.randint(0, changes)):
            text[at] = f"v{own.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def check(documents, rows, **settings):
    got = near_duplicates(documents(rows), **settings).collect()
    wanted = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == wanted[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    sizes = {(i, len(shingle_set(t))) for i, t in rows}
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes


def test_edge_cases(documents):
    check(documents, [*edge_rows(), (40, "one two"), (41, "ONE\ttwo"), (42, "one two three")])
    assert near_duplicates(documents([])).count() == 0
    only_empty = near_duplicates(documents([(1, None), (2, "")])).collect()
    assert [(r.component_id, r.n_shingles, r.kept) for r in sorted(only_empty)] == [(1, 0, True), (2, 0, True)]


@pytest.mark.parametrize("block, sets, shingles", [(512, 512, 10**6), (8, 512, 10**6), (16, 3, 10**6), (512, 512, 300)])
def test_groups_around_the_threshold(documents, monkeypatch, block, sets, shingles):
    """Copies whose pairs lie on either side of 0.75, linked through others; also in small blocks."""
    for name, value in (("BLOCK", block), ("SETS", sets), ("SHINGLES", shingles)):
        monkeypatch.setattr(near_dedup, name, value)
    texts = near_copies(50, 120, 6, seed=1) + near_copies(25, 60, 4, seed=2) + [prose(i, 90, 5000) for i in range(50, 70)]
    random.Random(3).shuffle(texts)
    rows = list(enumerate(texts))
    assert 20 < len(set(brute(rows).values())) < 80
    check(documents, rows)


def test_one_row_of_each_group_stays(documents):
    rows = edge_rows()
    docs = documents(rows)
    left = keep_one_each(docs)
    assert left.columns == docs.columns
    wanted = brute(rows)
    assert sorted(r.doc_id or 0 for r in left.collect()) == sorted([0, *{i for i, c in wanted.items() if i == c}])


def test_unlike_texts_of_one_id_all_stay(documents):
    rows = [(3, prose(1, 50)), (3, prose(2, 50)), (3, prose(1, 50)), (7, prose(2, 50)), (8, prose(5, 50))]
    left = [(r.doc_id, r.text) for r in keep_one_each(documents(rows)).collect()]
    assert sorted(left) == sorted({(3, prose(1, 50)), (3, prose(2, 50)), (8, prose(5, 50))})


def test_signatures_lose_no_link_that_full_sets_hold(documents):
    """Every pair that shares a bucket verified: the same groups as with the signature's bound."""
    texts = near_copies(40, 80, 5, seed=11) + near_copies(20, 30, 2, seed=12)
    check(documents, list(enumerate(texts)), least_matches=0)


def test_a_class_that_most_rows_are_in(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "HOT", 4)
    rows = [(i, prose(1, 40)) for i in range(60)] + [(100 + i, prose(2, 40)) for i in range(3)] + [(200, prose(3, 40))]
    check(documents, rows)


def test_chunks_are_bounded_by_members_and_shingles():
    import numpy as np

    sizes = np.array([5, 3, 3, 20, 1, 1, 1, 1])
    cut = lambda: [c.tolist() for c in near_dedup._chunks(np.arange(8), sizes)]
    near_dedup_sets, near_dedup_shingles = near_dedup.SETS, near_dedup.SHINGLES
    try:
        near_dedup.SETS, near_dedup.SHINGLES = 3, 10
        assert cut() == [[0, 1], [2], [3], [4, 5, 6], [7]]
    finally:
        near_dedup.SETS, near_dedup.SHINGLES = near_dedup_sets, near_dedup_shingles
    assert list(near_dedup._chunks(np.zeros(0, int), sizes)) == []
