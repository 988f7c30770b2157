from __future__ import annotations

import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import edge_rows, prose

from starloom.llm.decontamination import HammingIndex, ItemIndex, drop_contaminated, find_contamination


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 14))
def test_blocks_find_every_fingerprint_in_the_radius(seed, radius):
    own = np.random.default_rng(seed)
    prints = own.integers(0, 2**64, 60, dtype=np.uint64)
    queries = prints[own.integers(0, 60, 40)].copy()
    for k in range(40):
        for bit in own.integers(0, 64, own.integers(0, 20)):
            queries[k] ^= np.uint64(1) << np.uint64(bit)
    q, e = HammingIndex(prints, radius).search(queries)
    near = np.bitwise_count(queries[:, None] ^ prints[None, :]) <= radius
    assert set(zip(q.tolist(), e.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def tables(spark, documents, passes=False):
    items = [(i, prose(100 + i, n)) for i, n in enumerate((3, 7, 9, 12, 16, 23, 40, 59, 150))] + [(50, None), (51, ""), (52, prose(106, 40))]
    benchmark = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, similarity string")
    rows = edge_rows()
    for i, text in items[:9]:
        for shift in range(6):
            rows.append((1000 + 10 * i + shift, f"{prose(i, 100 + shift)} {text.upper()}\n{prose(i + 1, 50)}"))
    changed = items[6][1].split()
    changed[19] = "other"
    rows.append((2000, f"{prose(8, 70)} {' '.join(changed)} {prose(9, 70)}"))
    rows.append((2001, f"{prose(8, 70)} {' '.join(items[7][1].split()[:20])} {prose(9, 70)}"))
    return documents(rows), benchmark, items


def test_copies_at_any_place_are_found_and_parts_are_not(spark, documents):
    docs, benchmark, items = tables(spark, documents)
    got = {(r.doc_id, r.item_id): r for r in find_contamination(docs, benchmark).collect()}
    wanted = {(1000 + 10 * i + s, i) for i in range(9) for s in range(6)}
    wanted |= {(d, 52) for d, i in wanted if i == 6} | {(2000, 6), (2000, 52)}
    assert set(got) == wanted
    assert got[1043, 4].start == 103 and got[1043, 4].similarity == 1.0
    assert 0.75 <= got[2000, 6].similarity < 1
    several = find_contamination(docs, benchmark, pass_bytes=300)
    assert {(r.doc_id, r.item_id) for r in several.collect()} == wanted


def test_rows_without_an_item_stay_with_all_columns(spark, documents):
    docs, benchmark, _ = tables(spark, documents)
    left = drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == sorted(r[0] or 0 for r in [*edge_rows(), (2001, "")])
    assert drop_contaminated(docs.limit(0), benchmark).count() == 0
    assert find_contamination(docs, benchmark.limit(0)).count() == 0


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a, b):
    both = (a & b).total()
    return both / (a.total() + b.total() - both)


def changed_runs(words, own):
    """Copies with one run, or two, of replaced, inserted or deleted words."""
    for k in range(1, 1 + max(1, len(words) // 9)):
        at = own.randrange(1, max(2, len(words) - k))
        new = [f"new{own.randrange(9)}" for _ in range(k)]
        yield words[:at] + new + words[at + k :]
        yield words[:at] + new + words[at:]
        yield words[:at] + words[at + k :]
        yield [*words[:at], "new", *words[at + 1 : -2], "new", words[-1]]


def test_recall_of_changed_passages_against_brute_force(spark, documents):
    own = random.Random(4)
    items = [(i, prose(700 + i, n)) for i, n in enumerate((5, 8, 15, 22, 30, 41, 59, 80, 100, 100, 130))]
    items.append((90, "a b " * 20))
    rows = []
    for i, text in items:
        for k, copy in enumerate(changed_runs(text.split(), own)):
            left, right = prose(own.randrange(10**6), 60 + k % 5).split(), prose(own.randrange(10**6), 60).split()
            rows.append((1000 * (i + 1) + k, " ".join(left + copy + right)))
    wanted = {}
    for i, text in items:
        n, weights = len(text.split()), shingles(text.split())
        for d, document in rows:
            words = document.split()
            if d // 1000 == i + 1:
                every = [(similarity(weights, shingles(words[s : s + n])), -s) for s in range(len(words) - n + 1)]
                if max(every)[0] >= 0.75:
                    wanted[d, i] = max(every)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, -r.start) for r in find_contamination(documents(rows), benchmark).collect()}
    # Nothing but passages at the threshold, each the best one; at least 0.9 of them (0.99 when written).
    assert len(wanted) > 100 and len(got) >= 0.9 * len(wanted)
    assert got.items() <= wanted.items()


def test_items_with_words_missing_are_found_as_whole_documents_and_at_both_ends(spark, documents):
    items = [(i, prose(800 + i, n)) for i, n in enumerate((6, 15, 24, 33, 47, 59, 100))]
    rows = []
    for i, text in items:
        words, n = text.split(), len(text.split())
        copies = [words, words[:-1], words[1:], words[:-3], words[3:], words[: n // 2] + words[n // 2 + 1 :], words[: n - n // 8], words[: n // 2]]
        for k, copy in enumerate(copies):
            before, after = prose(900 + i, 40 + k).split(), prose(950 + i, 40 + k).split()
            for place, document in enumerate((copy, copy + after, before + copy)):
                rows.append((1000 * i + 10 * k + place, " ".join(document)))
    wanted = {}
    for d, document in rows:
        i, words = d // 1000, document.split()
        n, weights = len(items[i][1].split()), shingles(items[i][1].split())
        ends = [(max(0, s), min(len(words), s + n)) for s in range(1 - n, len(words))]
        value, start = max((similarity(weights, shingles(words[a:b])), -a) for a, b in ends)
        if value >= 0.75:
            wanted[d, i] = value, start
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in find_contamination(documents(rows), benchmark).collect()}
    assert len(wanted) > 80
    assert {key: (r.similarity, -r.start) for key, r in got.items()} == wanted
    texts = dict(rows)
    for (d, i), r in got.items():
        passage = texts[d].split()[r.start : r.start + r.n_words]
        assert len(passage) == r.n_words and similarity(shingles(items[i][1].split()), shingles(passage)) == r.similarity
    # The item without its last three words, as a whole document.
    assert (got[3030, 3].start, got[3030, 3].n_words) == (0, 30)
    assert {r.doc_id for r in drop_contaminated(documents(rows), benchmark).collect()} == {d for d, _ in rows} - {d for d, _ in wanted}


def test_candidates_come_from_fingerprints_alone():
    items = [(i, prose(600 + i, 30 + i)) for i in range(8)]
    document = " ".join(text for _, text in items).encode()
    index = ItemIndex(items)
    assert set(index.matches([document])[0]) == set(range(8))
    index.groups = [(*group[:2], HammingIndex(group[2].prints[:0], 11), group[3][:0]) for group in index.groups]
    assert index.matches([document]) == [{}]


def test_items_are_found_wherever_a_very_long_text_is_cut_into_pieces():
    items = [(i, prose(650 + i, n)) for i, n in enumerate((14, 33, 59, 200))]
    words = prose(1, 140_000, 5000).split()
    places = [32_768 * k + shift for k in (1, 2, 3) for shift in (-170, -31, -1)]
    for number, (_, text) in enumerate(items):
        for place in places:
            own = list(words)
            own[place : place + len(text.split())] = text.split()
            found = ItemIndex(items[number : number + 1]).matches([b"short text", " ".join(own).encode(), b"", b"end"])
            assert found == [{}, {0: (1.0, place, len(text.split()))}, {}, {}]


def test_items_with_one_window_size_keep_their_own_lengths():
    items = [(n, prose(n, n)) for n in range(1, 130)]
    index = ItemIndex(items)
    assert len(index.groups) < 40
    got = index.matches([f"{prose(7000 + n, n % 23)} {text} tail of text".encode() for n, text in items])
    for k, (n, _) in enumerate(items):
        assert got[k][k] == (1.0, n % 23 if n > 4 else got[k][k][1], n)
