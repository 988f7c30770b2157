"""Hard negatives against a brute-force version in whole numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import CLASHING
from pyspark.sql import functions as F

from starloom.llm.hard_negatives import Best, Packing, mine_hard_negatives, quantised

NAN, INF = float("nan"), float("inf")


def brute(rows, every=10, positives=5, negatives=5, share=80):
    """rows: (id, label, vector) -> sorted (anchor, positive, rank, negative, scores)."""
    one = {}
    for i, label, vector in rows:
        if None in (i, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        one[i] = min(one.get(i, (label, vector)), (label, vector))
    width = max((len(v) for _, v in one.values()), default=0)
    whole = {i: (label, [math.floor(256 * x) for x in v] + [0] * (width - len(v))) for i, (label, v) in one.items()}
    out = []
    for anchor, (label, vector) in whole.items():
        if anchor % every:
            continue
        scored = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(vector, v)))), i, lab == label) for i, (lab, v) in whole.items() if i != anchor)
        for s, positive, _ in [x for x in scored if x[2]][:positives]:
            hard = [x for x in scored if not x[2] and share * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(anchor, positive, k + 1, x[1], -s, -x[0]) for k, x in enumerate(hard)]
    return sorted(out)


@pytest.fixture
def vectors(spark):
    def make(rows):
        extra = ", ".join(f"{name} string" for name in CLASHING if name not in ("id", "label"))
        clash = [name for name in CLASHING if name not in ("id", "label")]
        kind = f"vec_id long, label int, embedding array<float>, {extra}, vector string"
        return spark.createDataFrame([(*r, *["x"] * len(clash), "y") for r in rows], kind).repartition(5)

    return make


def mined(frame, every=10, **settings):
    got = mine_hard_negatives(frame, F.col("id") % every == 0, **settings)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in got.collect())


def random_rows(seed, n, width, scale=0.5, labels=3):
    own = random.Random(seed)
    return [(i, own.randrange(labels), [float(np.float32(own.gauss(0.2, scale))) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("scale", [0.5, 20.0, 1e5, 1e12])
def test_equals_brute_force(vectors, scale):
    """Wide numbers of 53 bits, of 64, and of any length."""
    rows = random_rows(3, 200, 8, scale)
    wanted = brute(rows)
    assert wanted and mined(vectors(rows)) == wanted


def test_blocks_of_anchors_make_no_difference(vectors):
    rows = random_rows(4, 300, 6, labels=2)
    assert mined(vectors(rows), 3, block=7) == mined(vectors(rows), 3) == brute(rows, 3)


def test_ties_and_a_vector_that_a_third_holds(vectors):
    same = [0.5, 0.25, 0.0, 0.5]
    rows = random_rows(5, 120, 4) + [(200 + i, i % 3, same) for i in range(90)]
    assert mined(vectors(rows)) == brute(rows)


def test_edges(vectors):
    rows = random_rows(6, 60, 4)
    rows += [(None, 1, [0.5] * 4), (100, None, [0.5] * 4), (101, 1, None), (102, 1, [0.5, None, 0.5, 0.5])]
    rows += [(103, 0, [NAN, 0.5, 0.5, 0.5]), (104, 0, [INF, 0.5, 0.5, 0.5]), (110, 2, [-INF, 0.0, 0.0, 0.0])]
    rows += [(105, 0, []), (106, 1, [0.5]), (120, 2, [0.5, 0.5]), (120, 1, [0.25, 0.5]), (120, 1, [0.25, 0.5])]
    rows += [(130, 7, [0.5] * 4), (140, 8, [-0.5] * 4), (141, 8, [0.5] * 4), (-10, 1, [0.3] * 4)]
    assert mined(vectors(rows)) == brute(rows)


def test_nothing_to_find(vectors):
    rows = random_rows(7, 30, 3)
    assert mined(vectors(rows).limit(0)) == []
    assert mined(vectors(rows[1:9])) == []
    assert mined(vectors([(0, 1, [1.0]), (1, 2, [1.0])])) == []
    assert mined(vectors([(i, i % 2, []) for i in range(20)])) == brute([(i, i % 2, []) for i in range(20)])


@pytest.mark.parametrize("limit, kind, fields", [(128, np.float64, 2), (6, np.float64, 3), (2500, np.uint64, 2), (10**7, object, 4)])
def test_packed_products_are_exact(limit, kind, fields):
    rng = np.random.default_rng(limit)
    packing = Packing(64, limit)
    assert (packing.kind, packing.fields) == (kind, fields)
    a, c = (rng.integers(-limit, limit + 1, (n, 64)).astype(float) for n in (5, 11))
    a[0], c[0], c[1] = limit, limit, -limit
    biased = packing.biased(c)
    got = packing.scores(packing.biased(a), packing.pack(biased), packing.sums(biased))
    assert got.tolist() == (a.astype(int) @ c.astype(int).T).tolist()


def test_best_keeps_the_first_of_each_slot():
    best = Best(2, 2)
    best.add(np.array([0, 0, 1]), np.array([5, 5, 1]), np.array([9, 4, 3]))
    best.add(np.array([0, 1, 1]), np.array([6, 1, 0]), np.array([8, 2, 1]))
    assert sorted(zip(best.slot, best.score, best.id)) == [(0, 5, 4), (0, 6, 8), (1, 1, 2), (1, 1, 3)]
    assert best.least == [5, 1]


def test_components_are_floored():
    column = pa.array([[0.0039, -0.0001], [1.5, -1.0]], pa.list_(pa.float32()))
    assert quantised(column, 2).tolist() == [[0, -1], [384, -256]]
