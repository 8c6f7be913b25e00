"""Hard negatives against all pairs in plain Python."""

import math
import random

import numpy as np
import pytest

from evenhand.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(rows, positives=5, negatives=10):
    taking = []
    for i, (vec, v, label) in enumerate(rows):
        if vec is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taking.append((i, vec, (label + 1) % 10 if vec % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    for i, vec, label, v in taking:
        if vec % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), other, j, g) for j, other, g, w in taking if j != i]
        scored.sort()
        for p in [s for s in scored if s[3] == label][:positives]:
            hard = [s for s in scored if s[3] != label and -30 * p[0] <= -100 * s[0] <= -90 * p[0]][:negatives]
            for rank, s in enumerate(hard, 1):
                yield vec, p[1], rank, s[1], -p[0], -s[0]


def mined(spark, rows):
    found = hard_negatives.mine_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted(map(tuple, found))


def vectors(rng, n, width, spread=1.0):
    return [(i, [rng.gauss(0, spread) for _ in range(width)], rng.randrange(10)) for i in range(n)]


@pytest.mark.parametrize("width,spread", [(1, 1.0), (3, 1.0), (16, 0.2), (8, 0.004)])
def test_all_pairs(spark, width, spread):
    rows = vectors(random.Random(width), 400, width, spread)
    assert mined(spark, rows) == sorted(expected(rows))


def test_small_buckets_and_several_blocks(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, [x * 3 ** rng.randrange(5) for x in v], g) for i, v, g in vectors(rng, 600, 6)]
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    assert mined(spark, rows) == sorted(expected(rows))


def test_pruning_skips_rows_and_loses_none():
    rng = np.random.default_rng(1)
    whole = rng.normal(0, 1, (2000, 8))
    whole = np.rint(1000 * whole / np.linalg.norm(whole, axis=1)[:, None]).astype(np.int64)
    n = np.arange(2000)
    anchors = hard_negatives.Anchors(n[:50], n[:50] % 3, whole[:50])
    bucket = hard_negatives.Bucket(n, n, n % 3, whole)
    exact = whole[:50] @ whole.T
    asked = np.sort(exact, axis=1)[:, -5]
    cosine = bucket.cosines(asked, anchors.length)
    looked = 0
    for a, found in bucket.candidates(anchors, np.flatnonzero(cosine <= 1), cosine[cosine <= 1]):
        rows = n if found is None else found
        looked += len(rows)
        assert set(np.flatnonzero(exact[a] >= asked[a])) <= set(rows.tolist())
    assert looked < 0.2 * exact.size


def test_rows_of_all_kinds(spark):
    rng = random.Random(3)
    rows = vectors(rng, 150, 4) + [
        (None, [1.0, 1.0, 1.0, 1.0], 1),
        (200, None, 1),
        (200, [1.0, None, 1.0, 1.0], 1),
        (200, [1.0, float("nan"), 1.0, 1.0], 1),
        (200, [float("-inf"), 1.0, 1.0, 1.0], 1),
        (200, [1.0, 1.0, 1.0, 1.0], None),
        (300, [], 2),
        (300, [0.0, 0.0, 0.0, 0.0], 2),
        (300, [2.0], 2),
        (400, [1.0, 2.0, 3.0, 4.0], 3),
        (400, [1.0, 2.0, 3.0, 4.0], 3),
        *[(401 + i, [1.0, 2.0, 3.0, 4.0 - 2 * (i % 2)], 3 + i % 3) for i in range(60)],
        (-100, [0.5, 0.5, -0.5, 0.5], 4),
    ]
    assert mined(spark, rows) == sorted(expected(rows))


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randrange(1 << 22)) for _ in range(3)], rng.randrange(10)) for i in range(220)]
    assert mined(spark, rows) == sorted(expected(rows))
    assert mined(spark, [(i, [1e300, -1e300], i % 3) for i in range(101)]) is not None


def test_no_rows_and_other_columns(spark):
    assert mined(spark, []) == []
    rows = vectors(random.Random(6), 120, 3)
    wide = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", rid int, score string")
    assert sorted(map(tuple, hard_negatives.mine_embeddings(wide).collect())) == sorted(expected(rows))
