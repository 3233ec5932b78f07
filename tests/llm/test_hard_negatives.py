from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm.hard_negatives import codebook, half_bounds, mine_hard_negatives, multi_sequence, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, score long, cell string"


def brute(rows, positives=5, negatives=3, low=50, high=95, every=50):
    good = {i: ([math.floor(256 * x) for x in v], y) for i, v, y, *_ in rows
            if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in good:
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(good[a][0], good[c][0])), c) for c in good if c != a)
        for s, p in [(s, c) for s, c in scores if good[c][1] == good[a][1]][:positives]:
            window = [(n, c) for n, c in scores if good[c][1] != good[a][1] and low * -s <= 100 * -n <= high * -s]
            out += [(a, p, r, c, -s, -n) for r, (n, c) in enumerate(window[:negatives], 1)]
    return sorted(out)


def run(spark, rows, every=50, **more):
    frame = spark.createDataFrame([(*r[:3], 1, "clash") for r in rows], SCHEMA).repartition(3)
    got = mine_hard_negatives(frame, F.col("vec_id") % every == 0, **more)
    return sorted(tuple(r) for r in got.collect())


def clustered(n=400, width=9, seed=3):
    rng = np.random.Generator(np.random.PCG64(seed))
    centers = rng.normal(0, 1, (6, width))
    return [(i, [float(x) for x in np.float32(centers[i % 6] + rng.normal(0, 0.15, width))], int(rng.integers(0, 4))) for i in range(n)]


def test_matches_brute_force_with_ties_and_a_hot_vector(spark):
    rows = clustered()
    rows += [(1000 + i, rows[7][1], i % 3) for i in range(150)]  # copies, anchors among them
    assert run(spark, rows) == brute(rows) != []
    assert run(spark, rows, positives=2, negatives=1, low=10, high=100, centroids=3) == brute(rows, 2, 1, 10, 100)
    assert run(spark, rows, centroids=40, sample_rows=50) == brute(rows)


def test_negative_scores_and_few_rows(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [-1.0, -2.0], 1), (2, [-3.0, 0.5], 2), (3, [0.5, 0.6], 2), (50, [1.0, -1.0], 1), (100, [0.0, 0.0], 2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == [] and run(spark, []) == []
    one = [(i, [float(i % 5)], i % 2) for i in range(40)]  # an empty second half
    assert run(spark, one, every=10) == brute(one, every=10) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(60) + [(100, None, 1), (150, [None] * 9, 1), (201, [nan] * 9, 1), (202, [-inf] * 9, 1), (203, [0.1] * 9, None), (None, [1.0] * 9, 1)]
    assert run(spark, rows) == brute(rows) != []
    assert run(spark, rows + rows[:20]) == brute(rows)
    with pytest.raises(ValueError, match="components"):
        run(spark, rows + [(300, [1.0], 1)])
    large = [(i, [float(2**14 + i), float(3 * i)], i % 2) for i in range(60)]
    assert run(spark, large, low=0, high=100) == brute(large, low=0, high=100) != []


def test_sequence_is_sorted_and_bounds_hold():
    rng = np.random.Generator(np.random.PCG64(1))
    points, query = rng.normal(0, 50, (500, 8)), rng.normal(0, 50, 8)
    books = [codebook(points[:, :4], 7), codebook(points[:, 4:], 5)]
    own = [nearest(points[:, :4], books[0]), nearest(points[:, 4:], books[1])]
    radii = [np.array([d[o == j].max(initial=0) for j in range(len(b))]) for (o, d), b in zip(own, books)]
    filled = np.zeros(35, dtype=bool)
    filled[own[0][0] * 5 + own[1][0]] = True
    visits = list(multi_sequence(half_bounds(query[:4], books[0], radii[0]), half_bounds(query[4:], books[1], radii[1]), filled))
    assert sorted(c for _, c in visits) == np.flatnonzero(filled).tolist()
    assert [b for b, _ in visits] == sorted((b for b, _ in visits), reverse=True)
    bound = dict((c, b) for b, c in visits)
    assert all(points[i] @ query <= bound[own[0][0][i] * 5 + own[1][0][i]] for i in range(500))


def test_anchors_with_certified_windows_stop(spark, monkeypatch):
    from keelson.llm import hard_negatives as module

    calls, meet = [], module.MultiIndex.meet

    def counted(self, anchors, start, stop, score):
        calls.append((score.__qualname__.split(".")[0], start, anchors.count()))
        return meet(self, anchors, start, stop, score)

    monkeypatch.setattr(module.MultiIndex, "meet", counted)
    monkeypatch.setattr(module, "FIRST_CELLS", 4)
    rng = np.random.Generator(np.random.PCG64(8))
    rows = [(i, [float(x) for x in np.float32(np.eye(8)[i % 8] * 4 + rng.normal(0, 0.02, 8))], i % 8) for i in range(320)]
    assert run(spark, rows, low=-100) == brute(rows, low=-100)
    assert max(start for kind, start, _ in calls if kind == "same_label") <= 16  # of more than 64 cells
