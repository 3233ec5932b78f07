from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from keelson.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, score long"


def brute(rows, k):
    good = {i: [math.floor(1024 * x) for x in v] for i, v, _ in rows
            if i is not None and v is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in good:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q)[:k]
            out += [(q, n, c, -s) for n, (s, c) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, k=10, **more):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in top_k(frame, F.col("vec_id") % 100 == 0, k, **more).collect())


def test_matches_brute_force_with_ties(spark):
    rng = np.random.Generator(np.random.PCG64(2))
    rows = [(i, [float(x) for x in np.float32(rng.normal(0, 0.2, 9))], 1) for i in range(301)]
    rows += [(400 + i, rows[7][1], 1) for i in range(101)]  # a group of equal vectors with a query in it
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, rows, 3, lists=3) == brute(rows, 3)
    assert run(spark, rows, 1, lists=1) == brute(rows, 1)


def test_negative_scores_and_few_candidates(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [-1.0, -2.0], 1), (2, [-3.0, 0.5], 1), (100, [-0.25, -0.0001], 1)]
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, rows[:1]) == [] and run(spark, rows, 2) == brute(rows, 2)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [nan, 1.0], 1), (4, [1.0, -inf], 1), (5, [0.5, 0.5], 1),
            (None, [1.0, 1.0], 1), (200, [2.0, 2.0], 1)]
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, rows + [rows[5]]) == brute(rows, 10)
    assert run(spark, rows + [(7, [1.0], 1)]) == brute(rows, 10)  # another length takes no part
    assert run(spark, []) == []


def test_large_components(spark):
    rows = [(i, [float(2**14 + i), float(3 * i)], 1) for i in (0, 1, 2, 3)]
    assert run(spark, rows) == brute(rows, 10)
