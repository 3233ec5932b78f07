from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import explain as E

NAMES = list("abcdef")


def scorer():
    a, b, c, d, e, f = (F.col(n) for n in NAMES)
    return a * b + F.lit(2.0) * c - d * e * f + F.when(a > 0, c).otherwise(F.lit(0.0))


def plain(x):
    a, b, c, d, e, f = x
    return a * b + 2.0 * c - d * e * f + (c if a > 0 else 0.0)


def shapley(x, background):
    """By the definition, over all coalitions."""
    m = len(x)

    def value(members):
        return np.mean([plain([x[j] if j in members else b[j] for j in range(m)]) for b in background])

    out = []
    for j in range(m):
        total = 0.0
        for s in range(m):
            for some in itertools.combinations([k for k in range(m) if k != j], s):
                weight = math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m)
                total += weight * (value({*some, j}) - value(set(some)))
        out.append(total)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.Generator(np.random.PCG64(3))
    return rng.normal(0, 1, (4, 6)).round(3).tolist(), rng.normal(0, 1, (7, 6)).round(3).tolist()


def frames(spark, rows):
    schema = "k int, " + ", ".join(f"{n} double" for n in NAMES)
    return [spark.createDataFrame([(i, *r) for i, r in enumerate(some)], schema) for some in rows]


def test_equal_to_full_enumeration(spark, rows):
    examples, background = frames(spark, rows)
    got = {}
    for r in E.kernel_values(examples, background, NAMES, ["k"], scorer(), n=10).collect():
        got.setdefault(r.k, {})[r.feature] = r.attribution
    for k, x in enumerate(rows[0]):
        assert [got[k][n] for n in NAMES] == pytest.approx(shapley(x, rows[1]))


def test_sampled_coalitions_add_up_and_come_near(spark, rows):
    examples, background = frames(spark, rows)
    far = 0.0
    for most in (30, 60):
        got = {}
        for r in E.kernel_values(examples, background, NAMES, ["k"], scorer(), n=10, most=most).collect():
            got.setdefault(r.k, {})[r.feature] = r.attribution
        for k, x in enumerate(rows[0]):
            want = shapley(x, rows[1])
            assert sum(got[k].values()) == pytest.approx(sum(want))
            far = max(far, max(abs(got[k][n] - w) for n, w in zip(NAMES, want)))
    assert 1e-6 < far < 1.5


def test_few_features_and_weights(spark, rows):
    examples, background = frames(spark, rows)
    one = E.kernel_values(examples, background, ["a"], ["k"], F.col("a") * 3, n=10).collect()
    mean = np.mean([b[0] for b in rows[1]])
    assert sorted((r.k, round(r.attribution, 9)) for r in one) == [(k, round(3 * (x[0] - mean), 9)) for k, x in enumerate(rows[0])]
    for m, most in ((2, 99), (5, 99), (12, 200)):
        masks = E.coalitions(m, most)
        weights = E.kernel_weights(m, masks)
        assert np.allclose(np.sum(list(weights.values()), axis=0), 0) and np.allclose(sum(weights[2**m - 1]) + sum(
            sum(weights[mask]) for mask, _ in masks), 1)
    assert E.kernel_values(examples.limit(0), background, ["a", "b"], ["k"], F.col("a"), n=3).count() == 0
