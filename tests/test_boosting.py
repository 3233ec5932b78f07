from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import boosting as B


def data(n=400, seed=4):
    rng = np.random.Generator(np.random.PCG64(seed))
    x = rng.normal(0, 1, (n, 3)).round(2)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(n) < 0.05)).astype(int)
    return x, y


def frame(spark, x, y):
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, `b.c` double, c double, label int").repartition(3)


def plain(x, y, edges, s):
    """The same algorithm over all rows at once, node by node."""
    bins = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    m, trees = np.zeros(len(y)), []
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-m))
        g, h, nodes = p - y, p * (1 - p), {}

        def grow(number, rows, depth):
            G, H, best = g[rows].sum(), h[rows].sum(), None
            if depth < s.depth:
                for j in range(x.shape[1]):
                    for b in range(len(edges[j])):
                        left = rows[bins[rows, j] <= b]
                        gl, hl = g[left].sum(), h[left].sum()
                        gain = round((gl**2 / (hl + s.reg_lambda) + (G - gl)**2 / (H - hl + s.reg_lambda) - G**2 / (H + s.reg_lambda)) / 2, 9)
                        if hl >= s.min_child_weight and H - hl >= s.min_child_weight and gain > s.min_gain and (best is None or gain > best[0]):
                            best = gain, j, b
            if best is None:
                nodes[number] = -G / (H + s.reg_lambda) * s.learning_rate
                m[rows] += nodes[number]
                return
            nodes[number] = best[1:]
            inside = bins[rows, best[1]] <= best[2]
            grow(2 * number, rows[inside], depth + 1)
            grow(2 * number + 1, rows[~inside], depth + 1)

        grow(1, np.arange(len(y)), 0)
        trees.append(nodes)
    return trees, m


def test_matches_a_plain_version(spark):
    x, y = data()
    edges = {"a": [-1, -0.5, 0, 0.5, 1], "b.c": [-0.7, 0, 0.7], "c": [0.0]}
    settings = B.Boosting(rounds=7, depth=3, learning_rate=1.2, min_child_weight=2.0)  # margins are stored once on the way
    model = B.fit_boosted(frame(spark, x, y), list(edges), "label", settings, edges)
    trees, margin = plain(x, y, list(edges.values()), settings)
    for got, want in zip(model.trees, trees, strict=True):
        found = {n.node: n for n in got}
        assert found.keys() == want.keys()
        for number, node in want.items():
            if isinstance(node, tuple):
                assert (found[number].feature, found[number].bin) == node
            else:
                assert found[number].weight == pytest.approx(node)
    again = B.BoostedTrees.from_json(model.to_json())
    for one in (model, again):
        scored = {r.id: r.score for r in one.score(frame(spark, x, y)).collect()}
        assert [scored[i] for i in range(len(y))] == pytest.approx((1 / (1 + np.exp(-margin))).tolist())


def test_learns_an_interaction_from_quantile_bins(spark):
    x, y = data(1500)
    model = B.fit_boosted(frame(spark, x[:1000], y[:1000]), ["a", "b.c", "c"], "label", B.Boosting(rounds=12, depth=3, bins=16, learning_rate=0.4))
    scored = model.score(frame(spark, x[1000:], y[1000:]))
    assert scored.filter("prediction = label").count() >= 0.88 * 500
    assert all(len(e) <= 15 for e in model.edges)


def test_share_of_columns_and_stops(spark):
    x, y = data(200)
    model = B.fit_boosted(frame(spark, x, y), ["a", "b.c", "c"], "label", B.Boosting(rounds=4, depth=2, columns=0.34))
    assert all(len({n.feature for n in tree if n.feature is not None}) <= 1 for tree in model.trees) and len(model.trees) == 4
    stump = B.fit_boosted(frame(spark, x, y), ["a"], "label", B.Boosting(rounds=1, min_child_weight=1e9))
    assert [n.node for n in stump.trees[0]] == [1]
    share = y.mean()
    assert stump.trees[0][0].weight == pytest.approx(-(0.5 - share) * len(y) / (0.25 * len(y) + 1) * 0.2)


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, None, 1.0, 1), (2, float("nan"), 1.0, 1.0, 0), (3, 2.0, 1.0, 1.0, None), (4, 5.0, 1.0, 1.0, 1)],
                                 "id int, a double, `b.c` double, c double, label int")
    model = B.fit_boosted(rows, ["a", "b.c", "c"], "label", B.Boosting(rounds=2, min_child_weight=0.0))
    assert model.score(rows).filter(F.col("score").between(0, 1)).count() == 4
    none = B.fit_boosted(rows.limit(0), ["a"], "label", B.Boosting(rounds=2))
    assert none.trees == [] and {r.score for r in none.score(rows).collect()} == {0.5}
    assert not math.isnan(model.score(rows).first()["score"])
