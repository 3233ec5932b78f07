from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from keelson.operators import significance as G
from keelson.operators.drift import SIDE


def even(x, dof):
    """The tail for an even number of degrees of freedom, in closed form."""
    return sum(math.exp(j * math.log(x / 2) - x / 2 - math.lgamma(j + 1)) for j in range(dof // 2))


def odd(x, dof):
    """The tail for an odd number, from the error function up."""
    total, term = math.erfc(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(3, dof + 1, 2):
        total, term = total + term, term * x / k
    return total


def test_chi2_tails(spark):
    cases = [(x, d) for d in (1, 2, 3, 4, 5, 10, 31, 100, 1000, 4001) for x in (1e-6, 0.1, d * 0.4, d * 0.9, d + 1.0, d * 1.2, d * 2.0, 3.841459)]
    got = spark.createDataFrame([(float(x), d) for x, d in cases], "x double, d int").withColumn("p", G.chi2_pvalue(F.col("x"), F.col("d"))).collect()
    for r in got:
        want = even(r.x, r.d) if r.d % 2 == 0 else odd(r.x, r.d) if r.d < 200 else None
        if want is not None:
            assert r.p == pytest.approx(want, rel=1e-8, abs=1e-12), (r.x, r.d)
        assert 0 <= r.p <= 1
    table = {(3.841459, 1): 0.05, (18.307038, 10): 0.05, (124.342113, 100): 0.05, (6.634897, 1): 0.01, (29.587, 14): 0.0087}
    got = spark.createDataFrame([(*k, v) for k, v in table.items()], "x double, d int, p double").withColumn("q", G.chi2_pvalue(F.col("x"), F.col("d"))).collect()
    assert [r.q for r in got] == pytest.approx([r.p for r in got], abs=1e-4)


def test_kolmogorov_tails(spark):
    """The two series agree where both converge, and with tabled values of the limit."""
    n = 10**12  # the correction for finite samples vanishes
    tabled = {0.5: 0.963945, 0.8: 0.544142, 1.0: 0.270000, 1.19: 0.117784, 1.21: 0.106991, 1.358099: 0.05, 1.627624: 0.01, 2.0: 0.000671}
    rows = [(x * math.sqrt(2 / n), n) for x in tabled]
    got = spark.createDataFrame(rows, "d double, n long").withColumn("p", G.ks_pvalue(F.col("d"), F.col("n"), F.col("n"))).collect()
    for r, (x, want) in zip(got, tabled.items()):
        series = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 200))
        assert r.p == pytest.approx(series, abs=1e-5) and r.p == pytest.approx(want, abs=1e-3)
    odd = spark.createDataFrame([(0.0, 5, 5), (1.0, 50, 50), (None, 5, 5), (0.5, 0, 5)], "d double, n long, m long")
    assert [r.p if r.p is None else round(r.p, 3) for r in odd.withColumn("p", G.ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).collect()] == [1.0, 0.0, None, None]


def test_sides_without_rows(spark):
    rows = [("a", True, 1.0, "x"), ("a", False, 2.0, "x"), ("a", False, 1.0, "y"), ("b", False, 1.0, "x"), ("c", True, None, "x"), ("c", False, 1.0, "x")]
    tagged = spark.createDataFrame(rows, f"g string, {SIDE} boolean, v double, c string")
    ks = {r.g: (r.ks, r.n_log, r.n_base, r.p_value) for r in G.ks_test(tagged, "v", ["g"]).collect()}
    assert ks["a"][:3] == (0.5, 2, 1) and 0 < ks["a"][3] <= 1 and ks["b"][0] is ks["b"][3] is None and ks["c"][0] is ks["c"][3] is None
    chi = {r.g: (r.chi2, r.dof, r.p_value) for r in G.chi2_test(tagged, "c", ["g"]).collect()}
    assert chi["a"][:2] == (pytest.approx(0.75), 1) and chi["a"][2] == pytest.approx(math.erfc(math.sqrt(0.375)))
    assert chi["b"] == (None, 0, None) and chi["c"] == (0.0, 0, None)


def test_cusum_by_hand(spark):
    values = [0.0, 2.0, 2.0, None, -1.0, 3.0, 3.0, 3.0, -9.0, 2.0]
    rows = [("a", i, v) for i, v in enumerate(values)] + [("b", 0, 5.0)]
    series = spark.createDataFrame(rows, "g string, t int, v double").repartition(3)
    for resets in ((), (6,)):
        out = G.cusum(series, ["g"], "t", "v", F.lit(1.0), 0.5, 2.0, F.col("t").isin(list(resets)) if resets else None)
        got = {(r.g, r.t): r for r in out.collect()}
        s, seen = 0.0, False
        for t, v in enumerate(values):
            if t in resets:
                s, seen = 0.0, False
            s = max(0.0, s + (0.0 if v is None else v - 1.5))
            r = got["a", t]
            assert (r.cusum, r.alarm) == (pytest.approx(s), s > 2.0) and r.first_alarm == (s > 2.0 and not seen) and r.run == int(bool(resets) and t >= 6)
            seen = seen or s > 2.0
        assert got["b", 0].first_alarm
