"""How sure a drift is: p-values as column expressions, and cumulative sums over time."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.operators.drift import _cumulative, _sides

# Lanczos' approximation of the gamma function for g = 7 with nine terms.
_LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
            12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
_TINY = 1e-300


def log_gamma(a: Column) -> Column:
    """ln of the gamma function of a > 0."""
    total = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:]):
        total = total + F.lit(c) / (a + F.lit(float(i)))
    t = a + F.lit(6.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (a - F.lit(0.5)) * F.ln(t) - t + F.ln(total)


def gamma_q(a: Column, x: Column) -> Column:
    """The regularised upper incomplete gamma function Q(a, x): the power series of its complement below a + 1, Lentz's
    continued fraction above. Both take some ten times sqrt(a) steps."""
    a, x = a.cast("double"), x.cast("double")
    steps = F.sequence(F.lit(1), F.ceil(F.lit(10.0) * F.sqrt(a) + F.lit(60.0)).cast("int"))
    front = F.exp(a * F.ln(x) - x - log_gamma(a))
    term = F.lit(1.0) / a
    series = F.aggregate(
        steps, F.struct(term.alias("term"), term.alias("sum")),
        lambda s, n: F.struct((s["term"] * x / (a + n)).alias("term"), (s["sum"] + s["term"] * x / (a + n)).alias("sum")), lambda s: s["sum"])
    b = x + F.lit(1.0) - a

    def step(s: Column, n: Column) -> Column:
        k, up = n * (a - n), s["b"] + F.lit(2.0)
        d = F.lit(1.0) / (k * s["d"] + up)
        c = up + k / s["c"]
        return F.struct(up.alias("b"), c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    fraction = F.aggregate(
        steps, F.struct(b.alias("b"), F.lit(1 / _TINY).alias("c"), (F.lit(1.0) / b).alias("d"), (F.lit(1.0) / b).alias("h")), step, lambda s: s["h"])
    return F.when(a.isNull() | x.isNull() | (a <= 0), F.lit(None).cast("double")).when(x <= 0, F.lit(1.0)).when(
        x < a + 1, F.greatest(F.lit(0.0), F.lit(1.0) - front * series)).otherwise(front * fraction)


def chi2_pvalue(statistic: Column, dof: Column) -> Column:
    """The chance of a chi-square statistic at least as large; NULL without a degree of freedom."""
    return gamma_q(dof / F.lit(2.0), statistic / F.lit(2.0))


def ks_pvalue(statistic: Column, n: Column, m: Column) -> Column:
    """The chance of a Kolmogorov-Smirnov distance at least as large between samples of n and m values.

    Kolmogorov's limit with Stephens' correction for finite samples; below 1.2 the theta series that converges there.
    """
    size = F.sqrt(n.cast("double") * m / (n + m))
    x = (size + F.lit(0.12) + F.lit(0.11) / size) * statistic
    terms = F.sequence(F.lit(1), F.lit(20))
    upper = F.aggregate(terms, F.lit(0.0), lambda s, j: s + F.pow(F.lit(-1.0), j - 1) * F.exp(F.lit(-2.0) * j * j * x * x))
    odd = F.aggregate(terms, F.lit(0.0), lambda s, j: s + F.exp(-F.pow(F.lit(2.0) * j - 1, F.lit(2.0)) * F.lit(math.pi**2 / 8) / (x * x)))
    p = F.when(x <= 0, F.lit(1.0)).when(x < 1.2, F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / x * odd).otherwise(F.lit(2.0) * upper)
    return F.when(statistic.isNotNull() & (n > 0) & (m > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)))


def ks_test(tagged: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """D4 with its p-value and the values on either side; NULL where a side has none."""
    found = _cumulative(tagged, column, by).groupBy(*by).agg(
        F.max("gap").alias("ks"), F.max("total_log").cast("bigint").alias("n_log"), F.max("total_base").cast("bigint").alias("n_base"))
    return found.withColumn("p_value", ks_pvalue(F.col("ks"), F.col("n_log"), F.col("n_base")))


def chi2_test(tagged: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """D6 per group with degrees of freedom and p-value; NULL where a side has no row or only one category exists.

    Rows are counted per category first; the windows run over those counts.
    """
    base, log = _sides()
    counts = tagged.groupBy(*by, F.col(column).cast("string").alias("category")).agg(F.count_if(log).alias("p"), F.count_if(base).alias("q"))
    group = W.partitionBy(*(by or [F.lit(0)]))
    both = counts.withColumns({"n_p": F.sum("p").over(group), "n_q": F.sum("q").over(group)})
    cells = F.lit(0.0)
    for side in ("p", "q"):
        expected = (F.col("p") + F.col("q")).cast("double") * F.col(f"n_{side}") / (F.col("n_p") + F.col("n_q"))
        cells = cells + F.when(expected > 0, (F.col(side) - expected) * (F.col(side) - expected) / expected)
    out = both.groupBy(*by).agg(F.sum(cells).alias("chi2"), (F.count(F.lit(1)) - 1).alias("dof"))
    return out.withColumn("p_value", F.when(F.col("dof") > 0, chi2_pvalue(F.col("chi2"), F.col("dof"))))


def cusum(
    series: DataFrame, by: Sequence[str], order: str, value: str, target: Column, slack: float, limit: float, reset: Column | None = None,
) -> DataFrame:
    """O3 over time: the rows of ``series`` with ``cusum``, ``alarm`` and ``first_alarm``.

    The sum of (value - target - slack) is held against its running minimum: it rises while values stay above the target by more
    than ``slack`` and starts at zero where they do not. It is an alarm above ``limit``; the first of a run is marked. A row
    where ``reset`` holds (a retraining, say) starts a new run, itself included. A window without a value adds nothing.
    The series has a row per window and group; ``order`` is unique in a group.
    """
    timeline = W.partitionBy(*by).orderBy(order)
    upto = timeline.rowsBetween(W.unboundedPreceding, W.currentRow)
    starts = F.when(F.coalesce(reset, F.lit(False)), 1).otherwise(0) if reset is not None else F.lit(0)
    runs = series.withColumn("run", F.sum(starts).over(upto).cast("int"))
    run = W.partitionBy(*by, "run").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    step = F.coalesce(F.col(value).cast("double") - target - F.lit(float(slack)), F.lit(0.0))
    summed = runs.withColumn("_sum", F.sum(step).over(run))
    risen = summed.withColumn("cusum", F.col("_sum") - F.least(F.lit(0.0), F.min("_sum").over(run)))
    risen = risen.withColumn("alarm", F.col("cusum") > F.lit(float(limit)))
    first = F.col("alarm") & (F.sum(F.col("alarm").cast("int")).over(run) == 1)
    return risen.withColumn("first_alarm", first).drop("_sum")
