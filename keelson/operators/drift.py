"""Drift of a log against a baseline.

Functions take one *tagged* frame with a boolean ``is_baseline`` column. Two parts of
one table should be tagged by their marker (one scan); separate tables go through
:func:`tag`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.functions.running import running_totals, same_group
from keelson.operators.metrics import ratio
from keelson.session import staged

SIDE = "is_baseline"
SMOOTHING = 1e-4  # share given to a bin that is empty on one side


def tag(log: DataFrame, baseline: DataFrame, columns: Sequence[str]) -> DataFrame:
    return log.select(*columns, F.lit(False).alias(SIDE)).unionByName(
        baseline.select(*columns, F.lit(True).alias(SIDE))
    )


def _sides() -> tuple[Column, Column]:
    return F.col(SIDE), ~F.col(SIDE)


# --- binned numeric drift -----------------------------------------------------

def _edges(baseline: DataFrame, column: str) -> Column:
    """The baseline's extremes as a scalar subquery."""
    v = F.col(column).cast("double")
    return baseline.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias("e")).scalar()


def _binned(df: DataFrame, column: str, edges: Column, bins: int) -> DataFrame:
    """Equal-width bins between the edges; values beyond go to the end bins. A NULL has no bin, and
    without a baseline no value has one."""
    return df.withColumn("_edges", edges).withColumn(
        "bin", bin_of(F.col(column), F.col("_edges.lo"), F.col("_edges.hi"), bins)).drop("_edges")


def bin_of(column: Column, lo: Column, hi: Column, bins: int) -> Column:
    v = column.cast("double")
    raw = F.floor((v - lo) / ((hi - lo) / F.lit(float(bins)))).cast("int")
    inside = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))
    return F.when(v >= hi, F.lit(bins - 1)).when(v <= lo, F.lit(0)).when(lo.isNotNull() & v.isNotNull(), inside)


def bin_index(tagged: DataFrame, column: str, bins: int) -> DataFrame:
    """Bins are fixed by the baseline alone."""
    return _binned(tagged, column, _edges(tagged.filter(F.col(SIDE)), column), bins)


def bin_shares(tagged: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Baseline share ``q`` and log share ``p`` per bin, smoothed; every bin present. The shares
    of a side without values are NULL, and so is every statistic made from them.

    One aggregate row with two counts per bin; the shuffle carries one row per task.
    """
    base, log = _sides()
    counted = bin_index(tagged, column, bins).agg(*[
        F.count_if((F.col("bin") == i) & side).alias(f"{name}{i}")
        for i in range(bins) for name, side in (("q", base), ("p", log))
    ])
    return counted.select(F.inline(F.array(*[_share_row(i, bins) for i in range(bins)])))


def _share_row(i: int, bins: int) -> Column:
    def share(name: str) -> Column:
        total = F.lit(0)
        for j in range(bins):
            total = total + F.col(f"{name}{j}")
        return F.when(total > 0, F.greatest(ratio(F.col(f"{name}{i}"), total), F.lit(SMOOTHING)))

    return F.struct(F.lit(i).alias("bin"), share("p").alias("p"), share("q").alias("q"))


def psi(tagged: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Population stability index."""
    p, q = F.col("p"), F.col("q")
    return bin_shares(tagged, column, bins).agg(F.sum((p - q) * F.ln(p / q)).alias("psi"))


def js_distance(tagged: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """D3: Jensen-Shannon distance, logarithm to base 2, over renormalised smoothed shares."""
    sums = bin_shares(tagged, column, bins).withColumns({
        "p": F.col("p") / F.sum("p").over(W.partitionBy(F.lit(0))),
        "q": F.col("q") / F.sum("q").over(W.partitionBy(F.lit(0))),
    })
    p, q = F.col("p"), F.col("q")
    m = (p + q) / F.lit(2.0)
    divergence = F.sum((p * F.ln(p / m) + q * F.ln(q / m)) / F.lit(2.0)) / F.ln(F.lit(2.0))
    return sums.agg(_root(divergence).alias("js_distance"))


def _root(divergence: Column) -> Column:
    """Square root of what rounding may have put below 0; NULL stays NULL."""
    return F.when(divergence.isNotNull(), F.sqrt(F.greatest(divergence, F.lit(0.0))))


# --- numeric drift on the full distributions ----------------------------------

def _cumulative(tagged: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    base, log = _sides()
    counts = (
        tagged.filter(F.col(column).isNotNull())
        .groupBy(*by, F.col(column).cast("double").alias("value"))
        .agg(F.count_if(base).alias("base"), F.count_if(log).alias("log"))
    )
    ranked = running_totals(counts, "value", {"base": "base", "log": "log"}, by)
    gap = ratio(F.col("cum_log"), F.col("total_log")) - ratio(F.col("cum_base"), F.col("total_base"))
    return ranked.withColumn("gap", F.abs(gap))


def ks(tagged: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Kolmogorov-Smirnov statistic."""
    return _cumulative(tagged, column, by).groupBy(*by).agg(F.max("gap").alias("ks"))


def wasserstein(tagged: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Wasserstein-1 distance."""
    step = F.col("gap") * (F.col("next_value") - F.col("value"))
    return _cumulative(tagged, column, by).groupBy(*by).agg(
        F.when((F.max("total_base") > 0) & (F.max("total_log") > 0), F.coalesce(F.sum(step), F.lit(0.0))).alias("wasserstein")
    )


# --- categorical drift --------------------------------------------------------

def category_counts(tagged: DataFrame, column: str) -> DataFrame:
    """Counts per category on both sides; NULL is a category of its own."""
    base, log = _sides()
    return tagged.groupBy(F.col(column).cast("string").alias("category")).agg(
        F.count_if(log).alias("p"), F.count_if(base).alias("q")
    )


def _categorical(tagged: DataFrame, column: str, value) -> DataFrame:
    """Aggregate ``value(p, q, n_p, n_q)`` over categories; totals come as a scalar subquery."""
    counts = category_counts(tagged, column)
    totals = counts.agg(F.struct(F.sum("p").alias("p"), F.sum("q").alias("q")).alias("t"))
    joined = counts.withColumn("_t", totals.scalar())
    return joined.agg(value(F.col("p"), F.col("q"), F.col("_t.p"), F.col("_t.q")))


def chi2(tagged: DataFrame, column: str) -> DataFrame:
    """Pearson statistic of the 2 x categories table, and its degrees of freedom."""
    counts = category_counts(tagged, column)
    totals = counts.agg(F.struct(F.sum("p").alias("p"), F.sum("q").alias("q")).alias("t"))
    t = counts.withColumn("_t", totals.scalar())
    both = F.col("_t.p") + F.col("_t.q")
    cells = F.lit(0.0)
    for side in ("p", "q"):
        expected = ratio((F.col("p") + F.col("q")).cast("double") * F.col(f"_t.{side}"), both)
        miss = F.col(side) - expected
        cells = cells + ratio(miss * miss, expected)
    return t.agg(F.sum(cells).alias("chi2"), (F.count(F.lit(1)) - 1).alias("dof"))


def tv_distance(tagged: DataFrame, column: str) -> DataFrame:
    """Total variation distance."""
    return _categorical(tagged, column, lambda p, q, np, nq: (
        F.sum(F.abs(ratio(p, np) - ratio(q, nq))) / F.lit(2.0)).alias("tv_distance"))


def linf_distance(tagged: DataFrame, column: str) -> DataFrame:
    """Largest difference of a category share."""
    return _categorical(tagged, column, lambda p, q, np, nq: (
        F.max(F.abs(ratio(p, np) - ratio(q, nq)))).alias("linf_distance"))


def rate_shift(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Change of the positive rate of prediction and label columns, NULLs left out."""
    base, log = _sides()
    aggs = []
    for c in columns:
        hit = F.col(c).cast("double") == F.lit(1.0)
        held = F.col(c).isNotNull()
        aggs += [
            ratio(F.count_if(base & hit), F.count_if(base & held)).alias(f"base_{c}"),
            ratio(F.count_if(log & hit), F.count_if(log & held)).alias(f"log_{c}"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(f"base_{c}").alias("base_rate"), F.col(f"log_{c}").alias("log_rate"),
            (F.col(f"log_{c}") - F.col(f"base_{c}")).alias("shift"),
        )
        for c in columns
    ])
    return tagged.agg(*aggs).select(F.inline(rows))


# --- windowed drift of a profile ----------------------------------------------

DELTAS = ("count", "mean", "null_share", "zero_share", "distinct_share")


def _shares(df: DataFrame) -> DataFrame:
    n = F.col("n")
    return df.withColumns({
        "count": n.cast("double"),
        "null_share": ratio(F.col("n_null"), n),
        "zero_share": ratio(F.col("n_zero"), n),
        "distinct_share": ratio(F.col("n_distinct"), n),
    })


def drift_deltas(
    profile: DataFrame, baseline: DataFrame, time: str = "window_start",
    keys: Sequence[str] = ("model_version", "slice", "column"), match: Sequence[str] = ("slice", "column"),
) -> DataFrame:
    """Every profile row against the baseline profile and against the window before it.

    Both inputs are profiles, already aggregated. The baseline holds one row per
    (slice, column) and is left to the optimiser to broadcast.
    """
    current = _shares(profile)
    reference = _shares(baseline).select(*match, *[F.col(d).alias(f"_base_{d}") for d in DELTAS])
    before = W.partitionBy(*keys).orderBy(time)
    lagged = current.withColumns({f"_prev_{d}": F.lag(d).over(before) for d in DELTAS})
    joined = lagged.join(reference, list(match), "left")
    rows = [
        F.struct(
            F.lit(kind).alias("kind"), F.lit(f"delta_{d}").alias("metric"),
            (F.col(d) - F.col(f"{prefix}{d}")).alias("value"),
        )
        for kind, prefix in (("baseline", "_base_"), ("consecutive", "_prev_"))
        for d in DELTAS
    ]
    long = joined.select(time, *keys, F.inline(F.array(*rows)))
    return long.filter(F.col("value").isNotNull())


def _cells(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], by: Sequence[str], edges: Column | None, bins: int) -> DataFrame:
    """(by, column, cell, n) of all columns in one aggregate: a numeric column's cells are its bins, a
    category's cell is its value; NULL is a category of its own and no bin."""
    df = df.withColumn("_edges", edges) if numeric else df
    pairs = [
        F.struct(F.lit(c).alias("column"), bin_of(F.col(c), F.col(f"_edges.lo{i}"), F.col(f"_edges.hi{i}"), bins).cast("string").alias("cell"))
        for i, c in enumerate(numeric)
    ] + [
        F.struct(F.lit(c).alias("column"), F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias("cell"))
        for c in categorical
    ]
    return df.select(*by, F.explode(F.array(*pairs)).alias("_p")).groupBy(*by, "_p.column", "_p.cell").agg(F.count(F.lit(1)).alias("n"))


def _all_edges(baseline: DataFrame, numeric: Sequence[str]) -> Column | None:
    """The extremes of all numeric columns as one scalar subquery."""
    ends = [(f, F.col(c).cast("double"), f"{name}{i}") for i, c in enumerate(numeric) for f, name in ((F.min, "lo"), (F.max, "hi"))]
    return baseline.agg(F.struct(*[f(v).alias(name) for f, v, name in ends]).alias("e")).scalar() if ends else None


def window_cells(
    log: DataFrame, baseline: DataFrame, numeric: Sequence[str], categorical: Sequence[str], keys: Sequence[str],
    match: Sequence[str] = (), bins: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """The counts of log and baseline that D2, D3 and D7 are made of, stored once.

    The log is read once and the baseline twice (its extremes, then its counts), whatever
    the number of columns.
    """
    edges = _all_edges(baseline, numeric)
    return (staged(_cells(log, numeric, categorical, keys, edges, bins), "drift-log"),
            staged(_cells(baseline, numeric, categorical, match, edges, bins), "drift-baseline"))


def cells_psi(cells: DataFrame, reference: DataFrame, numeric: Sequence[str], keys: Sequence[str], match: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """D2 and D3 per group and numeric column.

    A group without values, or one whose ``match`` the baseline lacks, keeps its row with
    NULL statistics.
    """
    def histogram(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
        counts = F.array(*[F.coalesce(F.sum(F.when(F.col("cell") == str(i), F.col("n"))), F.lit(0)) for i in range(bins)])
        return df.filter(F.col("column").isin(list(numeric))).groupBy(*by, "column").agg(counts.alias(name))

    def total(values: Column, zero) -> Column:
        return F.aggregate(values, zero, lambda a, x: a + x)

    def shares(counted: Column) -> Column:
        n = total(counted, F.lit(0).cast("bigint"))
        return F.when(n > 0, F.transform(counted, lambda x: F.greatest(ratio(x, n), F.lit(SMOOTHING))))

    def half(a: Column, b: Column) -> Column:
        return a * F.ln(a / ((a + b) / F.lit(2.0))) / F.lit(2.0)

    theirs = [f"_t_{k}" for k in match]
    right = histogram(reference, match, "_q").select(*[F.col(k).alias(t) for k, t in zip(match, theirs)], F.col("column").alias("_c"), "_q")
    groups = histogram(cells, keys, "_p").join(right, same_group([*match, "column"], [*theirs, "_c"]), "left")
    zero = F.lit(0.0)
    shared = groups.withColumns({"n": total(F.col("_p"), F.lit(0).cast("bigint")), "_p": shares(F.col("_p")), "_q": shares(F.col("_q"))})
    normal = shared.withColumns({
        "_np": F.transform("_p", lambda x: x / total(F.col("_p"), zero)), "_nq": F.transform("_q", lambda x: x / total(F.col("_q"), zero))})
    js = F.zip_with("_np", "_nq", lambda a, b: half(a, b) + half(b, a))
    return normal.select(
        *keys, "column", "n", total(F.zip_with("_p", "_q", lambda a, b: (a - b) * F.ln(a / b)), zero).alias("psi"),
        _root(total(js, zero) / F.ln(F.lit(2.0))).alias("js_distance"))


def cells_tv(cells: DataFrame, reference: DataFrame, categorical: Sequence[str], keys: Sequence[str], match: Sequence[str] = ()) -> DataFrame:
    """D7 per group and categorical column; NULL where the baseline has no row for the ``match`` values.

    A category the group lacks adds its whole baseline share. Those need no rows: the
    shares of the lacking ones are 1 minus the shares of the ones present.
    """
    def shares(df: DataFrame, by: Sequence[str], share: str) -> tuple[DataFrame, DataFrame]:
        own = df.filter(F.col("column").isin(list(categorical)))
        totals = own.groupBy(*[F.col(k).alias(f"_t_{k}") for k in (*by, "column")]).agg(F.sum("n").alias("_total"))
        joined = own.join(totals, same_group([*by, "column"], [f"_t_{k}" for k in (*by, "column")]))
        return joined.select(*by, "column", "cell", "n", ratio(F.col("n"), F.col("_total")).alias(share)), totals

    log, _ = shares(cells, keys, "_p")
    base, totals = shares(reference, match, "_q")
    right = base.select(*[F.col(k).alias(f"_b_{k}") for k in (*match, "column", "cell")], "_q")
    present = log.join(right, same_group([*match, "column", "cell"], [f"_b_{k}" for k in (*match, "column", "cell")]), "left")
    known = present.join(totals, same_group([*match, "column"], [f"_t_{k}" for k in (*match, "column")]), "left")
    q = F.coalesce("_q", F.lit(0.0))
    lacking = F.greatest(F.lit(1.0) - F.sum(q), F.lit(0.0))
    distance = (F.sum(F.abs(F.col("_p") - q)) + lacking) / F.lit(2.0)
    return known.groupBy(*keys, "column").agg(F.sum("n").alias("n"), F.when(F.max("_total").isNotNull(), distance).alias("tv_distance"))


def window_psi(
    log: DataFrame, baseline: DataFrame, column: str, keys: Sequence[str], bins: int = 10,
    match: Sequence[str] = (),
) -> DataFrame:
    """D2 and D3 of one column per group of the log against the baseline's histogram."""
    cells, reference = window_cells(log, baseline, [column], [], keys, match, bins)
    return cells_psi(cells, reference, [column], keys, match, bins).drop("column")


def window_tv(
    log: DataFrame, baseline: DataFrame, column: str, keys: Sequence[str], match: Sequence[str] = ()
) -> DataFrame:
    """D7 of one column per group of the log against the baseline's shares."""
    cells, reference = window_cells(log, baseline, [], [column], keys, match)
    return cells_tv(cells, reference, [column], keys, match).drop("column")


def baseline_drift(
    log: DataFrame, baseline: DataFrame, numeric: Sequence[str], categorical: Sequence[str], keys: Sequence[str],
    match: Sequence[str] = (), bins: int = 10,
) -> DataFrame:
    """PSI, JS and total variation per group and column as (column, kind, metric, value) rows."""
    cells, reference = window_cells(log, baseline, numeric, categorical, keys, match, bins)
    found = []
    if numeric:
        found.append((cells_psi(cells, reference, numeric, keys, match, bins), ("psi", "js_distance")))
    if categorical:
        found.append((cells_tv(cells, reference, categorical, keys, match), ("tv_distance",)))
    out = None
    for frame, names in found:
        rows = F.array(*[F.struct(F.lit("baseline").alias("kind"), F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
        part = frame.select(*keys, "column", F.inline(rows))
        out = part if out is None else out.unionByName(part)
    return out


def retrain_signal(values: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """O3: compare (metric, value) rows with limits.

    ``limits`` maps a metric to ``("above", x)`` or ``("below", x)``; the row is a signal
    when the value lies beyond. Metrics without a limit are left out.
    """
    beyond = F.lit(None).cast("boolean")
    limit = F.lit(None).cast("double")
    for metric, (side, x) in limits.items():
        here = F.col("metric") == metric
        over = F.col("value") > F.lit(float(x)) if side == "above" else F.col("value") < F.lit(float(x))
        beyond = F.when(here, over).otherwise(beyond)
        limit = F.when(here, F.lit(float(x))).otherwise(limit)
    return values.filter(F.col("metric").isin(list(limits))).withColumns({
        "limit": limit, "retrain": F.coalesce(beyond, F.lit(False)),
    })
