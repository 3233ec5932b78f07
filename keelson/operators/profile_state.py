"""Profiles as state that merges: cells of a log are kept once and rolled up to any coarser window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.monitor import PROFILE_COLUMNS, QUANTILES, long_values, sliced, windowed, with_window_end
from keelson.session import shuffle_width, staged

CELL = "5 minutes"
KLL_K, HLL_LG_K = 200, 12
RANK_ERROR, DISTINCT_ERROR = 0.03, 0.08  # five standard errors of sketches of these sizes
TASK_ROWS = 500_000  # rows that one task checks against a profile
STATE = ["n", "n_null", "n_zero", "min", "max", "mean", "m2", "ranks", "values"]


def profile_cells(
    df: DataFrame, columns: Sequence[str], ts: str, cell: str = CELL, model: str | None = None,
    slices: Mapping[str, str | Column] | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """The state of every cell, model, slice and column from one aggregate over the rows.

    Counts, extremes, mean and sum of squared deviations are exact; ``ranks`` is a KLL sketch of the values and
    ``values`` an HLL sketch of the distinct ones. Both stay small where a cell has few values and are bounded in
    any other. ``by`` names further columns that keep cells apart, such as the batch they came with.
    """
    df, keys = windowed(df, ts, cell, model)
    if slices is not None:
        df = sliced(df, slices)
        keys.append("slice")
    long, keys = long_values(df, columns, [*by, *keys])
    v = F.col("value")
    return long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v.isNull()).alias("n_null"), F.count_if(v == 0).alias("n_zero"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
        F.kll_sketch_agg_double(v, F.lit(KLL_K)).alias("ranks"),
        F.hll_sketch_agg(v.cast("string"), F.lit(HLL_LG_K)).alias("values"),
    )


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per group of ``keys`` out of any number of states, in any order.

    Means and squared deviations are merged pair by pair, which keeps the digits that sums of squares lose; the list
    of a group has an entry per state, never per row.
    """
    moment = F.struct((F.col("n") - F.col("n_null")).cast("double").alias("n"), "mean", "m2")
    merged = states.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.sum("n_zero").alias("n_zero"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.collect_list(F.when(F.col("n") > F.col("n_null"), moment)).alias("_moments"),
        F.kll_merge_agg_double("ranks").alias("ranks"), F.hll_union_agg("values").alias("values"),
    )

    def step(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"),
                        (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"))

    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    some = F.size("_moments") > 0
    merged = merged.withColumn("_all", F.aggregate("_moments", zero, step))
    return merged.withColumns({"mean": F.when(some, F.col("_all.mean")), "m2": F.when(some, F.col("_all.m2"))}).select(*keys, *STATE)


def roll_up(states: DataFrame, window: str, cell: str = CELL, drop: Sequence[str] = ()) -> DataFrame:
    """States of a coarser window, from cells alone; ``drop`` names group columns to merge over as well."""
    if pd.Timedelta(window) % pd.Timedelta(cell) != pd.Timedelta(0):
        raise ValueError(f"{window} is no multiple of {cell}")
    keys = [c for c in states.columns if c not in (*STATE, *drop)]
    start = F.window("window_start", window)["start"]
    return merge_states(states.withColumn("window_start", start), keys)


def state_profile(states: DataFrame, window: str | None = None) -> DataFrame:
    """The profile that a state stands for, in the columns of :func:`keelson.operators.monitor.profile`."""
    keys = [c for c in states.columns if c not in STATE]
    seen = F.col("n") > F.col("n_null")
    quantiles = {name: F.when(seen, F.kll_sketch_get_quantile_double("ranks", F.lit(q))) for name, q in QUANTILES.items()}
    out = states.withColumns({
        **quantiles, "std": F.sqrt(F.col("m2") / (F.col("n") - F.col("n_null"))),
        "n_distinct": F.when(seen, F.hll_sketch_estimate("values")).otherwise(F.lit(0)).cast("long"),
    })
    return with_window_end(out.select(*keys, *PROFILE_COLUMNS), window)


def profile_windows(
    df: DataFrame, columns: Sequence[str], ts: str, windows: Sequence[str], cell: str = CELL, model: str | None = None,
    slices: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """Profiles of several granularities from one scan of the log, with a column ``granularity``.

    The cells are written to the shared folder when this is called and stay there until the session ends.
    """
    cells = staged(profile_cells(df, columns, ts, cell, model, slices), "profile-cells")
    out = None
    for window in windows:
        one = state_profile(cells if pd.Timedelta(window) == pd.Timedelta(cell) else roll_up(cells, window, cell), window)
        one = one.select(F.lit(window).alias("granularity"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def within_bounds(
    profiled: DataFrame, df: DataFrame, columns: Sequence[str], ts: str, window: str, model: str | None = None,
    slices: Mapping[str, str | Column] | None = None, rank_error: float = RANK_ERROR, distinct_error: float = DISTINCT_ERROR,
) -> DataFrame:
    """Hold the sketches of a profile against the rows: ``<quantile>_ok`` and ``n_distinct_ok`` per group.

    A quantile is right if its rank among the group's values is within ``rank_error``, a number of distinct values if
    it is within one or ``distinct_error`` of the true one.

    Equal values of a group are counted first, in as many tasks as the profile's own counts of rows ask for; a group
    is cut by its values into slices, and only sums of slices meet in one place. The profile is read when this is called.
    """
    df, keys = windowed(df, ts, window, model)
    if slices is not None:
        df = sliced(df, slices)
        keys.append("slice")
    long, keys = long_values(df, columns, keys)
    size = profiled.agg(F.max("n").alias("top"), F.sum("n").alias("all")).first()
    tasks = max(shuffle_width(df.sparkSession), -(-(size["all"] or 0) // TASK_ROWS))
    cuts = min(tasks, max(1, -(-(size["top"] or 0) // (TASK_ROWS // 10))))
    value = F.col("value") + F.lit(0.0)  # one zero
    counted = long.where("value IS NOT NULL").withColumn("_cut", F.pmod(F.xxhash64(value), F.lit(cuts)))
    counted = counted.repartition(tasks, *keys, "_cut").groupBy(*keys, "_cut", "value").agg(F.count(F.lit(1)).alias("_rows"))
    marks = profiled.select(*keys, *[F.col(q).alias(f"_{q}") for q in QUANTILES])
    marks = marks.withColumn("_cut", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cuts - 1).cast("long"))))
    held = counted.join(marks, [*keys, "_cut"]).groupBy(*keys).agg(
        F.sum("_rows").alias("_n"), F.count(F.lit(1)).alias("_distinct"),
        *[F.sum(F.when(F.col("value") < F.col(f"_{q}"), F.col("_rows")).otherwise(0)).alias(f"_{q}_below") for q in QUANTILES],
        *[F.sum(F.when(F.col("value") <= F.col(f"_{q}"), F.col("_rows")).otherwise(0)).alias(f"_{q}_upto") for q in QUANTILES],
    )
    both = profiled.join(held, keys, "left")
    empty = F.coalesce(F.col("_n"), F.lit(0)) == 0
    ok = {f"{q}_ok": F.when(empty, F.col(q).isNull()).otherwise(
        (F.col(f"_{q}_below") <= (p + rank_error) * F.col("_n")) & (F.col(f"_{q}_upto") >= (p - rank_error) * F.col("_n")))
        for q, p in QUANTILES.items()}
    near = F.abs(F.col("n_distinct") - F.col("_distinct")) <= distinct_error * F.col("_distinct") + 1
    ok["n_distinct_ok"] = F.when(empty, F.col("n_distinct") == 0).otherwise(near)
    return both.withColumns(ok).select(*profiled.columns, *ok)
