"""Profile, quality and bias of an inference log, per time window, model and slice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.functions.running import place_in_slices, same_group
from keelson.operators.metrics import confusion_counts, rates, ratio, with_areas

ALL_ROWS = "all"
DISTINCT_ERROR = 0.05  # keeps the state of a group below 1 KB; many groups are the rule here
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def slice_names(slices: Mapping[str, str | Column]) -> Column:
    """Array of the slices a row belongs to, always including all rows."""
    hits = [
        F.when(F.expr(p) if isinstance(p, str) else p, F.lit(name)) for name, p in slices.items()
    ]
    return F.filter(F.array(F.lit(ALL_ROWS), *hits), lambda name: name.isNotNull())


def sliced(df: DataFrame, slices: Mapping[str, str | Column]) -> DataFrame:
    """One row per (row, slice) from a single scan."""
    return df.withColumn("slice", F.explode(slice_names(slices)))


def windowed(df: DataFrame, ts: str | None, window: str | None, model: str | None) -> tuple[DataFrame, list[str]]:
    """Add the window start and the model column; returns the frame and its group keys."""
    keys = []
    if ts and window:
        df = df.withColumn("window_start", F.window(ts, window)["start"])
        keys.append("window_start")
    if model:
        df = df.withColumn("model_version", F.col(model).cast("string"))
        keys.append("model_version")
    return df, keys


def with_window_end(df: DataFrame, window: str | None) -> DataFrame:
    """The end follows from the start, so it is no group key."""
    if "window_start" not in df.columns:
        return df
    end = F.col("window_start") + F.expr(f"INTERVAL {window}")
    columns = [F.col(c) for c in df.columns]
    columns.insert(df.columns.index("window_start") + 1, end.alias("window_end"))
    return df.select(*columns)


def profile(
    df: DataFrame, columns: Sequence[str], ts: str | None = None, window: str | None = None,
    model: str | None = None, slices: Mapping[str, str | Column] | None = None, exact: bool = False,
) -> DataFrame:
    """Counts, NULLs, zeros, extremes, moments, quantiles and distinct values.

    The default is one aggregate with sketch quantiles and distinct counts: every group
    shrinks to a fixed-size state before the shuffle. ``exact=True`` counts equal values
    first and ranks them per slice of the value range, so a group of any size is spread
    over many tasks.
    """
    df, keys = windowed(df, ts, window, model)
    if slices is not None:
        df = sliced(df, slices)
        keys.append("slice")
    long, keys = long_values(df, columns, keys)
    out = _exact_profile(long, keys) if exact else sketch_profile(long, keys)
    return with_window_end(out, window)


def category_profile(
    df: DataFrame, columns: Sequence[str], ts: str | None = None, window: str | None = None,
    model: str | None = None, slices: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """A9, L7 for text columns: rows, NULLs, distinct values and the most frequent one.

    Values are counted first, so the second aggregate sees a value once per task and a
    hot value costs no more than a rare one. Equal counts go to the greater value.
    """
    df, keys = windowed(df, ts, window, model)
    if slices is not None:
        df = sliced(df, slices)
        keys.append("slice")
    long, keys = long_values(df, columns, keys, "string")
    counted = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("rows"))
    seen = F.col("value").isNotNull()
    out = counted.groupBy(*keys).agg(
        F.sum("rows").alias("n"),
        F.coalesce(F.sum(F.when(~seen, F.col("rows"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
        F.max(F.when(seen, F.struct("rows", "value"))).alias("_top"),
    )
    top = {"top_value": F.col("_top.value"), "top_rows": F.col("_top.rows")}
    return with_window_end(out.withColumns(top).drop("_top"), window)


def long_values(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], dtype: str = "double"
) -> tuple[DataFrame, list[str]]:
    """One (column, value) row per profiled column, next to the group keys."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast(dtype).alias("value")) for c in columns
    ])
    long = df.select(*keys, F.explode(pairs).alias("pair")).select(*keys, "pair.column", "pair.value")
    return long, [*keys, "column"]


PROFILE_COLUMNS = ["n", "n_null", "min", "max", "mean", "std", *QUANTILES, "n_distinct", "n_zero"]


def _simple_stats() -> list[Column]:
    v = F.col("value")
    return [
        F.count(F.lit(1)).alias("n"), F.count_if(v.isNull()).alias("n_null"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.count_if(v == 0).alias("n_zero"),
    ]


def sketch_profile(long: DataFrame, keys: list[str]) -> DataFrame:
    v = F.col("value")
    out = long.groupBy(*keys).agg(
        *_simple_stats(),
        F.percentile_approx(v, F.array(*[F.lit(q) for q in QUANTILES.values()]), F.lit(10000)).alias("_q"),
        F.approx_count_distinct(v, DISTINCT_ERROR).alias("n_distinct"),
    )
    quantiles = {name: F.get("_q", F.lit(i)) for i, name in enumerate(QUANTILES)}
    return out.withColumns(quantiles).select(*keys, *PROFILE_COLUMNS)


def _exact_profile(long: DataFrame, keys: list[str]) -> DataFrame:
    """Two aggregates over the rows: one for the moments, which Spark merges without loss,
    and one that counts equal values for quantiles and distinct values."""
    ranked = _exact_ranks(long.filter(F.col("value").isNotNull()), keys)
    joined = long.groupBy(*keys).agg(*_simple_stats()).join(
        ranked, same_group(keys, [f"_q_{k}" for k in keys]), "left"
    )
    return joined.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0))).select(*keys, *PROFILE_COLUMNS)


def _exact_ranks(long: DataFrame, keys: list[str]) -> DataFrame:
    """Quantiles (linear between the two rows around the rank) and distinct values.

    Counts of equal values are summed per slice of the value range; only the few slices
    that hold a wanted rank are sorted, each in a task of its own.
    """
    counted = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("rows"))
    placed = place_in_slices(counted, "value", ["rows"])
    group = W.partitionBy(*keys)
    lower = group.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    summed = placed.groupBy(*keys, "_slice").agg(
        F.sum("rows").alias("_here"), F.count(F.lit(1)).alias("_values")
    ).withColumns({
        "_before": F.coalesce(F.sum("_here").over(lower), F.lit(0)),
        "_rows": F.sum("_here").over(group),
        "n_distinct": F.sum("_values").over(group),
    })

    places = {name: (F.col("_rows") - F.lit(1)) * F.lit(q) for name, q in QUANTILES.items()}
    ranks = {f"{name}_{side}": fn(place) for name, place in places.items()
             for side, fn in (("lo", F.floor), ("hi", F.ceil))}

    def covers(rank: Column, before: Column, count: Column) -> Column:
        return (before <= rank) & (rank < before + count)

    wanted = F.lit(False)
    for rank in ranks.values():
        wanted = wanted | covers(rank, F.col("_before"), F.col("_here"))
    targets = summed.filter(wanted).select(
        *[F.col(k).alias(f"_t_{k}") for k in keys], F.col("_slice").alias("_at"), "_before", "_rows", "n_distinct"
    )
    here = same_group([*keys, "_slice"], [*[f"_t_{k}" for k in keys], "_at"])
    inner = W.partitionBy(*keys, "_slice").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    first = F.col("_before") + F.sum("rows").over(inner) - F.col("rows")
    picked = placed.join(targets, here).withColumn("_first", first).groupBy(*keys).agg(
        F.max("_rows").alias("_rows"), F.max("n_distinct").alias("n_distinct"),
        *[F.max(F.when(covers(rank, F.col("_first"), F.col("rows")), F.col("value"))).alias(name)
          for name, rank in ranks.items()],
    )
    return picked.select(
        *[F.col(k).alias(f"_q_{k}") for k in keys], "n_distinct",
        *[(F.col(f"{n}_lo") + (p - F.floor(p)) * (F.col(f"{n}_hi") - F.col(f"{n}_lo"))).alias(n)
          for n, p in places.items()],
    )


def quality(
    df: DataFrame, label: str, prediction: str, ts: str | None = None, window: str | None = None,
    model: str | None = None, slices: Mapping[str, str | Column] | None = None, score: str | None = None,
) -> DataFrame:
    """A10: classification counts and rates per window, model and slice.

    Rows without a label or prediction are left out. With ``score`` the areas of A5 and
    A6 are added per group.
    """
    df, keys = windowed(df, ts, window, model)
    df = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    if slices is not None:
        df = sliced(df, slices)
        keys.append("slice")
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[c.alias(name) for name, c in confusion_counts(label, prediction).items()],
    )
    out = rates(counted)
    if score:
        out = with_areas(out, df, label, score, keys)
    return with_window_end(out, window)


def fairness(
    df: DataFrame, slices: Mapping[str, str | Column], label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """Rate differences, rows inside a slice minus rows outside, one aggregate for all.

    Statistical parity compares P(pred=1), equal opportunity the true positive rate,
    predictive parity the precision, predictive equality the false positive rate.
    A row whose predicate is NULL is outside.
    """
    said = F.col(prediction).cast("double") == F.lit(1.0)
    true = F.col(label).cast("double") == F.lit(1.0)
    labelled = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    columns = []
    for i, predicate in enumerate(slices.values()):
        inside = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))
        for side, hit in (("in", inside), ("out", ~inside)):
            columns += [
                F.count_if(hit).alias(f"n_{side}{i}"),
                F.count_if(hit & said).alias(f"said_{side}{i}"),
                F.count_if(hit & true).alias(f"true_{side}{i}"),
                F.count_if(hit & said & true).alias(f"tp_{side}{i}"),
            ]

    def gap(top, bottom) -> Column:
        return ratio(top("in"), bottom("in")) - ratio(top("out"), bottom("out"))

    def row(i: int, name: str) -> Column:
        def c(stem):
            return lambda side: F.col(f"{stem}_{side}{i}")

        def minus(a, b):
            return lambda side: c(a)(side) - c(b)(side)

        return F.struct(
            F.lit(name).alias("slice"),
            F.col(f"n_in{i}").alias("n_in"), F.col(f"n_out{i}").alias("n_out"),
            gap(c("said"), c("n")).alias("statistical_parity"),
            gap(c("tp"), c("true")).alias("equal_opportunity"),
            gap(c("tp"), c("said")).alias("predictive_parity"),
            gap(minus("said", "tp"), minus("n", "true")).alias("predictive_equality"),
        )

    counted = labelled.groupBy(*by).agg(*columns)
    return counted.select(*by, F.inline(F.array(*[row(i, name) for i, name in enumerate(slices)])))
