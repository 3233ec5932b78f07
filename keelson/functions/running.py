"""Running totals over a global order without a single-task window.

A plain ``Window.orderBy(value)`` pulls every row into one task. Here the value range is
cut into slices at approximate quantiles, each slice is windowed on its own, and the
totals of the lower slices (at most ``slices`` rows per group, by default as many as there are
shuffle partitions) are added as an offset.
A slice is a pure function of the value, so a recomputed task lands on the same slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.session import shuffle_width, staged


def place_in_slices(
    df: DataFrame, order: str, measures: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Add ``_slice``, the slice of the value range that ``order`` falls in.

    Slices hold about the same number of rows of ``df`` each. A NULL goes to slice 0.
    """
    width = max(2, slices or shuffle_width(df.sparkSession))
    fractions = [i / width for i in range(1, width)]
    # The measures ride along so that the subquery reads the same shuffle as the rest.
    cuts = df.agg(F.struct(
        F.percentile_approx(F.col(order).cast("double"), F.lit(fractions), F.lit(max(1000, 8 * width))).alias("cuts"),
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(measures)],
    )).scalar().getField("cuts")

    # Binary search; one small projection per halving step stays inside generated code.
    step = 1
    while step * 2 < width:
        step *= 2
    value = F.col(order).cast("double")
    df = df.withColumns({"_cuts": cuts, "_slice": F.lit(0)})
    while step:
        reached = F.get(F.col("_cuts"), F.col("_slice") + F.lit(step - 1)) <= value
        df = df.withColumn("_slice", F.col("_slice") + F.when(reached, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return df.drop("_cuts")


def same_group(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of two lists of key columns."""
    match = F.lit(True)
    for a, b in zip(left, right):
        match = match & F.col(a).eqNullSafe(F.col(b))
    return match


def running_totals(
    df: DataFrame,
    order: str,
    measures: Mapping[str, str],
    by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Add inclusive running sums in ascending ``order`` and the group totals.

    ``df`` should hold one row per (``by``, ``order``) value, that is, be aggregated
    already. ``measures`` maps a numeric column to its output stem: the result carries
    ``cum_<stem>`` and ``total_<stem>``, plus ``next_value``, the following value of
    ``order`` inside the group.
    """
    by = list(by)
    placed = place_in_slices(df, order, list(measures), slices)
    per_slice = placed.groupBy(*by, "_slice").agg(
        *[F.sum(c).alias(f"_sum_{stem}") for c, stem in measures.items()],
        F.min(order).alias("_low"),
    )
    group = W.partitionBy(*(by or [F.lit(0)]))
    lower = group.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_slice.select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)],
        F.col("_slice").alias("_offset_slice"),
        *[F.coalesce(F.sum(f"_sum_{s}").over(lower), F.lit(0)).alias(f"_before_{s}") for s in measures.values()],
        *[F.sum(f"_sum_{s}").over(group).alias(f"total_{s}") for s in measures.values()],
        F.lead("_low").over(group.orderBy("_slice")).alias("_next_low"),
    )
    match = (F.col("_slice") == F.col("_offset_slice")) & same_group(by, [f"_by_{i}" for i in range(len(by))])

    inner = W.partitionBy(*by, "_slice").orderBy(order)
    upto = inner.rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        placed.join(offsets, match)
        .withColumns(
            {
                **{
                    f"cum_{stem}": F.col(f"_before_{stem}") + F.sum(c).over(upto)
                    for c, stem in measures.items()
                },
                "next_value": F.coalesce(F.lead(order).over(inner), F.col("_next_low")),
            }
        )
        .drop(
            "_slice", "_offset_slice", "_next_low",
            *[f"_by_{i}" for i in range(len(by))],
            *[f"_before_{s}" for s in measures.values()],
        )
    )


def numbered(df: DataFrame, order: Sequence[str], output: str = "index") -> DataFrame:
    """Number rows from 0 in ascending ``order``, which tells any two of them apart.

    Range slices are stored, each is numbered in a task of its own, and the sizes of the lower slices (a row per slice)
    are added. So neither a sort nor a window of all rows meets in one task.
    """
    placed = staged(df.repartitionByRange(shuffle_width(df.sparkSession), *order).withColumn("_slice", F.spark_partition_id()), "numbered")
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    lower = W.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("_slice", F.coalesce(F.sum("_size").over(lower), F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("_slice").orderBy(*order))
    return placed.join(before, "_slice").withColumn(output, F.col("_before") + place - 1).drop("_slice", "_before")
