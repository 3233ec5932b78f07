"""Classifier evaluation as aggregates over a scored frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.running import running_totals, same_group
from keelson.functions.text import agrees
from keelson.session import staged

ROWS = "_rows"
EPSILON = 1e-15  # probability clipping of the log loss


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; NULL where the denominator is 0."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def slice_accuracy(
    df: DataFrame, keys: Sequence[str], label: str = "label", prediction: str = "prediction", cube: bool = False
) -> DataFrame:
    """Correct rows, rows and their ratio per slice; rows with a NULL key are left out."""
    present = df.na.drop("any", subset=list(keys))
    grouped = present.cube(*keys) if cube else present.groupBy(*keys)
    return grouped.agg(
        F.sum(agrees(prediction, label)).cast("bigint").alias("acc"),
        F.count(F.lit(1)).alias("obs"),
    ).withColumn("pct_acc", ratio(F.col("acc"), F.col("obs")))


def confusion_counts(
    label: str = "label", prediction: str = "prediction", positive: int = 1, weight: str | None = None
) -> dict[str, Column]:
    """tp / fp / fn / tn as conditional counts; rows with a NULL on either side count nowhere."""
    said = F.col(prediction).cast("double") == F.lit(float(positive))
    true = F.col(label).cast("double") == F.lit(float(positive))
    return {
        "tp": _count(said & true, weight),
        "fp": _count(said & ~true, weight),
        "fn": _count(~said & true, weight),
        "tn": _count(~said & ~true, weight),
    }


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """A3: every (label, prediction) cell, empty ones included, from one aggregate row."""
    cells = [(a, p) for a in classes for p in classes]
    counts = df.agg(*[
        F.count_if((F.col(label) == F.lit(a)) & (F.col(prediction) == F.lit(p))).alias(f"c{i}")
        for i, (a, p) in enumerate(cells)
    ])
    rows = F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(f"c{i}").alias("n"))
        for i, (a, p) in enumerate(cells)
    ])
    return counts.select(F.inline(rows))


def score_counts(
    df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Positives and negatives per distinct score; this is what curves and areas are made of.

    ``weight`` names the row count of a frame that is aggregated already.
    """
    positive = F.col(label).cast("int") == F.lit(1)
    return (
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("threshold"))
        .agg(_count(positive, weight).alias("pos"), _count(~positive, weight).alias("neg"))
    )


def _count(condition: Column, weight: str | None) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)) if weight else F.count_if(condition)


def _ranked(df: DataFrame, label: str, score: str, by: Sequence[str], weight: str | None = None) -> DataFrame:
    """Per distinct score: tp / fp when everything at or above it is called positive."""
    totals = running_totals(score_counts(df, label, score, by, weight), "threshold", {"pos": "pos", "neg": "neg"}, by)
    return totals.withColumns({
        "tp": F.col("total_pos") - F.col("cum_pos") + F.col("pos"),
        "fp": F.col("total_neg") - F.col("cum_neg") + F.col("neg"),
    })


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """A5: one point per distinct score."""
    return _ranked(df, label, score, by).select(
        *by, "threshold", "tp", "fp",
        ratio(F.col("tp"), F.col("total_pos")).alias("tpr"),
        ratio(F.col("fp"), F.col("total_neg")).alias("fpr"),
    )


def pr_curve(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score."""
    return _ranked(df, label, score, by).select(
        *by, "threshold", "tp", "fp",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("total_pos")).alias("recall"),
    )


def curve_areas(
    df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Area under the ROC curve (ties by average rank) and average precision.

    Areas are NULL when only one class is present.
    """
    ranked = _ranked(df, label, score, by, weight)
    above = F.col("tp") - F.col("pos")
    roc = F.sum(F.col("neg").cast("double") * (above + F.col("pos") / F.lit(2.0)))
    step = F.col("pos") * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    sums = ranked.groupBy(*by).agg(
        roc.alias("_roc"), F.sum(step).alias("_ap"),
        F.max("total_pos").alias("n_pos"), F.max("total_neg").alias("n_neg"),
    )
    return sums.select(
        *by, "n_pos", "n_neg",
        ratio(F.col("_roc"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("roc_auc"),
        F.when(F.col("n_neg") > 0, ratio(F.col("_ap"), F.col("n_pos"))).alias("average_precision"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from tp / fp / fn / tn columns."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": or_zero(tp, tp + fp),
        "recall": or_zero(tp, tp + fn),
        "f1": or_zero(F.lit(2) * tp, F.lit(2) * tp + fp + fn),
    })


def classifier_metrics(
    df: DataFrame, by: Sequence[str] = ("split",), label: str = "label",
    prediction: str = "prediction", score: str = "score", areas: bool = True,
) -> DataFrame:
    """A4: all metrics for every group from one scan.

    ``by`` names a handful of groups, such as the parts of a split. For the areas the rows are
    counted once per (group, score, label, prediction) and stored; all metrics and the
    ranking then come from those counts.
    """
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    loss = F.when(F.col(label).cast("int") == F.lit(1), -F.ln(p)).otherwise(-F.ln(F.lit(1.0) - p))
    labelled = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    if not areas:
        return rates(labelled.groupBy(*by).agg(
            F.count(F.lit(1)).alias("example_count"),
            *[c.alias(n) for n, c in confusion_counts(label, prediction).items()],
            F.avg(loss).alias("log_loss"),
        ))
    cells = staged(labelled.groupBy(*by, label, prediction, score).agg(F.count(F.lit(1)).alias(ROWS)), "metric-cells")
    counted = cells.groupBy(*by).agg(
        F.sum(ROWS).alias("example_count"),
        *[c.alias(n) for n, c in confusion_counts(label, prediction, weight=ROWS).items()],
        ratio(F.sum(loss * F.col(ROWS)), F.sum(F.when(loss.isNotNull(), F.col(ROWS)))).alias("log_loss"),
    )
    return with_areas(rates(counted), cells, label, score, by, ROWS)


def with_areas(
    metrics: DataFrame, labelled: DataFrame, label: str, score: str, by: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Add the curve areas to one row per group."""
    areas = curve_areas(labelled, label, score, by, weight).drop("n_pos", "n_neg")
    theirs = [f"_a_{k}" for k in by]
    areas = areas.withColumnsRenamed(dict(zip(by, theirs)))
    return metrics.join(areas, same_group(by, theirs), "left").drop(*theirs)


def metric_compare(metrics: DataFrame, first: str, second: str, names: Sequence[str], by: str = "split") -> DataFrame:
    """The metrics of two parts side by side, one row per metric."""
    wide = metrics.agg(*[
        F.max(F.when(F.col(by) == part, F.col(n).cast("double"))).alias(f"{part}_{n}")
        for part in (first, second) for n in names
    ])
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("metric"), F.col(f"{first}_{n}").alias(first), F.col(f"{second}_{n}").alias(second)
        )
        for n in names
    ])
    return wide.select(F.inline(rows))
