"""Validation gates for model versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SLICE_ACCURACY = 0.55
MIN_DESCRIPTION = 20  # a description must be longer than this


def slice_gate(
    slices: DataFrame, by: Sequence[str] = (), min_accuracy: float = MIN_SLICE_ACCURACY,
    mode: str = "all", accuracy: str = "pct_acc",
) -> DataFrame:
    """A2: pass when every slice is more accurate than the threshold.

    ``mode="literal"`` passes when any slice has a non-zero accuracy, which is what a
    truth test of the column amounts to.
    """
    if mode not in ("all", "literal"):
        raise ValueError(f"unknown mode {mode!r}")
    worst, any_hit = F.min(accuracy), F.max(accuracy) != F.lit(0.0)
    ok = worst > F.lit(min_accuracy) if mode == "all" else any_hit
    return slices.groupBy(*by).agg(
        F.count(F.lit(1)).alias("slices"), worst.alias("min_accuracy"),
        F.when(ok, F.lit("pass")).otherwise(F.lit("fail")).alias("demo_test"),
    )


def signature_diff(old: DataFrame, new: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Inputs (``name``, ``type``) that were added, removed or retyped; unchanged ones stay out."""
    left = old.select(*by, "name", F.col("type").alias("old_type"))
    right = new.select(*by, "name", F.col("type").alias("new_type"))
    both = left.join(right, [*by, "name"], "full_outer")
    change = (
        F.when(F.col("old_type").isNull(), F.lit("added"))
        .when(F.col("new_type").isNull(), F.lit("removed"))
        .when(F.col("old_type") != F.col("new_type"), F.lit("retyped"))
    )
    return both.withColumn("change", change).filter(F.col("change").isNotNull())


def gate_report(
    versions: DataFrame, predictions: DataFrame, slices: DataFrame, artifacts: DataFrame,
    min_accuracy: float = MIN_SLICE_ACCURACY, min_description: int = MIN_DESCRIPTION, changes: DataFrame | None = None,
) -> DataFrame:
    """One row per version with the five gates and the overall verdict.

    With ``changes`` (J6: ``name, version, change`` of the version's inputs against the table it is to score, no row for
    one that fits) there is a sixth gate, ``signature_matches``.

    versions: ``name, version, description, signature`` (array);
    predictions: ``name, version, predicts`` (0/1); slices: ``name, version, pct_acc``,
    no row for a version without demographic slices; artifacts: ``name, version``, a row each.
    Every input is reduced to one row per version before it is joined.
    """
    key = ["name", "version"]
    scored = predictions.groupBy(*key).agg(F.min("predicts").alias("predicts"))
    tested = slice_gate(slices, key, min_accuracy).select(*key, "demo_test")
    stored = artifacts.groupBy(*key).agg(F.lit(1).alias("has_artifacts"))
    base = versions.select(
        *key,
        F.when(F.size(F.coalesce("signature", F.array())) > 0, 1).otherwise(0).alias("has_signature"),
        F.when(F.length("description") > min_description, 1).otherwise(0).alias("has_description"),
    )
    joined = base.join(scored, key, "left").join(tested, key, "left").join(stored, key, "left")
    report = joined.select(
        *key,
        F.coalesce("predicts", F.lit(0)).alias("predicts"),
        "has_signature",
        F.coalesce("demo_test", F.lit("none")).alias("demo_test"),
        "has_description",
        F.coalesce("has_artifacts", F.lit(0)).alias("has_artifacts"),
    )
    passed = ((F.col("predicts") == 1) & (F.col("has_signature") == 1) & (F.col("demo_test") == "pass")
              & (F.col("has_description") == 1) & (F.col("has_artifacts") == 1))
    if changes is not None:
        changed = changes.select(*key).distinct().withColumn("_changed", F.lit(1))
        report = report.join(changed, key, "left").withColumn(
            "signature_matches", F.lit(1) - F.coalesce("_changed", F.lit(0))).drop("_changed")
        passed = passed & (F.col("signature_matches") == 1)
    return report.withColumn("passed", passed)


def gate_tags(report: DataFrame) -> DataFrame:
    """The report as (name, version, key, value) tag rows."""
    gates = ("predicts", "has_signature", "demo_test", "has_description", "has_artifacts", "signature_matches")
    gates = [g for g in gates if g in report.columns]
    rows = F.array(*[
        F.struct(F.lit(g).alias("key"), F.col(g).cast("string").alias("value")) for g in gates
    ])
    return report.select("name", "version", F.inline(rows))
