"""Business outputs of the scoring log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.sources.tables import latest_per_key


def latest_scores(log: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """Latest score per key; it combines map-side, also for a hot key."""
    rest = [c for c in log.columns if c not in (*keys, ts, *tie)]
    return latest_per_key(log, keys, [ts, *tie]).select(*keys, ts, *tie, *rest)


def at_risk_daily(
    log: DataFrame, key: str, ts: str, prediction: str, score: str, tie: Sequence[str] = ()
) -> DataFrame:
    """O1: per day, the keys whose latest score of that day predicts the event, riskiest first."""
    dated = log.withColumn("day", F.date_trunc("day", F.col(ts)).cast("date"))
    last = latest_scores(dated.select("day", key, ts, *tie, prediction, score), ["day", key], ts, tie)
    return last.filter(F.col(prediction) == 1).orderBy("day", F.col(score).desc(), key)


def risk_evolution(log: DataFrame, ts: str, prediction: str, score: str, grain: str = "day") -> DataFrame:
    """O2: share of predicted events and mean score over time."""
    return log.groupBy(F.date_trunc(grain, F.col(ts)).alias("period")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(prediction).cast("double")).alias("risk_rate"),
        F.avg(F.col(score).cast("double")).alias("mean_score"),
    )
