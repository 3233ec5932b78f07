"""A search that learns: tree-structured Parzen estimation over finished trials, and patience over rounds."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.functions.hashing import HEX_DIGITS

GAMMA, PRIOR, CANDIDATES = 1.0, 1.0, 24
Space = Mapping[str, Sequence[object]]


def is_number(values: Sequence[object]) -> bool:
    return all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in values)


def space_table(spark: SparkSession, space: Space) -> DataFrame:
    """(param, value, place, x, width): the values in their order, numbers with the mean distance between neighbours."""
    rows = []
    for name, values in space.items():
        number = is_number(values) and len(values) > 1
        width = (float(max(values)) - float(min(values))) / (len(values) - 1) if number else None
        rows += [(name, str(v), i, float(v) if number else None, width) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "param string, value string, place int, x double, width double")


def good_trials(trials: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """The finished trials with ``good``: the ceil(``gamma`` * sqrt(n)) of the smallest loss, ties to the smaller id."""
    done = trials.filter((F.col("status") == "FINISHED") & F.col("loss").isNotNull() & ~F.isnan("loss"))
    n = done.count()
    best = done.orderBy("loss", "trial_id").limit(max(1, math.ceil(gamma * math.sqrt(n))))
    worst = best.agg(F.max(F.struct("loss", "trial_id")).alias("w")).scalar()
    return done.withColumn("good", F.struct("loss", "trial_id") <= worst)


def densities(trials: DataFrame, space: Space, gamma: float = GAMMA, prior: float = PRIOR) -> DataFrame:
    """(param, value, good, bad, gain): how often good and other finished trials take each value, as laws over the space.

    Every trial adds a kernel: for numbers a Gaussian as wide as the mean distance between neighbouring values, else the
    value itself. ``prior`` spreads the weight of so many trials evenly, so no value is ever ruled out. ``gain`` is
    ln(good / bad). Trials are counted per value before kernels are laid, so any number of them will do; values
    outside the space are left out.
    """
    places = space_table(trials.sparkSession, space)
    taken = good_trials(trials, gamma).select("good", F.explode(F.map_entries("params")).alias("p"))
    counted = taken.groupBy(F.col("p.key").alias("param"), F.col("p.value").alias("value")).agg(
        F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"))
    known = places.join(counted, ["param", "value"], "left").fillna(0, ["n_good", "n_bad"])
    source = known.select(F.col("param").alias("p"), F.col("value").alias("v"), F.col("x").alias("y"), "n_good", "n_bad")
    step = (F.col("x") - F.col("y")) / F.col("width")
    kernel = F.when(F.col("x").isNull() | (F.col("width") == 0), (F.col("value") == F.col("v")).cast("double")).otherwise(
        F.exp(-step * step / F.lit(2.0)))
    laid = places.join(source, F.col("param") == F.col("p")).groupBy("param", "value", "place").agg(
        F.sum(kernel * F.col("n_good")).alias("good"), F.sum(kernel * F.col("n_bad")).alias("bad"), F.count(F.lit(1)).alias("size"))
    whole = W.partitionBy("param")  # a row per value of the space

    def law(c: str) -> Column:
        mass = F.col(c) + F.lit(float(prior)) / F.col("size")
        return mass / F.sum(mass).over(whole)

    out = laid.select("param", "value", "place", law("good").alias("good"), law("bad").alias("bad"))
    return out.withColumn("gain", F.ln(F.col("good") / F.col("bad")))


def uniform(*keys: str | Column) -> Column:
    """A number from 0 to 1 out of the MD5 of the keys' texts."""
    text = F.concat_ws("|", *[F.col(k).cast("string") if isinstance(k, str) else k for k in keys])
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("bigint") / F.lit(float(16**HEX_DIGITS))


def propose(laws: DataFrame, n: int, seed: int = 7, candidates: int = CANDIDATES) -> DataFrame:
    """(proposal, candidate, params, gain) of ``n`` proposals for parallel fits.

    Each proposal draws ``candidates`` settings, every parameter from its law of good trials, and keeps the one of the
    highest sum of gains, the earliest of equals. Draws are hashes of seed, proposal, candidate and parameter.
    """
    order = W.partitionBy("param").orderBy("place")
    upto = laws.withColumns({
        "high": F.sum("good").over(order), "last": F.row_number().over(W.partitionBy("param").orderBy(F.desc("place"))) == 1})
    steps = upto.withColumns({"low": F.col("high") - F.col("good"), "high": F.when(F.col("last"), F.lit(2.0)).otherwise(F.col("high"))})
    params = laws.agg(F.collect_set("param").alias("p")).scalar()  # the names of the space
    draws = laws.sparkSession.range(n).select(F.col("id").alias("proposal"), F.explode(F.sequence(F.lit(0), F.lit(candidates - 1))).alias("candidate"))
    points = draws.withColumn("param", F.explode(params)).withColumn("u", uniform(F.lit(str(seed)), "proposal", "candidate", "param"))
    drawn = points.join(steps, "param").filter((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
    settings = drawn.groupBy("proposal", "candidate").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("param", "value")))).alias("params"), F.sum("gain").alias("gain"))
    best = settings.groupBy("proposal").agg(F.max_by(F.struct("candidate", "params", "gain"), F.struct(F.round("gain", 9), -F.col("candidate"))).alias("b"))
    return best.select("proposal", "b.candidate", "b.params", "b.gain")


def settings_of(proposals: DataFrame, space: Space) -> list[dict]:
    """Proposals as settings with the space's own values; one per wanted fit."""
    by_text = {name: {str(v): v for v in values} for name, values in space.items()}
    return [{k: by_text[k][v] for k, v in r["params"].items()} for r in proposals.orderBy("proposal").collect()]


# --- patience -------------------------------------------------------------------

def patience_stop(losses: DataFrame, by: Sequence[str], order: str = "round", loss: str = "loss", patience: int = 5) -> DataFrame:
    """L2: per series of losses (``by``, best_round, best_loss, stop_round, rounds): training stops after ``patience`` rounds
    without a loss below the best so far and keeps the rounds up to that best, the first of equals.

    Rounds are numbered from 1 by ``order``; a NULL or NaN loss is never the best. A series without any loss keeps no round.
    """
    series = W.partitionBy(*by).orderBy(order)
    value = F.when(~F.isnan(loss), F.col(loss))
    numbered = losses.withColumns({"_n": F.row_number().over(series), "_loss": value})
    sofar = series.rowsBetween(W.unboundedPreceding, W.currentRow)
    best = numbered.withColumn("_best", F.min(F.when(F.col("_loss").isNotNull(), F.struct("_loss", "_n"))).over(sofar))
    late = F.col("_n") - F.coalesce(F.col("_best._n"), F.lit(0)) >= patience
    ends = best.groupBy(*by).agg(
        F.min(F.when(late, F.struct("_n", "_best"))).alias("_stop"), F.max(F.struct("_n", "_best")).alias("_last"), F.max("_n").alias("rounds"))
    kept = F.coalesce("_stop", "_last")
    return ends.select(*by, kept["_best"]["_n"].alias("best_round"), kept["_best"]["_loss"].alias("best_loss"), kept["_n"].alias("stop_round"), "rounds")


def kept_rounds(losses: Sequence[float], patience: int = 5) -> int:
    """:func:`patience_stop` for one fit's losses."""
    best, kept = math.inf, 0
    for n, loss in enumerate(losses, 1):
        if loss < best:
            best, kept = loss, n
        elif n - kept >= patience:
            break
    return kept
