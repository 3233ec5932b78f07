"""Feature attribution: Shapley values by sampling, and permutation importance."""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.functions.hashing import bucket, shuffle_order
from keelson.functions.text import agrees
from keelson.operators.metrics import ratio
from keelson.operators.splits import sample_n

Scorer = Column | Callable[[DataFrame], DataFrame]


def _scored(df: DataFrame, scorer: Scorer) -> DataFrame:
    return df.withColumn("score", scorer) if isinstance(scorer, Column) else scorer(df)


def shapley_values(
    examples: DataFrame, background: DataFrame, features: Sequence[str], keys: Sequence[str], scorer: Scorer,
    n: int = 100, permutations: int = 1, seed: int = 7,
) -> DataFrame:
    """Attribution of each feature for at most ``n`` examples (Strumbelj & Kononenko 2014).

    Each example meets each of at most ``n`` background rows by an equi-join on a slot
    number. A permutation orders the features by a seeded hash; the contribution of a
    feature is the score with it switched to the example minus the score without. The
    result does not depend on the permutation for an additive scorer.
    """
    features, keys = list(features), list(keys)
    base = sample_n(background, keys, n, f"{seed}-background")
    slots = base.select(
        F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*keys)).alias("_slot"),  # at most n rows
        *[F.col(f).cast("double").alias(f"_b_{f}") for f in features],
    )
    chosen = sample_n(examples, keys, n, f"{seed}-example")
    drawn = chosen.select(
        *keys, *[F.col(f).cast("double").alias(f"_x_{f}") for f in features],
        F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_slot"),
    ).join(slots, "_slot")
    ordered = drawn.withColumn("_perm", F.explode(F.sequence(F.lit(1), F.lit(permutations)))).withColumns({
        f"_h_{f}": F.xxhash64(F.lit(f"{seed}|{f}"), "_slot", "_perm", *keys) for f in features
    })
    targets = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_h_{f}").alias("h")) for f in features])
    sides = ordered.withColumn("_target", F.explode(targets)).withColumn(
        "_sign", F.explode(F.array(F.lit(1.0), F.lit(-1.0)))
    )
    hybrid = sides.select(
        *keys, "_sign", F.col("_target.feature").alias("feature"),
        *[
            F.when(
                (F.col(f"_h_{f}") < F.col("_target.h"))
                | ((F.col("_target.feature") == f) & (F.col("_sign") > 0)),
                F.col(f"_x_{f}"),
            ).otherwise(F.col(f"_b_{f}")).alias(f)
            for f in features
        ],
    )
    total = F.sum(F.col("_sign") * F.col("score"))
    draws = F.count_if(F.col("_sign") > 0)
    return _scored(hybrid, scorer).groupBy(*keys, "feature").agg(ratio(total, draws).alias("attribution"))


def shapley_importance(
    examples: DataFrame, background: DataFrame, features: Sequence[str], keys: Sequence[str], scorer: Scorer,
    n: int = 100, permutations: int = 1, seed: int = 7,
) -> DataFrame:
    """Mean absolute attribution per feature, greatest first."""
    values = shapley_values(examples, background, features, keys, scorer, n, permutations, seed)
    return values.groupBy("feature").agg(
        F.avg(F.abs("attribution")).alias("importance")
    ).orderBy(F.col("importance").desc(), "feature")


def coalitions(m: int, most: int, seed: int = 7) -> list[tuple[int, float]]:
    """(mask, weight) of the coalitions of ``m`` features, without the empty and the full one.

    All of them with the Shapley kernel (m - 1) / (C(m, s) * s * (m - s)) if they are at most ``most``; else ``most`` draws, in
    pairs of a coalition and its complement, whose sizes follow the kernel's weight per size. A coalition drawn more often
    weighs more.
    """
    if 2**m - 2 <= most:
        return [(mask, (m - 1) / (math.comb(m, s) * s * (m - s))) for mask in range(1, 2**m - 1) for s in [mask.bit_count()]]
    draw, found = random.Random(seed), Counter()
    sizes = list(range(1, m))
    for s in draw.choices(sizes, [1 / (s * (m - s)) for s in sizes], k=most // 2):
        mask = sum(1 << j for j in draw.sample(range(m), s))
        found[mask] += 1
        found[2**m - 1 - mask] += 1
    return [(mask, float(n)) for mask, n in sorted(found.items())]


def kernel_weights(m: int, masks: Sequence[tuple[int, float]]) -> dict[int, list[float]]:
    """How much the value of each coalition counts for each attribution.

    The weighted least squares of the values on the members, with the sum of all attributions fixed to
    f(x) - f(nothing), is linear in the values. Its normal matrix depends on the coalitions alone, so it is solved once; the
    right-hand sides are then sums over an example's coalitions.
    """
    if m == 1:
        return {0: [-1.0], 1: [1.0]}
    z = np.array([[mask >> j & 1 for j in range(m)] for mask, _ in masks], dtype=float)
    w = np.array([weight for _, weight in masks])
    free = z[:, :-1] - z[:, -1:]
    solved = np.linalg.pinv((free * w[:, None]).T @ free) @ (free * w[:, None]).T  # free attributions per coalition
    part = np.vstack([solved, -solved.sum(axis=0)])
    # The value of a coalition counts less f(nothing), and less f(x) - f(nothing) where the last feature is in it.
    last, out = part @ z[:, -1], {}
    unit = np.zeros(m)
    unit[-1] = 1.0
    for (mask, _), column in zip(masks, part.T):
        out[mask] = column.tolist()
    out[2**m - 1] = (unit - last).tolist()
    out[0] = (last - unit - part.sum(axis=1)).tolist()
    return out


def kernel_values(
    examples: DataFrame, background: DataFrame, features: Sequence[str], keys: Sequence[str], scorer: Scorer,
    n: int = 100, most: int = 2048, seed: int = 7,
) -> DataFrame:
    """Attributions by kernel-weighted least squares (Lundberg & Lee 2017) for at most ``n`` examples.

    The value of a coalition is the mean score over at most ``n`` background rows with the coalition's features taken from the
    example. Attributions add up to the score less the mean score of the background, whatever coalitions
    are drawn; with all coalitions they are the Shapley values, interactions of any order included.
    """
    features, keys = list(features), list(keys)
    masks = coalitions(len(features), most, seed)
    weights = kernel_weights(len(features), masks)
    base = sample_n(background, keys, n, f"{seed}-background")
    slots = base.select(
        F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*keys)).alias("_slot"),  # at most n rows
        *[F.col(f).cast("double").alias(f"_b_{f}") for f in features])
    chosen = sample_n(examples, keys, n, f"{seed}-example")
    met = chosen.select(
        *keys, *[F.col(f).cast("double").alias(f"_x_{f}") for f in features], F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_slot"),
    ).join(slots, "_slot").withColumn("_mask", F.explode(F.array(*[F.lit(mask).cast("long") for mask in weights])))
    hybrid = met.select(*keys, "_mask", *[
        F.when(F.col("_mask").bitwiseAND(F.lit(1 << j).cast("long")) != 0, F.col(f"_x_{f}")).otherwise(F.col(f"_b_{f}")).alias(f)
        for j, f in enumerate(features)])
    values = _scored(hybrid, scorer).groupBy(*keys, "_mask").agg(F.avg("score").alias("_value"))
    table = examples.sparkSession.createDataFrame(list(weights.items()), "_mask long, _weights array<double>")
    summed = values.join(F.broadcast(table), "_mask").groupBy(*keys).agg(*[  # a row per coalition, at most ``most`` and two
        F.sum(F.col("_value") * F.get("_weights", F.lit(j))).alias(f"_a_{j}") for j in range(len(features))])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_a_{j}").alias("attribution")) for j, f in enumerate(features)])
    return summed.select(*keys, F.inline(rows))


def permutation_importance(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], label: str, scorer: Scorer,
    cut: float = 0.5, seed: int = 7, blocks: int = 200,
) -> DataFrame:
    """Drop in accuracy when one feature is shuffled (Breiman 2001), over all rows.

    Rows are spread over ``blocks`` hashed blocks and sorted once, in a seeded order; the
    first feature's values move on by one place within a block, the second's by two, and
    so on. At most ``blocks`` tasks sort the rows, a block each: a large table takes more blocks by the parameter, never by its
    size alone, so the result of a call does not depend on what else is in the cluster.
    """
    features = list(features)
    placed = df.withColumn("_block", bucket(*keys, buckets=blocks, salt=f"{seed}-block"))
    moved = placed
    ring = W.partitionBy("_block").orderBy(shuffle_order(*keys, seed=seed), *keys)
    whole = ring.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.count(F.lit(1)).over(W.partitionBy("_block")) - F.row_number().over(ring)
    moved = moved.withColumn("_left", left)
    for shift, f in enumerate(features, start=1):
        value = F.lead(f, shift).over(ring)
        for back in range(shift):  # the last rows of a block take its first values
            value = F.when(F.col("_left") == back, F.nth_value(f, shift - back).over(whole)).otherwise(value)
        moved = moved.withColumn(f"_moved_{f}", value)
    names = F.array(F.lit(""), *[F.lit(f) for f in features])
    variants = moved.withColumn("feature", F.explode(names)).select(
        "feature", F.col(label).alias("_label"),
        *[F.when(F.col("feature") == f, F.col(f"_moved_{f}")).otherwise(F.col(f)).alias(f) for f in features],
    )
    said = F.when(F.col("score") > F.lit(cut), 1).otherwise(0)
    hit = agrees(said, "_label")
    counted = _scored(variants, scorer).agg(*[
        F.avg(F.when(F.col("feature") == f, hit.cast("double"))).alias(f"_acc_{i}")
        for i, f in enumerate(["", *features])
    ])
    rows = F.array(*[
        F.struct(
            F.lit(f).alias("feature"), F.col("_acc_0").alias("accuracy"),
            F.col(f"_acc_{i}").alias("shuffled_accuracy"),
            (F.col("_acc_0") - F.col(f"_acc_{i}")).alias("importance"),
        )
        for i, f in enumerate(features, start=1)
    ])
    return counted.select(F.inline(rows))
