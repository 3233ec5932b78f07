"""Second-order boosting: gradients and Hessians per row, one histogram aggregate per level."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.functions.text import quote_name
from keelson.session import staged

BINS = 32
STORE_EVERY = 5  # trees between two stored margins, which bounds the expressions of a plan
TIES = 9  # digits in which two gains differ


@dataclass(frozen=True)
class Boosting:
    """Settings. A learning rate above 1 is allowed; ``columns`` is the share of the features each tree may use."""

    rounds: int = 50
    depth: int = 4
    learning_rate: float = 0.2
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    min_gain: float = 0.0
    columns: float = 1.0
    bins: int = BINS
    seed: int = 7


@dataclass(frozen=True)
class Node:
    """A node by its heap number: root 1, children 2n (bin at most ``bin``) and 2n + 1. A leaf has a weight and no feature."""

    node: int
    weight: float | None = None
    feature: int | None = None
    bin: int | None = None
    gain: float | None = None


@dataclass
class BoostedTrees:
    """Fitted trees: the edges of every feature's bins, and the nodes of each tree."""

    features: list[str]
    edges: list[list[float]]
    trees: list[list[Node]] = field(default_factory=list)

    def margin(self, df: DataFrame) -> Column:
        """The log odds of class 1 as one expression over the raw columns."""
        found = [bin_of(F.col(quote_name(c)), e) for c, e in zip(self.features, self.edges)]
        total = F.lit(0.0)
        for tree in self.trees:
            total = total + leaf_weight(tree, found)
        return total

    def score(self, df: DataFrame) -> DataFrame:
        """``score``, the probability of class 1, and ``prediction``."""
        scored = df.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(df))))
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "edges": self.edges, "trees": [[asdict(n) for n in t] for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> BoostedTrees:
        state = json.loads(text)
        return BoostedTrees(state["features"], state["edges"], [[Node(**n) for n in t] for t in state["trees"]])


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """How many edges lie below the value; NULL and NaN count as lowest."""
    known = value.cast("double")
    out = F.lit(0)
    for e in edges:
        out = out + F.when(known > F.lit(float(e)), 1).otherwise(0)
    return F.when(known.isNull() | F.isnan(known), 0).otherwise(out)


def node_of(tree: Sequence[Node], bins: Sequence[Column]) -> Column:
    """The node of the tree so far that a row lies in."""
    by_number = {n.node: n for n in tree}

    def below(number: int) -> Column:
        node = by_number.get(number)
        if node is None or node.feature is None:
            return F.lit(number)
        return F.when(bins[node.feature] <= node.bin, below(2 * number)).otherwise(below(2 * number + 1))

    return below(1)


def leaf_weight(tree: Sequence[Node], bins: Sequence[Column]) -> Column:
    by_number = {n.node: n for n in tree}

    def below(number: int) -> Column:
        node = by_number[number]
        if node.feature is None:
            return F.lit(float(node.weight))
        return F.when(bins[node.feature] <= node.bin, below(2 * number)).otherwise(below(2 * number + 1))

    return below(1)


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """At most ``bins`` - 1 distinct approximate quantiles per feature, from one aggregate."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    values = [F.percentile_approx(F.nanvl(F.col(quote_name(c)).cast("double"), F.lit(None).cast("double")), shares, F.lit(10_000)) for c in features]
    found = df.agg(*[v.alias(f"q{i}") for i, v in enumerate(values)]).first()
    return [sorted(set(q or [])) for q in found]


def _best_splits(rows: DataFrame, node: Column, allowed: Sequence[int], settings: Boosting) -> dict[int, Node]:
    """The best split of every open node: sums per node, feature and bin in one aggregate, running sums over the bins.

    Only a row per node comes to the driver. Equal gains go to the first feature and lowest bin.
    """
    cells = F.array(*[F.struct(F.lit(j).alias("feature"), F.col(f"_b{j}").alias("bin")) for j in allowed])
    summed = rows.select(node.alias("node"), "_g", "_h", F.explode(cells).alias("c")).groupBy("node", "c.feature", "c.bin").agg(
        F.sum("_g").alias("g"), F.sum("_h").alias("h"))
    one = W.partitionBy("node", "feature")  # at most a row per bin
    upto = one.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    sides = summed.withColumns({"gl": F.sum("g").over(upto), "hl": F.sum("h").over(upto), "ga": F.sum("g").over(one), "ha": F.sum("h").over(one)})
    sides = sides.withColumns({"gr": F.col("ga") - F.col("gl"), "hr": F.col("ha") - F.col("hl")})
    reg = F.lit(settings.reg_lambda)

    def part(g: str, h: str) -> Column:
        return F.col(g) * F.col(g) / (F.col(h) + reg)

    gain = F.round((part("gl", "hl") + part("gr", "hr") - part("ga", "ha")) / F.lit(2.0), TIES)
    fits = (F.col("hl") >= settings.min_child_weight) & (F.col("hr") >= settings.min_child_weight)
    open_ = sides.withColumn("gain", gain).filter(fits & (F.col("gain") > settings.min_gain))
    best = open_.groupBy("node").agg(F.max(F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("b"))
    return {r["node"]: Node(r["node"], None, -r["b"][1], -r["b"][2], r["b"][0]) for r in best.collect()}


def fit_boosted(
    df: DataFrame, features: Sequence[str], label: str, settings: Boosting = Boosting(), edges: Mapping[str, Sequence[float]] | None = None,
) -> BoostedTrees:
    """L1: boosted trees for a 0/1 label by second-order steps on the logistic loss (Chen & Guestrin 2016).

    Every feature is cut into bins once, at quantiles or the given ``edges``. A round takes gradient and Hessian of every
    row from its margin and grows a tree level by level: one aggregate per level sums both per node, feature and bin, whatever the
    number of rows, and the split of each node is the one of most gain whose sides weigh at least ``min_child_weight`` Hessian.
    A leaf's weight is -G / (H + lambda) times the learning rate. Rows without a label are left out; NULL features lie in the
    lowest bin. Margins are stored every few trees, so plans do not grow with the rounds.
    """
    features = list(features)
    rows = df.filter(F.col(label).isNotNull())
    cuts = [sorted(map(float, edges[c])) for c in features] if edges else quantile_edges(rows, features, settings.bins)
    model, draw = BoostedTrees(features, cuts), random.Random(settings.seed)
    rows = staged(rows.select(
        *[bin_of(F.col(quote_name(c)), e).alias(f"_b{j}") for j, (c, e) in enumerate(zip(features, cuts))],
        F.col(label).cast("double").alias("_y"), F.lit(0.0).alias("_m")), "binned")
    bins = [F.col(f"_b{j}") for j in range(len(features))]
    margin = F.col("_m")
    for done in range(settings.rounds):
        if done and done % STORE_EVERY == 0:
            rows, margin = staged(rows.withColumn("_m", margin), "binned"), F.col("_m")
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        graded = rows.select(*bins, (p - F.col("_y")).alias("_g"), (p * (F.lit(1.0) - p)).alias("_h"))
        some = max(1, round(settings.columns * len(features)))
        allowed = sorted(draw.sample(range(len(features)), some))
        tree: dict[int, Node] = {}
        for _ in range(settings.depth):
            node = node_of(list(tree.values()), bins)
            splits = _best_splits(graded, node, allowed, settings)
            splits = {n: s for n, s in splits.items() if n not in tree}  # nodes that found no split stay leaves
            if not splits:
                break
            tree |= splits
        node = node_of(list(tree.values()), bins)
        weights = graded.groupBy(node.alias("node")).agg((-F.sum("_g") / (F.sum("_h") + F.lit(settings.reg_lambda))).alias("w"))
        leaves = {r["node"]: r["w"] * settings.learning_rate for r in weights.collect()}  # at most a row per leaf
        if not leaves:
            break
        wanted = {c for n in tree for c in (2 * n, 2 * n + 1)} - tree.keys() or {1}
        nodes = [*tree.values(), *[Node(n, leaves.get(n, 0.0)) for n in sorted(wanted)]]
        model.trees.append(nodes)
        margin = margin + leaf_weight(nodes, bins)
    return model
