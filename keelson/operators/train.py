"""Training, early stopping, search and model comparison with ``pyspark.ml``."""

from __future__ import annotations

import random
import threading
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.text import quote_name
from keelson.operators.features import NumericSpec, WideEncoder, fit_vocab, wide_one_hot
from keelson.operators.metrics import classifier_metrics
from keelson.operators.score import MODEL_ERRORS
from keelson.operators.search import Space, densities, kept_rounds, propose, settings_of
from keelson.session import shared_dir, staging

IN = "_in_"
METRICS = ("accuracy", "precision", "recall", "f1", "log_loss", "roc_auc", "average_precision")
TRIAL_SCHEMA = (
    "trial_id string, family string, status string, params map<string,string>, "
    "metrics map<string,double>, loss double, seconds double"
)
DEFAULT_PARAMS = {
    "max_depth": 5, "rounds": 20, "learning_rate": 0.1, "subsample": 1.0,
    "features_per_node": "all", "min_rows_per_node": 1, "seed": 7,
}
PATIENCE = 5
WATCH_SECONDS = 0.2


def gbt(params: Mapping[str, object], label: str) -> GBTClassifier:
    """L1: boosted trees."""
    p = {**DEFAULT_PARAMS, **params}
    return GBTClassifier(
        featuresCol="features", labelCol=label, maxDepth=int(p["max_depth"]), maxIter=int(p["rounds"]),
        stepSize=float(p["learning_rate"]), subsamplingRate=float(p["subsample"]),
        featureSubsetStrategy=str(p["features_per_node"]), minInstancesPerNode=int(p["min_rows_per_node"]),
        seed=int(p["seed"]), checkpointInterval=10,
    )


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` boosting rounds: the same trees, weights and columns."""
    java = model._java_obj
    trees, weights = java.trees(), java.treeWeights()
    jvm = SparkSession.active().sparkContext._gateway
    kept = jvm.new_array(jvm.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    shares = jvm.new_array(jvm.jvm.double, rounds)
    for i in range(rounds):
        kept[i], shares[i] = trees[i], weights[i]
    short = jvm.jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), kept, shares)
    return GBTClassificationModel(java.copyValues(short, java.extractParamMap()))


def validation_losses(model: GBTClassificationModel, rows: DataFrame) -> list[float]:
    """L2: the loss of every boosting round on rows with ``features`` and label, from one pass over the trees."""
    return list(model.evaluateEachIteration(rows))


def estimator(family: str, params: Mapping[str, object], label: str):
    """A classifier of a family on the ``features`` vector."""
    p = {**DEFAULT_PARAMS, **params}
    common = {"featuresCol": "features", "labelCol": label}
    if family == "gbt":
        return gbt(params, label)
    if family == "logistic":
        return LogisticRegression(**common, regParam=float(p.get("reg", 0.01)), maxIter=int(p.get("iterations", 30)))
    if family == "tree":
        return DecisionTreeClassifier(**common, maxDepth=int(p.get("max_depth", 4)), seed=int(p["seed"]))
    if family == "forest":
        return RandomForestClassifier(
            **common, maxDepth=int(p.get("max_depth", 4)), numTrees=int(p.get("trees", 20)),
            subsamplingRate=float(p["subsample"]), seed=int(p["seed"]),
        )
    raise ValueError(f"unknown family {family!r}")


FAMILIES = ("logistic", "tree", "forest", "gbt")


def preprocessing(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), passthrough: Sequence[str] = (),
) -> tuple[list, list[str]]:
    """Stages fitted on the train rows, and the vector's columns in order.

    Numeric columns are coerced, filled with the mean and standardised; a categorical one
    becomes an indicator per value but the first; a passed-through one is coerced, and NULL
    becomes 0. The fitted values are literals of one SQL stage, so they are saved with the
    model, and columns the model does not name are ignored at scoring.
    """
    spec = NumericSpec(list(numeric)).fit(train) if numeric else None
    vocab = fit_vocab(train, categorical) if categorical else {}
    cells = []
    for c in numeric:
        scale = spec.scales[c] or 1.0
        cells.append((f"{IN}{c}", f"(coalesce(try_cast({quote_name(c)} as double), {spec.means[c]!r}D) - {spec.means[c]!r}D) / {scale!r}D"))
    for c in categorical:
        for v in vocab[c][1:]:
            text = v.replace("\\", "\\\\").replace("'", "\\'")
            cells.append((f"{IN}{c}_{v}", f"cast(coalesce(cast({quote_name(c)} as string) = '{text}', false) as double)"))
    cells += [(f"{IN}{c}", f"coalesce(try_cast({quote_name(c)} as double), 0.0D)") for c in passthrough]
    names = [f"{IN}{i}" for i in range(len(cells))]  # plain names: a value may hold any character
    chosen = ", ".join(f"{sql} AS {n}" for n, (_, sql) in zip(names, cells))
    stages = [SQLTransformer(statement=f"SELECT *, {chosen} FROM __THIS__"), VectorAssembler(inputCols=names, outputCol="features")]
    return stages, [n.removeprefix(IN) for n, _ in cells]


def fit(
    df: DataFrame, features: Sequence[str], label: str, family: str = "gbt",
    params: Mapping[str, object] | None = None, split: str = "split",
    categorical: Sequence[str] = (), passthrough: Sequence[str] = (), patience: int = PATIENCE,
):
    """Fit preprocessing and classifier on the train part (boosting watches the val part).

    Boosting runs all its rounds and keeps those up to the best one on the val part, as if it had stopped
    after ``patience`` rounds without gain there; without val rows, or with ``patience`` 0, it keeps all. Returns a PipelineModel that takes
    the raw columns: numeric ``features``, ``categorical`` and ``passthrough`` ones (see :func:`preprocessing`).
    """
    shared_dir(df.sparkSession)  # deep tree lineages are checkpointed there
    rows, val = df.filter(F.col(split) == "train"), df.filter(F.col(split) == "val")
    stages, _ = preprocessing(rows, features, categorical, passthrough)
    model = Pipeline(stages=[*stages, estimator(family, params or {}, label)]).fit(rows)
    if family == "gbt" and patience and not val.isEmpty():
        *prepare, trees = model.stages
        losses = validation_losses(trees, PipelineModel(stages=prepare).transform(val))
        model = PipelineModel(stages=[*prepare, first_trees(trees, max(1, kept_rounds(losses, patience)))])
    return model


@dataclass(frozen=True)
class WideModel:
    """A classifier on a wide sparse vector beside the usual columns: a table of slots and a pipeline."""

    encoder: WideEncoder
    pipeline: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.encoder.transform(df)).drop(self.encoder.output, f"{IN}narrow")

    def save(self, path: str) -> None:
        self.encoder.save(f"{path}/encoder")
        self.pipeline.write().overwrite().save(f"{path}/pipeline")

    @staticmethod
    def load(spark: SparkSession, path: str) -> WideModel:
        return WideModel(WideEncoder.load(spark, f"{path}/encoder"), PipelineModel.load(f"{path}/pipeline"))


def fit_wide(
    df: DataFrame, wide: Sequence[str], features: Sequence[str], label: str, family: str = "logistic",
    params: Mapping[str, object] | None = None, split: str = "split", categorical: Sequence[str] = (), passthrough: Sequence[str] = (),
) -> WideModel:
    """L3, P5: :func:`fit` with columns of any number of values, whose slots and weights come from the train part."""
    rows = df.filter(F.col(split) == "train")
    encoder = wide_one_hot(rows, wide, f"{IN}wide")
    stages, _ = preprocessing(rows, features, categorical, passthrough)
    stages[-1].setOutputCol(f"{IN}narrow")
    both = VectorAssembler(inputCols=[f"{IN}narrow", encoder.output], outputCol="features")
    return WideModel(encoder, Pipeline(stages=[*stages, both, estimator(family, params or {}, label)]).fit(encoder.transform(rows)))


def score(model, df: DataFrame) -> DataFrame:
    """Prediction as int and probability of class 1 as ``score``."""
    out = model.transform(df)
    return out.withColumns({
        "score": F.get(vector_to_array("probability"), F.lit(1)),
        "prediction": F.col("prediction").cast("int"),
    }).drop("features", "rawPrediction", "probability", *[c for c in out.columns if c.startswith(IN)])


def trial_metrics(model, df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """L4: one transform over all rows, metrics per part."""
    scored = score(model, df).withColumn("label", F.col(label).cast("int"))
    return classifier_metrics(scored, (split,))


class Budget:
    """A deadline that ends the Spark jobs of a block of work once it has passed.

    Jobs started inside the block carry a tag of their own; a watcher cancels the jobs of that tag from the deadline on, so
    the work ends with its running tasks at the latest.
    """

    def __init__(self, spark: SparkSession, seconds: float):
        self.context, self.deadline = spark.sparkContext, time.monotonic() + seconds

    @property
    def over(self) -> bool:
        return time.monotonic() > self.deadline

    @contextmanager
    def ending(self) -> Iterator[None]:
        tag, done = f"budget-{uuid.uuid4().hex}", threading.Event()

        def watch() -> None:
            if not done.wait(max(0.0, self.deadline - time.monotonic())):
                while not done.wait(WATCH_SECONDS):  # the work may be between two jobs
                    self.context.cancelJobsWithTag(tag)

        watcher = threading.Thread(target=watch, daemon=True)
        self.context.addJobTag(tag)
        watcher.start()
        try:
            yield
        finally:
            done.set()
            watcher.join()
            self.context.removeJobTag(tag)


def run_trial(
    df: DataFrame, features: Sequence[str], label: str, trial_id: str, family: str,
    params: Mapping[str, object], split: str = "split", budget: Budget | None = None,
) -> dict:
    """L4: fit and evaluate one candidate; the loss is the negative validation F1. One that its ``budget`` ends is CUT."""
    started = time.monotonic()
    metrics, status = {}, "FINISHED"
    try:
        with budget.ending() if budget else nullcontext():
            model = fit(df, features, label, family, params, split)
            for r in trial_metrics(model, df, label, split).collect():
                metrics |= {f"{r[split]}_{m}": float(r[m]) for m in METRICS if r[m] is not None}
    except Exception as e:  # settings that cannot be fitted lose this trial, not the search
        if budget and budget.over:
            metrics, status = {}, "CUT"
        elif isinstance(e, (*MODEL_ERRORS, TypeError, ValueError)):
            status = "FAILED"
        else:
            raise
    return {
        "trial_id": trial_id, "family": family, "status": status,
        "params": {k: str(v) for k, v in params.items()}, "metrics": metrics,
        "loss": -metrics.get("val_f1", 0.0) if status == "FINISHED" else None, "seconds": time.monotonic() - started,
    }


def candidates(space: Mapping[str, Sequence[object]], n: int, seed: int) -> list[dict]:
    """``n`` seeded random draws from a space of value lists."""
    draw = random.Random(seed)
    return [{k: draw.choice(list(v)) for k, v in space.items()} for _ in range(n)]


def hyper_search(
    df: DataFrame, features: Sequence[str], label: str, space: Mapping[str, Sequence[object]],
    n: int, seed: int = 7, family: str = "gbt", parallelism: int = 2, split: str = "split",
) -> DataFrame:
    """Random search; several fits share the cluster, each one a distributed job."""
    tries = list(enumerate(candidates(space, n, seed)))
    with (
        staging(df.select(*features, label, split), "trials") as data,
        ThreadPool(min(parallelism, max(1, len(tries)))) as pool,
    ):
        rows = pool.map(
            lambda t: run_trial(data, features, label, f"trial-{t[0]:04d}", family, t[1], split), tries
        )
    return trials_frame(df.sparkSession, rows)


def learned_search(
    df: DataFrame, features: Sequence[str], label: str, space: Space, n: int, startup: int = 8, batch: int = 4, seed: int = 7,
    family: str = "gbt", split: str = "split",
) -> DataFrame:
    """A search that learns from its own trials.

    ``startup`` random settings first, then batches of ``batch`` settings that the densities of good and other trials
    propose; the fits of a batch share the cluster. Failed trials teach nothing but stay as rows.
    """
    spark, rows = df.sparkSession, []
    with staging(df.select(*features, label, split), "trials") as data, ThreadPool(max(1, batch)) as pool:
        while len(rows) < n:
            finished = [r for r in rows if r["status"] == "FINISHED"]
            if len(rows) < startup or not finished:
                tries = candidates(space, min(startup, n - len(rows)), seed + len(rows))
            else:
                laws = densities(trials_frame(spark, rows), space)
                tries = settings_of(propose(laws, min(batch, n - len(rows)), seed + len(rows)), space)
            first = len(rows)
            rows += pool.map(lambda t: run_trial(data, features, label, f"trial-{first + t[0]:04d}", family, t[1], split), list(enumerate(tries)))
    return trials_frame(spark, rows)


def auto_classify(
    df: DataFrame, features: Sequence[str], label: str, exclude: Sequence[str] = (),
    timeout_minutes: float = 10.0, split: str = "split",
) -> DataFrame:
    """One model per family; best validation F1 first.

    The first family is always fitted. At the deadline the running fit is ended (CUT) and the others are SKIPPED.
    """
    budget, rows = Budget(df.sparkSession, 60.0 * timeout_minutes), []
    with staging(df.select(*features, label, split), "trials") as data:
        for family in FAMILIES:
            if family not in exclude:
                rows.append(_within(data, features, label, f"trial-{family}", family, {}, split, budget, not rows))
    return trials_frame(df.sparkSession, rows).orderBy(F.col("loss").asc_nulls_last(), "trial_id")


def _within(data, features, label, trial_id, family, params, split, budget: Budget, first: bool) -> dict:
    if budget.over and not first:
        return {"trial_id": trial_id, "family": family, "status": "SKIPPED", "params": {k: str(v) for k, v in params.items()},
                "metrics": {}, "loss": None, "seconds": 0.0}
    return run_trial(data, features, label, trial_id, family, params, split, None if first else budget)


# What each family is tried with.
SETTINGS: Mapping[str, Sequence[Mapping[str, object]]] = {
    "logistic": [{"reg": 0.0}, {"reg": 0.1}], "tree": [{"max_depth": 3}, {"max_depth": 6}],
    "forest": [{"max_depth": 4}, {"max_depth": 7}], "gbt": [{"rounds": 10, "max_depth": 3}, {"rounds": 25, "max_depth": 3}],
}


def halving_search(
    df: DataFrame, features: Sequence[str], label: str, minutes: float = 10.0, settings: Mapping[str, Sequence[Mapping[str, object]]] = SETTINGS,
    keep: int = 3, rungs: int = 3, split: str = "split",
) -> DataFrame:
    """Families and settings by successive halving within a time budget.

    Every setting is fitted on a share of the train rows first, keep^(1 - rungs) by a hash of the row; the best one of each
    ``keep`` goes on to a share ``keep`` times as large, until all rows are used. Small fits come first, so something is finished
    even if the budget is short: the first one always runs to its end, a fit that the deadline meets is CUT, the rest is
    SKIPPED. Trials are named after family, setting and rung; the best of the highest rung comes first.
    """
    spark, budget, rows = df.sparkSession, Budget(df.sparkSession, 60.0 * minutes), []
    tries = [(family, i, params) for family in FAMILIES if family in settings for i, params in enumerate(settings[family])]
    with staging(df.select(*features, label, split), "trials") as data:
        for rung in range(rungs):
            parts = keep ** (rungs - 1 - rung)
            place = F.pmod(F.xxhash64(*[F.col(quote_name(c)) for c in (*features, label)]), F.lit(parts))
            some = data.filter((F.col(split) != "train") | (place == 0)) if parts > 1 else data
            done = []
            for family, i, params in tries:
                row = _within(some, features, label, f"trial-{family}-{i}-rung{rung}", family, params, split, budget, not rows)
                rows.append(row | {"params": row["params"] | {"share": f"1/{parts}"}})
                if row["status"] == "FINISHED":
                    done.append((row["loss"], len(done), (family, i, params)))
            tries = [t for *_, t in sorted(done)[:max(1, -(-len(done) // keep))]]
    out = trials_frame(spark, rows)
    rung = F.regexp_extract("trial_id", r"rung(\d+)$", 1).cast("int")
    return out.orderBy(F.col("loss").isNull(), rung.desc(), "loss", "trial_id")


def trials_frame(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    names = [part.split()[0] for part in TRIAL_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], TRIAL_SCHEMA)
