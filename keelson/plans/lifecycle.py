"""The jobs of a churn model's life, each a function over named tables.

ingest -> features -> train -> register -> validate -> promote -> score -> monitor
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.text import clean_name, split_list, tag_lookup, user_slug
from keelson.operators import drift, explain, gates, metrics, monitor, registry, train
from keelson.operators.features import FeatureSpec, signature_type, with_signature
from keelson.operators.score import MODEL_ERRORS, ml_score, predicts
from keelson.operators.splits import TRAIN_VAL_TEST, split, with_split
from keelson.session import require_lasting_tables, shared_dir, staging
from keelson.sources.clustered import ClusteredTable
from keelson.sources.daily import BATCH, DAY, DailyLog, refresh_days, replace_days
from keelson.sources.model_tables import open_table
from keelson.sources.tables import KeyedTable, VersionedTable, clone, create_database, read_csv

# --- fixed values: the raw customer file ---
CUSTOMER_SCHEMA = """
customer_id string, gender string, senior_citizen int, partner string, dependents string, tenure int,
phone_service string, multiple_lines string, internet_service string, online_security string,
online_backup string, device_protection string, tech_support string, streaming_tv string,
streaming_movies string, contract string, paperless_billing string, payment_method string,
monthly_charges double, total_charges double, churn string
"""
CATEGORICALS = [
    "gender", "partner", "dependents", "phone_service", "multiple_lines", "internet_service", "online_security",
    "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies", "contract",
    "paperless_billing", "payment_method",
]
KEY, LABEL = "customer_id", "churn"
DEMOGRAPHICS = "senior_citizen,gender_female"
# Boosting settings of the churn job.
CHURN_PARAMS = {
    "max_depth": 3, "rounds": 200, "learning_rate": 0.1, "subsample": 0.7,
    "features_per_node": 0.8, "min_rows_per_node": 10, "seed": 11,
}
SLICES = {"gender_female=1": "gender_female = 1", "senior_citizen=1": "senior_citizen = 1"}


@dataclass(frozen=True)
class Workspace:
    """Where a user's tables live."""

    user: str
    dev: str
    prod: str

    @staticmethod
    def of(user: str, prefix: str = "customers") -> Workspace:
        slug = user_slug(user)
        return Workspace(user, f"{prefix}_{slug}_lab", f"{prefix}_{slug}_live")

    def table(self, stage: str, name: str) -> str:
        return f"{self.dev if stage == 'dev' else self.prod}.{name}"

    @property
    def model(self) -> str:
        return f"churn_model_{user_slug(self.user)}"


BRONZE, UPDATES, FEATURES = "raw_customers", "late_customers", "customer_features"
BASELINE, PREDICTIONS, SPECS = "scored_reference", "scored_customers", "feature_specs"
ROWS_PER_FILE = 250_000


def ingest(spark: SparkSession, ws: Workspace, csv_path: str) -> None:
    """Read the raw file, keep a tenth of the customers back as a later update, clone to prod."""
    require_lasting_tables(spark)
    for database in (ws.dev, ws.prod):
        create_database(spark, database)
    bronze, updates = split(read_csv(spark, csv_path, CUSTOMER_SCHEMA), [KEY], 90)
    VersionedTable(spark, ws.table("dev", BRONZE)).overwrite(bronze)
    VersionedTable(spark, ws.table("dev", UPDATES)).overwrite(updates)
    for name in (BRONZE, UPDATES):
        clone(spark, ws.table("dev", name), ws.table("prod", name))


def save_spec(spark: SparkSession, ws: Workspace, stage: str, name: str, spec: FeatureSpec) -> None:
    store = KeyedTable(spark, ws.table(stage, SPECS))
    row = spark.createDataFrame([(name, json.dumps(spec.to_dict()))], "name string, spec string")
    store.create(row.schema, ["name"], "fitted feature specs").merge(row)


def load_spec(spark: SparkSession, ws: Workspace, stage: str, name: str) -> FeatureSpec:
    rows = KeyedTable(spark, ws.table(stage, SPECS)).read().filter(F.col("name") == name).take(1)
    if not rows:
        raise LookupError(f"no feature spec named {name!r}")
    return FeatureSpec.from_dict(json.loads(rows[0]["spec"]))


def build_features(spark: SparkSession, ws: Workspace, rows_per_file: int = ROWS_PER_FILE) -> ClusteredTable:
    """Fit the featuriser on the bronze table and rebuild the dev feature table."""
    bronze = spark.table(ws.table("dev", BRONZE))
    spec = FeatureSpec(CATEGORICALS, LABEL).fit(bronze)
    save_spec(spark, ws, "dev", FEATURES, spec)
    features = spec.transform(bronze)
    store = ClusteredTable(spark, ws.table("dev", FEATURES), rows_per_file)
    text = "Churn features: one-hot categoricals with clean names, numeric charges, 0/1 label."
    store.create(features.schema, [KEY], text, replace=True).merge(features)
    return store


def refresh_features(
    spark: SparkSession, ws: Workspace, source: str = UPDATES, rows_per_file: int = ROWS_PER_FILE
) -> ClusteredTable:
    """Incremental job: the fitted spec on a batch of customers, merged into prod features.

    Unlabelled customers are kept, since they are to be scored.
    """
    spec = load_spec(spark, ws, "dev", FEATURES)
    features = spec.transform(spark.table(ws.table("prod", source)), training=False)
    store = ClusteredTable(spark, ws.table("prod", FEATURES), rows_per_file)
    store.create(features.schema, [KEY], "Churn features by customer.").merge(features)
    return store


def train_model(
    spark: SparkSession, ws: Workspace, run_id: str, family: str = "gbt", params: Mapping[str, object] | None = None
) -> DataFrame:
    """Split, fit, evaluate on the three parts and record the run; returns the metrics.

    Boosting without ``params`` uses ``CHURN_PARAMS``; the val part stops it early.
    """
    if params is None and family == "gbt":
        params = CHURN_PARAMS
    features = with_split(spark.table(ws.table("dev", FEATURES)), [KEY], TRAIN_VAL_TEST)
    inputs = [c for c in features.columns if c not in (KEY, LABEL, "split")]
    model = train.fit(features, inputs, LABEL, family, params)
    model.write().overwrite().save(model_path(spark, run_id))
    measured = train.trial_metrics(model, features, LABEL)
    rows = measured.collect()
    values = {f"{r['split']}_{m}": float(r[m]) for r in rows for m in train.METRICS if r[m] is not None}
    tags = {"demographic_vars": DEMOGRAPHICS, "db_table": ws.table("dev", FEATURES), "inputs": ",".join(inputs)}
    run = spark.createDataFrame(
        [(run_id, ws.model, "FINISHED", values, {k: str(v) for k, v in (params or {}).items()}, tags)],
        open_table(spark, "runs", ws.dev).read().schema,
    )
    open_table(spark, "runs", ws.dev).merge(run)
    return measured


def tag_run(spark: SparkSession, ws: Workspace, run_id: str, tags: Mapping[str, str]) -> None:
    """Set tags on a recorded run; an unknown run is refused."""
    store = open_table(spark, "runs", ws.dev)
    rows = registry.set_run_tags(store.read(), spark.createDataFrame([(run_id, dict(tags))], "run_id string, tags map<string,string>"))
    pinned = spark.createDataFrame(rows.collect(), rows.schema)  # one row, read before its table changes
    if pinned.isEmpty():
        raise LookupError(f"no run {run_id!r}")
    store.merge(pinned)


def explain_model(spark: SparkSession, ws: Workspace, run_id: str, n: int = 100, seed: int = 20260101) -> DataFrame:
    """Shapley importances of a run's model: val rows against train rows."""
    features = with_split(spark.table(ws.table("dev", FEATURES)), [KEY], TRAIN_VAL_TEST)
    inputs = [c for c in features.columns if c not in (KEY, LABEL, "split")]
    model = PipelineModel.load(model_path(spark, run_id))
    return explain.shapley_importance(
        features.filter("split = 'val'"), features.filter("split = 'train'"), inputs, [KEY],
        lambda df: train.score(model, df), n=n, seed=seed,
    )


def model_path(spark: SparkSession, run_id: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/models/{run_id}"


def register_best(spark: SparkSession, ws: Workspace, description: str, by: str = "val_f1") -> DataFrame:
    """Register the best finished run as a new version and make it the challenger."""
    name = ws.table("dev", ws.model)
    best = registry.best_run(open_table(spark, "runs", ws.dev).read(), by)
    features = spark.table(ws.table("dev", FEATURES))
    signature = F.array(*[
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
        for f in features.schema if f.name not in (KEY, LABEL)
    ])
    source = F.concat(F.lit(f"{shared_dir(spark).rstrip('/')}/models/"), F.col("run_id"))
    candidate = best.select(
        F.lit(name).alias("name"), "run_id", source.alias("source"),
        F.lit(description).alias("description"), signature.alias("signature"),
    )
    versions = open_table(spark, "model_versions", ws.dev)
    new = registry.register(candidate, versions.read())
    rows = spark.createDataFrame(new.collect(), versions.read().schema)  # one row
    versions.merge(rows)
    open_table(spark, "model_aliases", ws.dev).merge(
        rows.select("name", F.lit(registry.CHALLENGER).alias("alias"), "version")
    )
    return rows


def pointed_version(spark: SparkSession, database: str, name: str, alias: str):
    """The version row an alias points at, or None."""
    aliases = open_table(spark, "model_aliases", database).read().filter(F.col("name") == name)
    rows = registry.resolve_alias(
        aliases, open_table(spark, "model_versions", database).read(),
        open_table(spark, "runs", database).read().select("run_id", "tags"), alias,
    ).take(1)
    return rows[0] if rows else None


def validate_challenger(spark: SparkSession, ws: Workspace, at: datetime) -> DataFrame:
    """Run the gates on the challenger, store them as version tags, return the report."""
    name = ws.table("dev", ws.model)
    chosen = pointed_version(spark, ws.dev, name, registry.CHALLENGER)
    if chosen is None:
        raise LookupError(f"{name} has no challenger")
    run_tags = spark.createDataFrame([(chosen["tags"] or {},)], "tags map<string,string>")
    found = run_tags.select(
        tag_lookup("tags", "db_table").alias("db_table"),
        split_list(tag_lookup("tags", "demographic_vars")).alias("demographics"),
    ).first()
    features = spark.table(found["db_table"])
    model = PipelineModel.load(chosen["source"])
    key = {"name": F.lit(name), "version": F.lit(chosen["version"])}

    def scored(df: DataFrame) -> DataFrame:
        return train.score(model, df)

    works = predicts_with(features, scored)
    predictions = spark.createDataFrame([(works,)], "predicts int").withColumns(key)
    if works and found["demographics"] != ["none"]:
        slices = metrics.slice_accuracy(scored(features), found["demographics"], LABEL).withColumns(key)
    else:
        slices = spark.createDataFrame([], "pct_acc double").withColumns(key)
    declared = spark.createDataFrame([(f["name"], f["type"]) for f in chosen["signature"] or []], "name string, type string")
    present = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in features.schema if f.name not in (KEY, LABEL)], declared.schema)
    changes = gates.signature_diff(declared, present).select("change").withColumns(key)
    artifacts = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(chosen["source"])
    versions = open_table(spark, "model_versions", ws.dev).read().filter(
        (F.col("name") == name) & (F.col("version") == chosen["version"])
    )
    report = gates.gate_report(versions, predictions, slices, artifacts.select("path").withColumns(key), changes=changes)
    result = spark.createDataFrame(report.collect(), report.schema)  # one row per validated version
    tags = gates.gate_tags(result).withColumn("ts", F.lit(at))
    open_table(spark, "version_tags", ws.dev).merge(tags)
    return result


def predicts_with(features: DataFrame, scored) -> int:
    """M4 for a model that transforms a frame."""
    try:
        frame = scored(features)
    except MODEL_ERRORS:  # a model that cannot even be planned does not predict
        return 0
    return predicts(frame, [], F.col("prediction"))


def promote_challenger(spark: SparkSession, ws: Workspace, report: DataFrame | None = None) -> DataFrame:
    """Copy the challenger to prod and make it champion there and in dev."""
    aliases, versions = open_table(spark, "model_aliases", ws.dev), open_table(spark, "model_versions", ws.dev)
    target = open_table(spark, "model_versions", ws.prod)
    own = aliases.read().filter(F.col("name") == ws.table("dev", ws.model))
    done = registry.promote(
        own, versions.read(), target.read(), F.lit(ws.table("prod", ws.model)), report,
        tags=open_table(spark, "version_tags", ws.dev).read(),
    )
    tags = spark.createDataFrame(done.tags.collect(), done.tags.schema)  # one row per tag name of a version
    copies = done.versions.drop("source").join(
        versions.read().select(F.col("name").alias("from_name"), F.col("version").alias("from_version"), "source"),
        ["from_name", "from_version"],
    )
    # A promotion holds one version per model: pin it before the tables it reads change.
    pinned = spark.createDataFrame(copies.collect(), copies.schema)
    target.merge(pinned.select(target.read().columns))
    champion = F.lit(registry.CHAMPION).alias("alias")
    text = F.lit("promoted from " + ws.table("dev", ws.model)).alias("description")
    created = spark.createDataFrame(done.new_names.select("name", text).collect(), "name string, description string")
    open_table(spark, "registered_models", ws.prod).merge(created)
    open_table(spark, "version_tags", ws.prod).merge(tags)
    open_table(spark, "model_aliases", ws.prod).merge(pinned.select("name", champion, "version"))
    aliases.merge(pinned.select(
        F.col("from_name").alias("name"), champion, F.col("from_version").alias("version")
    ))
    return pinned


def score_features(
    spark: SparkSession, ws: Workspace, features: DataFrame, target: str = PREDICTIONS, at: datetime | None = None
) -> DataFrame:
    """Batch inference with the champion, appended to the log; returns the stored rows of this run.

    The batch is held against the signature stored with the version: a missing input is refused, and so is one that is no
    number where the model wants one.
    """
    name = ws.table("prod", ws.model)
    champion = pointed_version(spark, ws.prod, name, registry.CHAMPION)
    if champion is None:
        raise LookupError(f"{name} has no champion")
    if champion["signature"]:
        features = with_signature(features, signature_type(champion["signature"]))
    scored = ml_score(
        features, PipelineModel.load(champion["source"]), name, registry.CHAMPION, str(champion["version"]), at
    )
    log = DailyLog(spark, ws.table("prod", target), "prediction_time")
    with staging(scored, "scored") as rows:  # scored once, whatever reads it
        empty = rows.isEmpty()
        batch = log.append(rows)
    stored = log.read().drop(DAY, BATCH)
    return stored.limit(0) if empty else log.read().filter(F.col(BATCH) == batch).drop(DAY, BATCH)


def score_baseline_and_log(spark: SparkSession, ws: Workspace, at: datetime | None = None) -> None:
    """SP2, S16: a quarter of the customers becomes the baseline, the rest the log."""
    baseline, rest = split(spark.table(ws.table("prod", FEATURES)), [KEY], 25)
    score_features(spark, ws, baseline, BASELINE, at)
    score_features(spark, ws, rest, PREDICTIONS, at)


def monitor_predictions(
    spark: SparkSession, ws: Workspace, columns: Sequence[str] = ("tenure", "monthly_charges", "total_charges"),
    window: str = "5 minutes", slices: Mapping[str, str | Column] = SLICES, exact: bool = False,
) -> dict[str, str]:
    """Bring profile, quality and drift tables next to the log up to date; returns their names.

    Only the days that new batches hold rows of are read from the log and written again, late ones included. Deltas
    against the window before are recomputed from the stored profile, from the first such day on. ``window`` divides a day.
    """
    log = DailyLog(spark, ws.table("prod", PREDICTIONS), "prediction_time")
    baseline = spark.table(ws.table("prod", BASELINE))
    names = {kind: ws.table("prod", f"{PREDICTIONS}_{kind}") for kind in ("profile", "quality", "drift")}
    day = F.to_date("window_start").alias(DAY)

    def compute(rows: DataFrame, days: list, upto: int) -> None:
        replace_days(monitor.profile(rows, columns, "prediction_time", window, "model_version", slices, exact).select("*", day), names["profile"])
        measured = monitor.quality(rows, LABEL, "prediction", "prediction_time", window, "model_version", slices, "score")
        replace_days(measured.select("*", day), names["quality"])
        reference = monitor.profile(baseline, columns, slices=slices, exact=exact)
        deltas = drift.drift_deltas(spark.table(names["profile"]).drop(DAY), reference).select("*", day, F.lit("deltas").alias("source"))
        timed, keys = monitor.windowed(rows, "prediction_time", window, "model_version")
        shifts = drift.baseline_drift(
            monitor.sliced(timed, slices), monitor.sliced(baseline, slices), columns, ["prediction", LABEL],
            [*keys, "slice"], ["slice"],
        ).select("*", day, F.lit("counts").alias("source"))
        replace_days(deltas.filter(F.col(DAY) >= F.lit(min(days))).unionByName(shifts), names["drift"], ("source", DAY))

    refresh_days(log, "monitor", KeyedTable(spark, ws.table("prod", f"{PREDICTIONS}_marks")), compute)
    return names


def supported_columns(vocab: Mapping[str, Sequence[str]]) -> list[str]:
    """The model's inputs: the numeric columns and every dummy, by the naming rule."""
    numeric = ["senior_citizen", "tenure", "monthly_charges", "total_charges"]
    return numeric + [clean_name(f"{c}_{v}") for c, values in vocab.items() for v in values]
