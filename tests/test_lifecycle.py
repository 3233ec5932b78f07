"""The whole life of a model on a small customer file, and the streaming jobs."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from keelson.operators import registry as R
from keelson.operators import train as L
from keelson.plans import lifecycle as C
from keelson.plans.derived import DOCUMENT_FEATURES, labelled_documents, prepare_log
from keelson.plans.monitor_queries import event_stream
from keelson.sources.model_tables import open_table
from keelson.sources.tables import KeyedTable
from keelson.streaming import jobs

AT = datetime(2024, 3, 1, 12, 1)


@pytest.fixture(scope="module")
def customer_file(spark, tiny, tmp_path_factory):
    """The raw file's columns, filled from customers; one has a blank charge."""
    key = F.col("c_custkey")

    def pick(salt, *values):
        place = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(len(values)))
        out = F.lit(values[0])
        for i, v in enumerate(values[1:], 1):
            out = F.when(place == i, F.lit(v)).otherwise(out)
        return out

    two = ["partner", "dependents", "phone_service", "paperless_billing"]
    three = ["multiple_lines", "online_security", "online_backup", "device_protection", "tech_support",
             "streaming_tv", "streaming_movies"]
    columns = {
        "customer_id": F.concat(F.lit("c-"), key), "gender": pick("g", "Female", "Male"),
        "senior_citizen": pick("s", "0", "1"), "tenure": F.pmod(F.xxhash64("c_name"), F.lit(70)).cast("string"),
        "internet_service": pick("i", "DSL", "Fiber optic", "No"),
        "contract": pick("c", "Month-to-month", "One year", "Two year"),
        "payment_method": pick("p", "Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"),
        "monthly_charges": F.round(F.abs("c_acctbal") / 100, 2).cast("string"),
        "total_charges": F.when(key == 3, F.lit(" ")).otherwise(F.abs("c_acctbal").cast("string")),
    }
    columns |= {c: pick(c, "No", "Yes") for c in two}
    columns |= {c: pick(c, "No", "No internet service", "Yes") for c in three}
    columns["churn"] = F.when(columns["contract"] == "Month-to-month", "Yes").otherwise("No")
    names = [part.split()[0] for part in C.CUSTOMER_SCHEMA.replace("\n", " ").split(",")]
    path = str(tmp_path_factory.mktemp("raw") / "customers")
    rows = spark.read.parquet(f"{tiny}/customer.parquet").select(*[columns[n].alias(n) for n in names])
    rows.write.csv(path, header=True)
    return path


def test_life_of_a_model(spark, customer_file):
    ws = C.Workspace.of("some.body@x.io")
    assert (ws.dev, ws.prod, ws.model) == ("customers_some_body_lab", "customers_some_body_live", "churn_model_some_body")
    C.ingest(spark, ws, customer_file)
    bronze, updates = (spark.table(ws.table("prod", n)) for n in (C.BRONZE, C.UPDATES))
    assert bronze.count() + updates.count() == 150 and bronze.columns[0] == "customer_id"

    features = C.build_features(spark, ws).read()
    spec = C.load_spec(spark, ws, "dev", C.FEATURES)
    assert set(C.supported_columns(spec.vocab)) == set(features.columns) - {"customer_id", "churn"}
    assert {"payment_method_bank_transfer__automatic_", "contract_month_to_month"} <= set(features.columns)
    assert features.filter("customer_id = 'c-3'").count() == 0  # blank charge

    C.refresh_features(spark, ws)
    C.refresh_features(spark, ws, C.BRONZE)
    scored_keys = spark.table(ws.table("prod", C.FEATURES))
    assert scored_keys.count() == 149 and scored_keys.columns == features.columns

    C.train_model(spark, ws, "run-weak", "logistic", {"iterations": 1, "reg": 9.0})
    C.train_model(spark, ws, "run-good", "gbt", {"rounds": 5})
    ranked = C.explain_model(spark, ws, "run-good", n=6).collect()
    assert len(ranked) == len(features.columns) - 2 and ranked[0]["feature"].startswith("contract_")
    first = C.register_best(spark, ws, "short").first()
    assert (first["run_id"], first["version"]) == ("run-good", 1) and len(first["signature"]) == len(features.columns) - 2
    report = C.validate_challenger(spark, ws, AT).first()
    assert report["predicts"] == report["has_signature"] == report["has_artifacts"] == 1
    assert report["demo_test"] == "pass" and report["has_description"] == 0 and not report["passed"]
    assert C.promote_challenger(spark, ws, C.validate_challenger(spark, ws, AT)).count() == 0
    assert C.pointed_version(spark, ws.prod, ws.table("prod", ws.model), R.CHAMPION) is None
    with pytest.raises(LookupError, match="no champion"):
        C.score_features(spark, ws, scored_keys)

    second = C.register_best(spark, ws, "Boosted trees on the churn feature table.").first()
    assert second["version"] == 2
    passed = C.validate_challenger(spark, ws, AT)
    assert passed.first()["passed"] and passed.first()["signature_matches"] == 1
    store = C.ClusteredTable(spark, ws.table("dev", C.FEATURES))
    whole = spark.createDataFrame(store.read().collect(), store.read().schema)
    store.create(whole.drop("tenure").schema, [C.KEY], replace=True).merge(whole.drop("tenure"))
    assert [C.validate_challenger(spark, ws, AT).first()[c] for c in ("signature_matches", "passed")] == [0, False]
    store.create(whole.schema, [C.KEY], replace=True).merge(whole)
    C.validate_challenger(spark, ws, AT)
    C.promote_challenger(spark, ws, passed)
    for database, name in ((ws.prod, ws.table("prod", ws.model)), (ws.dev, ws.table("dev", ws.model))):
        champion = C.pointed_version(spark, database, name, R.CHAMPION)
        assert champion["run_id"] == "run-good" and champion["version"] == (1 if database == ws.prod else 2)
    tags = open_table(spark, "version_tags", ws.dev).read().filter("version = 2").collect()
    assert {t["key"]: t["value"] for t in tags}["demo_test"] == "pass"

    other = spark.newSession()  # the registry and the models are there for a second session
    assert C.pointed_version(other, ws.prod, ws.table("prod", ws.model), R.CHAMPION)["run_id"] == "run-good"
    assert open_table(other, "registered_models", ws.prod).read().first()["name"] == ws.table("prod", ws.model)
    copied = open_table(other, "version_tags", ws.prod).read().collect()
    assert {t["key"]: t["value"] for t in copied}["demo_test"] == "pass" and {t["version"] for t in copied} == {1}

    retyped = scored_keys.withColumn("tenure", F.col("tenure").cast("string"))
    with pytest.raises(TypeError, match="tenure: string is not int"):
        C.score_features(spark, ws, retyped)
    with pytest.raises(ValueError, match="missing columns: .*tenure"):
        C.score_features(spark, ws, scored_keys.drop("tenure"))
    C.tag_run(spark, ws, "run-good", {"reviewed": "yes", "demographic_vars": "senior_citizen"})
    kept = C.pointed_version(spark, ws.dev, ws.table("dev", ws.model), R.CHAMPION)["tags"]
    assert kept["reviewed"] == "yes" and kept["demographic_vars"] == "senior_citizen" and "db_table" in kept
    with pytest.raises(LookupError, match="no run"):
        C.tag_run(spark, ws, "run-none", {"a": "b"})

    C.score_baseline_and_log(spark, ws, AT)
    log = spark.table(ws.table("prod", C.PREDICTIONS))
    assert log.count() + spark.table(ws.table("prod", C.BASELINE)).count() == 149
    assert {"prediction_time", "prediction", "score", "model_name", "model_alias", "model_version"} <= set(log.columns)
    names = C.monitor_predictions(spark, ws, exact=True)
    profile = spark.table(names["profile"])
    assert {r["slice"] for r in profile.select("slice").distinct().collect()} == {"all", *C.SLICES}
    total = profile.filter("slice = 'all' and column = 'tenure'").first()
    assert total["n"] == log.count() and total["window_start"] == datetime(2024, 3, 1, 12, 0)
    quality = spark.table(names["quality"]).filter("slice = 'all'").first()
    assert quality["accuracy"] > 0.55 and quality["n"] == log.count()
    assert spark.table(names["drift"]).filter("kind = 'baseline'").count() > 0

    later = C.score_features(spark, ws, spark.table(ws.table("prod", C.FEATURES)), at=AT + timedelta(days=1))
    assert later.count() == 149 and "day" not in later.columns
    C.monitor_predictions(spark, ws, exact=True)  # the new day alone is read, and compared with the window before it
    days = {r["day"].day: r["n"] for r in spark.table(names["quality"]).filter("slice = 'all'").collect()}
    assert days[2] == 149 and days[1] == quality["n"]
    step = spark.table(names["drift"]).filter("kind = 'consecutive' AND metric = 'delta_count' AND slice = 'all' AND column = 'tenure'").collect()
    assert [(r["day"].day, r["value"]) for r in step] == [(2, 149.0 - total["n"])]


# --- training -------------------------------------------------------------------

def test_boosting_beats_the_majority(spark, small):
    rows = labelled_documents(spark, small)
    model = L.fit(rows, DOCUMENT_FEATURES, "label", "gbt", {"rounds": 8})
    scored = L.score(model, rows)
    hit = scored.filter("prediction = label").count()
    majority = max(r["count"] for r in rows.groupBy("label").count().collect())
    assert scored.count() == 399 and hit >= majority
    bounds = scored.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= bounds[0] <= bounds[1] <= 1.0


def test_search_ranks_by_negative_f1(spark, small):
    rows = labelled_documents(spark, small)
    trials = L.hyper_search(rows, DOCUMENT_FEATURES, "label", {"iterations": [1, 20], "reg": [0.0, 5.0]}, n=2, family="logistic")
    got = trials.collect()
    assert [t["trial_id"] for t in got] == ["trial-0000", "trial-0001"]
    assert all(t["loss"] == -t["metrics"]["val_f1"] for t in got)
    assert R.best_trial(trials).first()["loss"] == min(t["loss"] for t in got)
    assert L.candidates({"a": [1, 2, 3]}, 4, seed=1) == L.candidates({"a": [1, 2, 3]}, 4, seed=1)


def test_automatic_search_excludes_and_stops(spark, small):
    rows = labelled_documents(spark, small)
    out = L.auto_classify(rows, DOCUMENT_FEATURES, "label", exclude=["forest", "gbt"], timeout_minutes=0.0).collect()
    assert [(t["family"], t["status"]) for t in out] == [("logistic", "FINISHED"), ("tree", "SKIPPED")]


def test_saved_pipeline_scores_raw_rows(spark, small, tmp_path):
    rows = labelled_documents(spark, small)
    model = L.fit(rows, ["n_chars", "digit_share"], "label", "logistic", categorical=["lang"], passthrough=["n_words"])
    model.write().save(str(tmp_path / "m"))
    odd = spark.createDataFrame([("abc", None, "xx", None, 1), (None, 0.5, None, "7", 2)],
                                "n_chars string, digit_share double, lang string, n_words string, more int")
    scored = L.score(PipelineModel.load(str(tmp_path / "m")), odd).collect()
    assert len(scored) == 2 and all(0 <= r["score"] <= 1 for r in scored) and [r["more"] for r in scored] == [1, 2]
    assert not [c for c in L.score(model, odd).columns if c.startswith("_in_")]


def test_a_failing_trial_is_a_row(spark, small):
    rows = labelled_documents(spark, small)
    got = L.hyper_search(rows, DOCUMENT_FEATURES, "label", {"learning_rate": [4.4]}, n=1).collect()
    assert got[0]["status"] == "FAILED" and got[0]["loss"] is None


# --- registry edges ----------------------------------------------------------------

def test_best_run_ties_and_missing_metrics(spark):
    schema = "run_id string, experiment_id string, status string, metrics map<string,double>, tags map<string,string>"
    runs = spark.createDataFrame([
        ("b", "e", "FINISHED", {"val_f1_score": 0.9}, {"k": "v"}), ("a", "e", "FINISHED", {"val_f1_score": 0.9}, {}),
        ("c", "e", "FAILED", {"val_f1_score": 1.0}, {}), ("d", "e", "FINISHED", {}, {}),
    ], schema)
    assert R.best_run(runs).first()["run_id"] == "a"
    assert R.best_run_per_experiment(runs).first()["run_id"] == "a"
    assert [r["run_id"] for r in R.runs_by_tag(runs, "k", "v").collect()] == ["b"]


def test_no_champion_is_no_error(spark):
    aliases = spark.createDataFrame([], "name string, alias string, version int")
    row = R.champion_or_none(spark.createDataFrame([("m",)], "name string"), aliases).first()
    assert (row["version"], row["has_champion"]) == (None, False)


def test_latest_tag_wins_and_aliases_move(spark):
    log = spark.createDataFrame([("m", "k", "old", 1), ("m", "k", "new", 2), ("m", "j", "x", 1)], "name string, key string, value string, ts int")
    assert R.tags_map(R.latest_tags(log, ["name"]), ["name"]).first()["tags"] == {"j": "x", "k": "new"}
    aliases = spark.createDataFrame([("m", "Champion", 1), ("m", "Challenger", 2)], "name string, alias string, version int")
    moved = R.set_alias(aliases, spark.createDataFrame([("m", "Champion", 2)], aliases.schema))
    assert sorted(map(tuple, moved.collect())) == [("m", "Challenger", 2), ("m", "Champion", 2)]


# --- streaming ------------------------------------------------------------------------

def test_stream_score_resumes_without_repeating(spark, tiny, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        scored = jobs.stream_score(event_stream(spark, tiny), prepare_log).select("event_id", "score")
        jobs.append_to(scored, out, state).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 1000 and got.select("event_id").distinct().count() == 1000


def test_late_rows_of_a_later_batch_lose(spark, database, tmp_path):
    source = tmp_path / "in"
    schema = "k int, v string, at int"
    store = KeyedTable(spark, f"{database}.late_stream", 4).create(spark.createDataFrame([], schema).schema, ["k"], replace=True)
    for n, batch in enumerate([[(1, "new", 9), (2, "x", 1)], [(1, "old", 1), (1, "older", 0)], [(2, "y", 2), (3, "z", 1)]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        jobs.stream_upsert(stream, store, lambda df: df, ["at"], str(tmp_path / "state")).awaitTermination()
        assert store.read().where("k = 1").first()["v"] == "new"
    assert sorted(tuple(r) for r in store.read().collect()) == [(1, "new", 9), (2, "y", 2), (3, "z", 1)]


def test_a_folder_is_streamed_like_a_file(spark, tiny, tmp_path):
    events = spark.read.parquet(f"{tiny}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    out = str(tmp_path / "out")
    jobs.append_to(event_stream(spark, str(tmp_path)), out).awaitTermination()
    assert spark.read.parquet(out).count() == events.count()


def test_stream_upsert_takes_the_latest_row(spark, database, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, at int").write.parquet(source)
    store = KeyedTable(spark, f"{database}.streamed").create(spark.read.parquet(source).schema, ["k"], replace=True)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    jobs.stream_upsert(stream, store, lambda df: df, ["at"]).awaitTermination()
    assert sorted(map(tuple, store.read().collect())) == [(1, "b", 2), (2, "c", 1)]
