from __future__ import annotations

import math
import time

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from keelson.operators import search as S
from keelson.operators import train as L
from keelson.plans.derived import DOCUMENT_FEATURES, labelled_documents

SPACE = {"depth": [1, 2, 3, 4], "kind": ["a", "b"], "one": [5]}
SCHEMA = "trial_id string, status string, params map<string,string>, loss double"


def trials(spark, rows):
    return spark.createDataFrame([(i, s, {"depth": str(d), "kind": k, "one": "5"}, x) for i, s, d, k, x in rows], SCHEMA)


ROWS = [(f"t{n:02d}", "FINISHED", 1 + n % 4, "ab"[n % 2], float(n % 7) + (n % 4) * 3) for n in range(30)] + [
    ("x", "FAILED", 1, "a", None), ("y", "FINISHED", 9, "z", 50.0), ("z", "FINISHED", 2, "a", float("nan"))]


def test_densities_match_the_definition(spark):
    got = {(r.param, r.value): r for r in S.densities(trials(spark, ROWS), SPACE).collect()}
    done = sorted((x, i, d, k) for i, s, d, k, x in ROWS if s == "FINISHED" and x == x)
    cut = math.ceil(math.sqrt(len(done)))
    for side, rows in (("good", done[:cut]), ("bad", done[cut:])):
        mass = {v: 1 / 4 + sum(math.exp(-((v - d) ** 2) / 2) for *_, d, _ in rows if d in SPACE["depth"]) for v in SPACE["depth"]}
        for v, m in mass.items():
            assert got["depth", str(v)][side] == pytest.approx(m / sum(mass.values()))
        kinds = {v: 1 / 2 + sum(k == v for *_, k in rows) for v in SPACE["kind"]}
        for v, m in kinds.items():
            assert got["kind", v][side] == pytest.approx(m / sum(kinds.values()))
        assert got["one", "5"][side] == 1.0


def test_no_trial_and_proposals(spark):
    laws = S.densities(trials(spark, ROWS[:0]), SPACE)
    assert {round(r.good, 9) for r in laws.where("param = 'depth'").collect()} == {0.25}
    first, again = (S.settings_of(S.propose(S.densities(trials(spark, ROWS), SPACE), 6, seed=3), SPACE) for _ in range(2))
    assert first == again and len(first) == 6 and all(p["depth"] in SPACE["depth"] and p["one"] == 5 for p in first)
    assert sum(p["depth"] == 1 for p in first) >= 4  # the trials of depth 1 are the good ones


def test_a_search_finds_what_random_draws_find_late(spark, small):
    rows = labelled_documents(spark, small)
    space = {"iterations": [0, 1, 30], "reg": [0.0, 50.0]}
    out = L.learned_search(rows, DOCUMENT_FEATURES, "label", space, n=6, startup=3, batch=2, family="logistic").collect()
    assert [t.trial_id for t in out] == [f"trial-{i:04d}" for i in range(6)] and all(t.loss == -t.metrics["val_f1"] for t in out)
    assert min(t.loss for t in out[3:]) <= min(t.loss for t in out[:3])


def test_patience_by_hand(spark):
    series = {"a": [5, 4, 4, 6, 7, 1], "b": [3.0], "c": [9, 8, 7, 6], "d": [1, 2, 3, 4, 0], "e": [None, float("nan"), 2.0, None, None, None, 1.0], "f": [None]}
    rows = [(k, i, None if x is None else float(x)) for k, xs in series.items() for i, x in enumerate(xs)]
    got = {r.k: tuple(r)[1:] for r in S.patience_stop(spark.createDataFrame(rows, "k string, round int, loss double"), ["k"], patience=3).collect()}
    assert got == {"a": (2, 4.0, 5, 6), "b": (1, 3.0, 1, 1), "c": (4, 6.0, 4, 4), "d": (1, 1.0, 4, 5), "e": (3, 2.0, 6, 7), "f": (None, None, 1, 1)}
    for k in "abcd":
        assert S.kept_rounds([float(x) for x in series[k]], 3) == got[k][0]


def test_boosting_keeps_the_rounds_up_to_the_best(spark, small):
    rows = labelled_documents(spark, small).cache()
    settings = {"rounds": 14, "learning_rate": 0.8, "max_depth": 4}
    whole = L.fit(rows, DOCUMENT_FEATURES, "label", "gbt", settings, patience=0)
    losses = L.validation_losses(whole.stages[-1], PipelineModel(stages=whole.stages[:-1]).transform(rows.where("split = 'val'")))
    kept = S.kept_rounds(losses, 2)
    cut = L.fit(rows, DOCUMENT_FEATURES, "label", "gbt", settings, patience=2)
    assert len(losses) == whole.stages[-1].getNumTrees == 14 and cut.stages[-1].getNumTrees == kept < 14
    refit = L.fit(rows, DOCUMENT_FEATURES, "label", "gbt", settings | {"rounds": kept}, patience=0)
    a, b = (sorted((r.doc_id, r.score) for r in L.score(m, rows).select("doc_id", "score").collect()) for m in (cut, refit))
    assert [x[0] for x in a] == [x[0] for x in b] and [x[1] for x in a] == pytest.approx([x[1] for x in b])
    no_val = L.fit(rows.where("split <> 'val'"), DOCUMENT_FEATURES, "label", "gbt", {"rounds": 3})
    assert no_val.stages[-1].getNumTrees == 3 and L.score(no_val, rows.withColumn("more", F.lit(1))).count() == rows.count()
    rows.unpersist()


def test_a_budget_ends_a_running_fit(spark, small):
    rows = labelled_documents(spark, small).cache()
    rows.count()
    budget, started = L.Budget(spark, 3.0), time.monotonic()
    cut = L.run_trial(rows, DOCUMENT_FEATURES, "label", "t", "gbt", {"rounds": 400, "max_depth": 5}, budget=budget)
    assert (cut["status"], cut["loss"], cut["metrics"]) == ("CUT", None, {}) and time.monotonic() - started < 15
    fine = L.run_trial(rows, DOCUMENT_FEATURES, "label", "t", "logistic", {"iterations": 2}, budget=L.Budget(spark, 300.0))
    assert fine["status"] == "FINISHED" and not spark.sparkContext.getJobTags()
    rows.unpersist()


def test_halving_finishes_something_and_cuts_the_rest(spark, small):
    rows = labelled_documents(spark, small)
    settings = {"logistic": [{"iterations": 3}, {"iterations": 0}], "gbt": [{"rounds": 400, "max_depth": 5}], "tree": [{"max_depth": 2}]}
    started = time.monotonic()
    out = L.halving_search(rows, DOCUMENT_FEATURES, "label", minutes=0.2, settings=settings, keep=2).collect()
    assert time.monotonic() - started < 60
    status = {r.trial_id: r.status for r in out}
    assert status["trial-logistic-0-rung0"] == "FINISHED" and "CUT" in status.values() and out[0].status == "FINISHED"
    assert all((r.loss is None) == (r.status != "FINISHED") for r in out) and {r.params["share"] for r in out} <= {"1/4", "1/2", "1/1"}
    small_ones = {k: v for k, v in settings.items() if k != "gbt"}
    full = L.halving_search(rows, DOCUMENT_FEATURES, "label", settings=small_ones, keep=2).collect()
    assert [sum(f"rung{i}" in r.trial_id for r in full) for i in range(3)] == [3, 2, 1] and full[0].trial_id.endswith("rung2")
    assert {r.status for r in full} == {"FINISHED"}
