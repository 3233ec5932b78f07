from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from keelson.operators import drift as D
from keelson.operators import explain as E
from keelson.operators import gates as G
from keelson.operators import metrics as M
from keelson.operators import monitor as A
from keelson.operators import outputs as O
from keelson.operators.score import as_label, batch_score, logistic, model_udf, predicts


def scored(spark, n=600, seed=3):
    """Tied scores, both classes, a few missing labels."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        s = float(round(rng.random(), 2))
        rows.append((i, None if i % 40 == 0 else int(rng.random() < 0.3 + 0.4 * s), s, int(s > 0.5), "ab"[i % 2]))
    return spark.createDataFrame(rows, "id int, label int, score double, prediction int, split string")


def pairs_auc(rows):
    pos, neg = [r.score for r in rows if r.label == 1], [r.score for r in rows if r.label == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_against_brute_force_and_ml(spark):
    df = scored(spark).filter("label is not null")
    auc = M.curve_areas(df).first()["roc_auc"]
    assert auc == pytest.approx(pairs_auc(df.collect()))
    ml = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert auc == pytest.approx(ml.evaluate(df.withColumn("label", F.col("label").cast("double"))))
    for row in M.curve_areas(df, by=["split"]).collect():
        assert row["roc_auc"] == pytest.approx(pairs_auc(df.filter(F.col("split") == row["split"]).collect()))


def test_curves_end_at_the_corner(spark):
    points = M.roc_curve(scored(spark)).orderBy("threshold").collect()
    assert points[0]["tpr"] == points[0]["fpr"] == 1.0
    recall = [r["recall"] for r in M.pr_curve(scored(spark)).orderBy("threshold").collect()]
    assert recall == sorted(recall, reverse=True) and recall[0] == 1.0


def test_one_class_has_no_area_but_an_accuracy(spark):
    df = scored(spark).withColumn("label", F.lit(0))
    row = M.classifier_metrics(df, ["split"]).first()
    assert row["roc_auc"] is None and row["average_precision"] is None and row["accuracy"] is not None


def test_confusion_cells_sum_to_the_rows(spark):
    df = scored(spark)
    cells = M.confusion_matrix(df).collect()
    assert len(cells) == 4 and sum(c["n"] for c in cells) == df.filter("label is not null").count()
    only = {(c["label"], c["prediction"]): c["n"] for c in M.confusion_matrix(df.filter("label = 1 and prediction = 1")).collect()}
    assert only[(0, 0)] == 0 and only[(1, 1)] > 0


def test_slices_leave_out_null_keys_and_count_null_predictions_as_wrong(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, None), (None, 1, 1)], "k string, label int, prediction int")
    assert [tuple(r) for r in M.slice_accuracy(df, ["k"]).collect()] == [("a", 1, 2, 0.5)]


def test_slice_gate_modes(spark):
    df = spark.createDataFrame([(0.9,), (0.2,)], "pct_acc double")
    assert G.slice_gate(df).first()["demo_test"] == "fail"
    assert G.slice_gate(df, mode="literal").first()["demo_test"] == "pass"
    assert G.slice_gate(df.filter("pct_acc > 0.5")).first()["demo_test"] == "pass"


def test_gate_report_edges(spark):
    sig = "array<struct<name:string,type:string>>"
    versions = spark.createDataFrame(
        [("m", 1, "x" * 21, [("a", "double")]), ("m", 2, "x" * 20, None), ("m", 3, None, [])],
        f"name string, version int, description string, signature {sig}",
    )
    key = "name string, version int"
    report = G.gate_report(
        versions,
        spark.createDataFrame([("m", 1, 1), ("m", 2, 1), ("m", 2, 0)], f"{key}, predicts int"),
        spark.createDataFrame([("m", 1, 0.8), ("m", 2, 0.5)], f"{key}, pct_acc double"),
        spark.createDataFrame([("m", 1, "p"), ("m", 1, "q")], f"{key}, path string"),
    )
    got = {r["version"]: tuple(r)[2:] for r in report.collect()}
    assert got == {1: (1, 1, "pass", 1, 1, True), 2: (0, 0, "fail", 0, 0, False), 3: (0, 0, "none", 0, 0, False)}
    assert G.gate_tags(report).count() == 15


def test_signature_diff(spark):
    old = spark.createDataFrame([("a", "int"), ("b", "int"), ("c", "int")], "name string, type string")
    new = spark.createDataFrame([("a", "int"), ("b", "double"), ("d", "int")], "name string, type string")
    assert {(r["name"], r["change"]) for r in G.signature_diff(old, new).collect()} == {
        ("b", "retyped"), ("c", "removed"), ("d", "added")}


# --- monitor ------------------------------------------------------------------

def test_exact_profile_against_numpy(spark):
    """One group holds most rows; large values must not cost digits of the deviation."""
    rng = np.random.default_rng(1)
    rows = [("hot" if i % 4 else "cold", float(1e9 + rng.normal()) if i % 10 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "version string, v double").withColumn("z", F.lit(0.0))
    got = {(r["model_version"], r["column"]): r for r in A.profile(df, ["v", "z"], model="version", exact=True).collect()}
    for name in ("hot", "cold"):
        values = np.array([v for g, v in rows if g == name and v is not None])
        row = got[(name, "v")]
        assert row["n"] == sum(g == name for g, _ in rows) and row["n_null"] == row["n"] - len(values)
        assert row["mean"] == pytest.approx(values.mean(), rel=1e-12) and row["std"] == pytest.approx(values.std(), rel=1e-6)
        assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])), rel=1e-15)
        assert row["n_distinct"] == len(set(values))
        assert got[(name, "z")]["n_zero"] == row["n"] and got[(name, "z")]["std"] == 0.0


def test_profile_of_nulls_only(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    row = A.profile(df, ["v"], exact=True).first()
    assert (row["n"], row["n_null"], row["n_distinct"], row["mean"], row["std"], row["p50"]) == (2, 2, 0, None, None, None)


def test_sketch_profile_agrees_with_the_exact_one(spark, small):
    df = spark.read.parquet(f"{small}/events.parquet")
    exact, sketch = (A.profile(df, ["value"], exact=e).first() for e in (True, False))
    for c in ("n", "n_null", "min", "max", "n_zero"):
        assert exact[c] == sketch[c]
    for c in ("mean", "std"):
        assert exact[c] == pytest.approx(sketch[c], rel=1e-9)
    for c in ("p25", "p50", "p75", "n_distinct"):
        assert exact[c] == pytest.approx(sketch[c], rel=0.1 if c == "n_distinct" else 0.03)


def test_quality_areas_per_slice(spark):
    df = scored(spark)
    rows = A.quality(df, "label", "prediction", slices={"a": "split = 'a'"}, score="score").collect()
    whole = df.filter("label is not null")
    assert {r["slice"]: r["roc_auc"] for r in rows} == pytest.approx({
        "all": pairs_auc(whole.collect()), "a": pairs_auc(whole.filter("split = 'a'").collect())})


def test_fairness_is_zero_for_equal_sides(spark):
    rows = [(s, i % 2, (i // 2) % 2) for s in (0, 1) for i in range(8)]
    df = spark.createDataFrame(rows, "s int, label int, prediction int")
    row = A.fairness(df, {"s": "s = 1"}, "label", "prediction").first()
    assert row["n_in"] == row["n_out"] == 8
    assert all(row[c] == 0.0 for c in row.asDict() if c.endswith(("parity", "opportunity", "equality")))


# --- drift --------------------------------------------------------------------

def sides(spark, base, log):
    return spark.createDataFrame([(True, x) for x in base] + [(False, x) for x in log], "is_baseline boolean, v double")


def test_equal_sides_do_not_drift(spark):
    tagged = sides(spark, [1.0, 2.0, 3.0, 9.0], [9.0, 3.0, 2.0, 1.0])
    for fn in (D.psi, D.js_distance, D.ks, D.wasserstein):
        assert fn(tagged, "v").first()[0] == pytest.approx(0.0, abs=1e-9)
    kinds = tagged.withColumn("v", F.col("v").cast("string"))
    for fn in (D.tv_distance, D.linf_distance, D.chi2):
        assert fn(kinds, "v").first()[0] == pytest.approx(0.0, abs=1e-12)


def test_drift_against_numpy(spark):
    rng = np.random.default_rng(5)
    base, log = rng.normal(0, 1, 400).round(2), rng.normal(0.5, 2, 300).round(2)
    tagged = sides(spark, base.tolist(), log.tolist())
    grid = np.union1d(base, log)
    f, g = ((np.searchsorted(np.sort(x), grid, side="right")) / len(x) for x in (base, log))
    assert D.ks(tagged, "v").first()["ks"] == pytest.approx(np.abs(f - g).max())
    assert D.wasserstein(tagged, "v").first()[0] == pytest.approx((np.abs(f - g)[:-1] * np.diff(grid)).sum())
    edges = np.linspace(base.min(), base.max(), 11)
    edges[0], edges[-1] = -np.inf, np.inf
    q, p = (np.maximum(np.histogram(x, edges)[0] / len(x), D.SMOOTHING) for x in (base, log))
    assert D.psi(tagged, "v").first()["psi"] == pytest.approx(((p - q) * np.log(p / q)).sum(), rel=1e-6)


def test_empty_bins_and_constant_baseline_stay_finite(spark):
    far = D.psi(sides(spark, [0.0, 1.0], [100.0]), "v").first()["psi"]
    assert math.isfinite(far) and far > 1
    assert D.psi(sides(spark, [5.0, 5.0], [5.0]), "v").first()["psi"] == pytest.approx(0.0)
    assert math.isfinite(D.psi(sides(spark, [5.0, 5.0], [4.0, 6.0]), "v").first()["psi"])


def test_tag_of_two_tables_equals_the_marked_table(spark):
    tagged = sides(spark, [1.0, 2.0], [2.0, 5.0])
    joined = D.tag(tagged.filter("not is_baseline"), tagged.filter("is_baseline"), ["v"])
    assert D.ks(joined, "v").first() == D.ks(tagged, "v").first()


def test_retrain_signal(spark):
    df = spark.createDataFrame([("psi", 0.3), ("f1", 0.4), ("f1", None), ("x", 9.0)], "metric string, value double")
    out = {(r["metric"], r["value"]): r["retrain"] for r in D.retrain_signal(df, {"psi": ("above", 0.2), "f1": ("below", 0.3)}).collect()}
    assert out == {("psi", 0.3): True, ("f1", 0.4): False, ("f1", None): False}


# --- scoring and explanation ----------------------------------------------------

def test_udf_and_column_agree_and_metadata(spark):
    from datetime import datetime

    def load():
        return lambda m: (1 / (1 + np.exp(-(m[:, 0] * 2 - m[:, 1]))) > 0.5).astype("int32")

    df = spark.createDataFrame([(float(i % 7), float(i % 5)) for i in range(50)], "a double, b double")
    at = datetime(2024, 1, 1)
    col = batch_score(df, ["a", "b"], as_label(logistic({"a": 2.0, "b": -1.0})), "m", "Champion", 3, at)
    udf = batch_score(df, ["a", "b"], model_udf(load, "int"), "m", "Champion", 3, at)
    assert sorted(map(tuple, col.collect())) == sorted(map(tuple, udf.collect()))
    assert col.columns[2:] == ["prediction", "prediction_time", "model_name", "model_alias", "model_version"]
    assert predicts(df, ["a", "b"], model_udf(load, "int")) == 1

    def broken():
        raise ValueError("no model")

    assert predicts(df, ["a", "b"], model_udf(broken, "int")) == 0
    assert predicts(df, [], F.lit(None).cast("int")) == 0


def test_shapley_sums_to_the_difference(spark):
    """Efficiency: attributions of a non-additive scorer add up to f(x) - mean f(background)."""
    df = spark.createDataFrame([(i, float(i % 4), float(i % 3), float(i % 5)) for i in range(30)], "id int, a double, b double, c double")
    scorer = F.col("a") * F.col("b") + F.col("c")
    values = E.shapley_values(df.filter("id < 10"), df.filter("id >= 10"), ["a", "b", "c"], ["id"], scorer, n=20, permutations=3)
    got = {r["id"]: r["s"] for r in values.groupBy("id").agg(F.sum("attribution").alias("s")).collect()}
    base = df.filter("id >= 10").agg(F.avg(scorer)).first()[0]
    want = {r["id"]: r["f"] - base for r in df.filter("id < 10").select("id", scorer.alias("f")).collect()}
    assert got == pytest.approx(want)


def test_at_risk_takes_the_latest_score_of_the_day(spark):
    df = spark.sql("""select * from values (1, timestamp '2024-01-01 08:00', 1, 0.9D), (1, timestamp '2024-01-01 09:00', 0, 0.1D),
        (2, timestamp '2024-01-01 07:00', 1, 0.6D), (1, timestamp '2024-01-02 01:00', 1, 0.7D) t(k, ts, p, s)""")
    assert [(str(r["day"]), r["k"]) for r in O.at_risk_daily(df, "k", "ts", "p", "s").collect()] == [
        ("2024-01-01", 2), ("2024-01-02", 1)]


def test_category_profile_counts_nulls_and_breaks_ties(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("b",), (None,)], "c string")
    row = A.category_profile(df, ["c"]).first()
    assert (row["n"], row["n_null"], row["n_distinct"], row["top_value"], row["top_rows"]) == (5, 1, 2, "b", 2)
    nothing = A.category_profile(df.filter("c is null"), ["c"]).first()
    assert (nothing["n"], nothing["n_null"], nothing["n_distinct"], nothing["top_value"]) == (1, 1, 0, None)


def test_windowed_drift_equals_the_plain_statistics(spark):
    rng = np.random.default_rng(9)
    rows = [(bool(i % 2), "xy"[i % 3 % 2], float(rng.normal(i % 2, 1)), "abc"[int(rng.integers(0, 2 + i % 2))]) for i in range(400)]
    df = spark.createDataFrame(rows, "is_baseline boolean, slice string, v double, c string")
    log, base = df.filter("not is_baseline"), df.filter("is_baseline")
    assert D.window_psi(log, base, "v", []).first()["psi"] == pytest.approx(D.psi(df, "v").first()["psi"])
    assert D.window_psi(log, base, "v", []).first()["js_distance"] == pytest.approx(D.js_distance(df, "v").first()[0])
    for side in "xy":
        part = df.filter(F.col("slice") == side)
        got = D.window_tv(log, base, "c", ["slice"], ["slice"]).filter(F.col("slice") == side).first()
        assert got["tv_distance"] == pytest.approx(D.tv_distance(part, "c").first()[0])
    table = D.baseline_drift(log, base, ["v"], ["c"], ["slice"], ["slice"])
    assert table.count() == 6 and table.columns == ["slice", "column", "kind", "metric", "value"]
