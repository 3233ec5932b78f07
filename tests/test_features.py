from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import features as P
from keelson.operators import train


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("1", "Yes", "Bank transfer (automatic)", 1.0, "Yes"), ("2", "No", None, 2.0, "No"),
         ("3", None, "Mailed check", 3.0, "Maybe"), ("4", "No", "Mailed check", None, "No"),
         ("5", "Yes", "Mailed check", 5.0, None)],
        "customer_id string, partner string, payment string, charges double, churn string",
    )


def test_featuriser(people):
    spec = P.FeatureSpec(["partner", "payment"], "churn").fit(people)
    out = spec.transform(people)
    assert out.columns == [
        "customer_id", "charges", "churn", "partner_no", "partner_yes",
        "payment_bank_transfer__automatic_", "payment_mailed_check",
    ]
    assert {tuple(r) for r in out.collect()} == {("1", 1.0, 1, 0, 1, 1, 0), ("2", 2.0, 0, 1, 0, 0, 0)}
    assert dict(out.dtypes)["churn"] == "int" and dict(out.dtypes)["partner_no"] == "bigint"
    scoring = {r["customer_id"] for r in spec.transform(people, training=False).collect()}
    assert scoring == {"1", "2", "3", "5"}  # unlabelled rows stay, the one without charges does not


def test_batch_keeps_the_fitted_columns(spark, people):
    spec = P.FeatureSpec.from_dict(P.FeatureSpec(["partner", "payment"], "churn").fit(people).to_dict())
    batch = spark.createDataFrame([("9", "Unknown", "Mailed check", 1.0, "No")], people.schema)
    out = spec.transform(batch)
    assert out.columns == spec.transform(people).columns
    row = out.first()
    assert row["partner_no"] == row["partner_yes"] == 0 and row["payment_mailed_check"] == 1
    assert [tuple(r) for r in P.unseen_categories(batch, spec.vocab).collect()] == [("partner", "Unknown", 1)]


def test_dummies_of_a_group_sum_to_one_or_zero(people):
    out = P.one_hot(people, P.fit_vocab(people, ["partner"]))
    sums = {r["s"] for r in out.select((F.col("partner_No") + F.col("partner_Yes")).alias("s")).collect()}
    assert sums == {0, 1}
    assert "partner_No" not in P.one_hot(people, P.fit_vocab(people, ["partner"]), drop_first=True).columns


def test_transform_is_one_projection(people):
    out = P.FeatureSpec(["partner", "payment"], "churn").fit(people).transform(people)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and plan.count("Project") <= 1


def test_too_many_categories_are_refused(spark):
    with pytest.raises(ValueError, match="too many categories"):
        P.fit_vocab(spark.range(50).select(F.col("id").cast("string").alias("c")), ["c"], max_categories=10)


def test_numeric_spec(spark):
    df = spark.createDataFrame([("1", 7), ("3", 7), ("x", 7), (None, 7)], "a string, b int")
    spec = P.NumericSpec(["a", "b"]).fit(df)
    assert spec.means == {"a": 2.0, "b": 7.0}
    assert [r["a"] for r in spec.impute(df).collect()] == [1.0, 3.0, 2.0, 2.0]
    scaled = spec.transform(df).collect()
    assert [r["b"] for r in scaled] == [0.0] * 4  # a constant column
    filled = [1.0, 3.0, 2.0, 2.0]
    deviation = (sum((x - 2.0) ** 2 for x in filled) / 4) ** 0.5
    assert [r["a"] for r in scaled] == pytest.approx([(x - 2.0) / deviation for x in filled])
    with pytest.raises(ValueError, match="no numeric value"):
        P.NumericSpec(["a"]).fit(df.filter("a = 'x'"))


def test_supported_and_signature(people):
    assert P.select_supported(people, ["charges"]).columns == ["charges"]
    with pytest.raises(ValueError, match="missing columns: \\['nope'\\]"):
        P.select_supported(people, ["nope"])
    wide = T.StructType([T.StructField("charges", T.FloatType())])
    assert P.select_signature(people, wide).dtypes == [("charges", "float")]
    with pytest.raises(TypeError, match="partner: string is not double"):
        P.select_signature(people, T.StructType([T.StructField("partner", T.DoubleType())]))


def test_modes_and_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert P.mode_values(df, ["c"]) == {"c": "b"}  # the greater value wins a tie
    assert [r["c"] for r in P.mode_impute(df, ["c"]).collect()].count("b") == 3
    classes = P.fit_labels(df, "c")
    codes = [r["k"] for r in P.label_encode(df, "c", classes, "k").collect()]
    assert [tuple(r) for r in classes.collect()] == [("a", 0), ("b", 1)] and sorted(codes, key=str) == [0, 0, 1, 1, None]


def test_values_and_names_with_dots(spark):
    df = spark.createDataFrame([("a.b", "x`y", 1.0), ("c", None, None)], "`k.d` string, v string, `n.o` double")
    spec = P.FeatureSpec(["k.d", "v"]).fit(df)
    out = spec.transform(df)
    assert out.columns == ["n.o", "k.d_a.b", "k.d_c", "v_x`y"] and out.count() == 1
    assert P.drop_nulls(df).count() == 1 and P.select_supported(df, ["k.d"]).columns == ["k.d"]


def test_wide_one_hot(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    rows = P.wide_one_hot(df, ["c"]).transform(df.union(spark.createDataFrame([("z",)], "c string"))).collect()
    assert [list(r["encoded"].toArray()) for r in rows] == [[1, 0], [0, 1], [0, 0], [0, 0]]


def test_wide_encoder_of_two_columns_and_its_stored_form(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", None), (None, 10)], "c string, `n.x` int")
    spec = P.wide_one_hot(df, ["n.x", "c"], "cells")
    spec.save(str(tmp_path / "w"))
    more = df.union(spark.createDataFrame([("zz", 1)], df.schema))
    for encoder in (spec, P.WideEncoder.load(spark, str(tmp_path / "w"))):
        got = {(r.c, r["n.x"]): (r.cells.size, list(r.cells.indices)) for r in encoder.transform(more).collect()}
        assert got == {("b", 2): (6, [2, 4]), ("a", 1): (6, [0, 3]), ("c", None): (6, [5]), (None, 10): (6, [1]), ("zz", 1): (6, [0])}
    assert [(r["column"], r.value, r.slot) for r in spec.slots.orderBy("slot").collect()] == [
        ("n.x", "1", 0), ("n.x", "10", 1), ("n.x", "2", 2), ("c", "a", 3), ("c", "b", 4), ("c", "c", 5)]
    empty = P.wide_one_hot(df.limit(0), ["c"]).transform(df)
    assert empty.count() == 4 and all(r.encoded.numNonzeros() == 0 for r in empty.collect())


def test_any_number_of_values_is_encoded_and_trained_on(spark):
    """More values than a vocabulary of columns takes; classes numbered without a window over all of them."""
    rows = spark.range(6000).select(
        "id", F.concat(F.lit("v"), (F.col("id") % 1500).cast("string")).alias("shop"), (F.col("id") % 7).cast("double").alias("x"),
        F.when(F.col("id") % 1500 < 700, "Yes").otherwise("No").alias("churn"), F.when(F.col("id") < 1500, "val").otherwise("train").alias("split"))
    with pytest.raises(ValueError, match="too many categories"):
        P.FeatureSpec(["shop"], "churn").fit(rows)
    spec = P.FeatureSpec.from_dict(P.FeatureSpec(["shop"], "churn", wide=["shop"]).fit(rows).to_dict())
    features = spec.transform(rows)
    assert features.columns == rows.columns and features.count() == 6000
    model = train.fit_wide(features, ["shop"], ["x"], "churn", "logistic", {"reg": 0.0, "iterations": 20})
    scored = train.score(model, features)
    assert scored.filter("split = 'val' AND prediction = churn").count() >= 0.95 * scored.filter("split = 'val'").count()
    assert not [c for c in scored.columns if c.startswith("_")]
    plan = P.fit_labels(rows, "shop")._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and sorted((r.value, r["index"]) for r in P.fit_labels(rows, "shop").collect()) == [
        (v, i) for i, v in enumerate(sorted(f"v{i}" for i in range(1500)))]
