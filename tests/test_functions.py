from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from keelson.functions import text as X
from keelson.functions.hashing import bucket
from keelson.functions.running import running_totals
from keelson.operators.splits import sample_n, split, with_split


def test_clean_name_keeps_other_characters():
    assert X.clean_name("payment_method_Bank transfer (automatic)") == "payment_method_bank_transfer__automatic_"
    assert X.clean_name("Brand#1.x") == "brand#1.x"


def test_names_that_collide_are_named_in_the_error():
    with pytest.raises(ValueError, match="'a b' and 'a-b'"):
        X.clean_names(["a b", "c", "a-b"])


@pytest.mark.parametrize("user, slug", [("a.b@c@x.io", "a_b_c"), ("@x", "_x"), ("plain", "plain")])
def test_user_slug(spark, user, slug):
    assert X.user_slug(user) == slug
    row = spark.createDataFrame([(user,)], "u string").select(X.identifier(X.cut_domain("u")).alias("s")).first()
    assert row["s"] == slug


def test_quote_name_quotes_each_part():
    assert X.quote_name("d", "t`x") == "`d`.`t``x`"


def test_value_functions(spark):
    df = spark.createDataFrame([("Yes", "1.5", "val_val_a"), ("Maybe", " x", "b"), (None, None, None)], "c string, n string, m string")
    rows = df.select(
        X.value_map("c", {"Yes": 1, "No": 0}).alias("c"), X.try_numeric("n").alias("n"), X.strip_prefix("m", "val_").alias("m")
    ).collect()
    assert [tuple(r) for r in rows] == [(1, 1.5, "val_a"), (None, None, "b"), (None, None, None)]


def test_tag_lookup_and_split(spark):
    df = spark.createDataFrame([({"k": "a,b"},), ({},)], "tags map<string,string>")
    rows = df.select(X.split_list(X.tag_lookup("tags", "k")).alias("v")).collect()
    assert [r["v"] for r in rows] == [["a", "b"], ["none"]]


def test_bucket_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).withColumn("b", bucket("id"))
    one, many = df.coalesce(1).collect(), df.repartition(7).collect()
    assert {r["id"]: r["b"] for r in one} == {r["id"]: r["b"] for r in many}
    assert all(0 <= r["b"] < 100 for r in one)


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(500)
    a, b = split(df, ["id"], 90)
    left, right = {r["id"] for r in a.collect()}, {r["id"] for r in b.collect()}
    assert not left & right and len(left | right) == 500 and 400 < len(left) < 490
    assert with_split(df, ["id"]).select("split").distinct().count() == 3


def test_sample_is_seeded_and_bounded(spark):
    df = spark.range(300)
    first = [r["id"] for r in sample_n(df, ["id"], 100, 7).collect()]
    again = [r["id"] for r in sample_n(df.repartition(5), ["id"], 100, 7).collect()]
    assert first == again and len(set(first)) == 100
    assert sample_n(df.limit(5), ["id"], 100, 7).count() == 5


@pytest.mark.parametrize("slices", [2, 3, 8, 33])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_totals_against_pandas(spark, slices, by):
    """Skewed values: one group and one narrow range hold most rows."""
    rows = [("hot" if i % 3 else None, float(i % 97) / 7 + (1e6 if i % 50 == 0 else 0)) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double")
    counts = df.groupBy(*by, "v").agg(F.count("*").alias("n"))
    got = running_totals(counts, "v", {"n": "n"}, by, slices).toPandas()
    frame = pd.DataFrame(rows, columns=["g", "v"]).fillna({"g": "-"})
    want = frame.groupby([*by, "v"]).size().rename("n").reset_index().sort_values([*by, "v"])
    want["cum_n"] = want.groupby(by).n.cumsum() if by else want.n.cumsum()
    want["next_value"] = want.groupby(by).v.shift(-1) if by else want.v.shift(-1)
    got = got.fillna({"g": "-"}) if by else got
    got = got.sort_values([*by, "v"])[[*by, "v", "n", "cum_n", "next_value"]].reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want[got.columns].reset_index(drop=True), check_dtype=False)


def test_running_totals_on_nothing(spark):
    df = spark.createDataFrame([], "v double, n bigint")
    assert running_totals(df, "v", {"n": "n"}).collect() == []
