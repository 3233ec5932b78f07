from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keelson.sources import tables as S
from keelson.sources.model_tables import open_table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_bad_cells_become_null(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,n\na,1.5\nb,\" \"\nc,abc\nd,\n")
    assert rows(S.read_csv(spark, str(path), "id string, n double")) == [("a", 1.5), ("b", None), ("c", None), ("d", None)]


def test_append_aligns_by_name_and_refuses_other_columns(spark, database):
    name = f"{database}.appended"
    S.append(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    S.append(spark.createDataFrame([("b", 2)], "v string, k int"), name)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="missing"):
        S.append(spark.createDataFrame([(3,)], "k int"), name)


def test_overwrite_replaces_the_schema(spark, database):
    name = f"{database}.over"
    S.overwrite(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    S.overwrite(spark.createDataFrame([(1.5,)], "x double"), name)
    assert spark.table(name).columns == ["x"]


def keyed(spark, name, parts=None):
    return S.KeyedTable(spark, name, parts).create(
        spark.createDataFrame([], "k int, v string").schema, ["k"], "it's keyed", replace=True
    )


@pytest.mark.parametrize("parts", [None, 4])
def test_merge_updates_inserts_and_is_idempotent(spark, database, parts):
    store = keyed(spark, f"{database}.merge_{parts}", parts)
    store.merge(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    update = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    store.merge(update)
    want = [(1, "a"), (2, "B"), (3, "c")]
    assert rows(store.read()) == want
    store.merge(update)
    assert rows(store.read()) == want
    store.merge(update.limit(0))
    assert rows(store.read()) == want
    again = S.KeyedTable(spark, store.name)
    assert again.keys() == ["k"] and again.description() == "it's keyed" and again.parts() == parts
    assert len(store.vacuum()) == (3 if parts else 4) and rows(store.read()) == want
    store.drop()
    assert not store.exists() and store.versions() == []


def test_merge_refuses_broken_keys_and_keeps_the_table(spark, database):
    store = keyed(spark, f"{database}.broken")
    store.merge(spark.createDataFrame([(1, "a")], "k int, v string"))
    for bad in ([(2, "x"), (2, "y")], [(None, "x")]):
        with pytest.raises(ValueError, match="breaks the key"):
            store.merge(spark.createDataFrame(bad, "k int, v string"))
    assert rows(store.read()) == [(1, "a")]
    store.merge(spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string"), on_duplicate="latest", order=["v"])
    assert rows(store.read()) == [(1, "a"), (2, "y")]


def test_create_keeps_an_existing_table(spark, database):
    store = keyed(spark, f"{database}.kept")
    store.merge(spark.createDataFrame([(1, "a")], "k int, v string"))
    store.create(store.read().schema, ["k"])
    assert rows(store.read()) == [(1, "a")]
    assert keyed(spark, store.name).read().count() == 0


def files_of(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_merge_leaves_untouched_partitions_where_they_are(spark, database):
    store = keyed(spark, f"{database}.still", 8)
    store.merge(spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")))
    first = store.current_version()
    before = {r["_part"]: files_of(spark.table(first).where(F.col("_part") == r["_part"])) for r in spark.table(first).select("_part").distinct().collect()}
    store.merge(spark.createDataFrame([(3, "b")], "k int, v string"))
    now = spark.table(store.current_version())
    (touched,) = {r["_part"] for r in now.where("k = 3").collect()}
    for part, files in before.items():
        assert (files_of(now.where(F.col("_part") == part)) == files) == (part != touched)
    plan = now.where(F.col("_part") == touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan
    assert store.vacuum() and store.read().count() == 200 and rows(store.read().where("k = 3")) == [(3, "b")]


def test_only_own_versions_are_dropped(spark, database):
    store = keyed(spark, f"{database}.features")
    for name in ("features__vendors", "features__v" + "a" * 32):
        S.overwrite(spark.range(3), f"{database}.{name}")
    store.merge(spark.createDataFrame([(1, "a")], "k int, v string"))
    store.vacuum()
    store.create(store.read().schema, ["k"], replace=True)
    store.drop()
    assert spark.table(f"{database}.features__vendors").count() == 3 == spark.table(f"{database}.features__v" + "a" * 32).count()


def test_latest_compares_with_the_stored_row(spark, database):
    schema = "k int, at int, v string"
    store = S.KeyedTable(spark, f"{database}.late", 4).create(spark.createDataFrame([], schema).schema, ["k"], replace=True)
    for batch in ([(1, 9, "new"), (2, 1, "x")], [(1, 1, "old"), (3, 1, "y")], [(2, 1, "again")]):
        store.merge(spark.createDataFrame(batch, schema), on_duplicate="latest", order=["at"])
    assert rows(store.read()) == [(1, 9, "new"), (2, 1, "again"), (3, 1, "y")]


@pytest.mark.parametrize("parts", [None, 4])
def test_tasks_of_a_latest_merge_grow_with_its_rows(spark, database, monkeypatch, parts):
    """No task takes more than its share, a key that comes often included, and rows without a key stay apart."""
    monkeypatch.setattr(S, "TASK_ROWS", 200, raising=False)
    table = S.KeyedTable(spark, f"{database}.grown_{parts or 0}", parts)
    table.create(spark.createDataFrame([], "id long, at int, v string").schema, ["id"])
    rows = spark.range(2000).selectExpr("if(id < 500, 7, id) id", "cast(id as int) at", "concat('a', id) v")
    for _ in range(2):
        table.merge(rows.unionByName(spark.sql("SELECT cast(null as long) id, 1 at, 'n' v")), "latest", ["at"])
    got = sorted(((r.id, r.at, r.v) for r in table.read().collect()), key=str)
    assert got == sorted([(7, 499, "a499"), *((i, i, f"a{i}") for i in range(500, 2000)), (None, 1, "n"), (None, 1, "n")], key=str)
    files = spark.table(table.current_version()).groupBy("_metadata.file_path").count()
    assert files.agg(F.max("count")).first()[0] <= 400


def test_first_load_that_breaks_the_key_leaves_nothing(spark, database):
    for parts in (None, 4):
        store = keyed(spark, f"{database}.first_{parts}", parts)
        with pytest.raises(ValueError, match="breaks the key"):
            store.merge(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"))
        assert store.read().count() == 0 and len(store.versions()) == 1


def test_latest_row_with_maps_and_dots(spark):
    df = spark.createDataFrame([(1, 2, {"a": 1}), (1, 3, {"b": 2}), (1, 3, {"b": 2})], "k int, `at.t` int, m map<string,int>")
    assert rows(S.latest_per_key(df, ["k"], ["at.t"])) == [(1, 3, {"b": 2})]
    assert S.align(df, df.schema).columns == ["k", "at.t", "m"]


def test_clone_is_pinned(spark, database):
    store = keyed(spark, f"{database}.origin")
    store.merge(spark.createDataFrame([(1, "a")], "k int, v string"))
    S.clone(spark, store.name, f"{database}.pinned")
    store.merge(spark.createDataFrame([(1, "z")], "k int, v string"))
    S.clone(spark, store.name, f"{database}.pinned")
    assert rows(spark.table(f"{database}.pinned")) == [(1, "a")] and rows(store.read()) == [(1, "z")]


def test_drop_table_quotes_each_part(spark, database):
    S.overwrite(spark.range(1), f"{database}.gone")
    S.drop_table(spark, f"{database}.gone")
    S.drop_table(spark, f"{database}.gone")
    assert not spark.catalog.tableExists(f"{database}.gone")


def test_insert_missing_and_violations(spark):
    base = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(S.insert_missing(base, spark.createDataFrame([(1,), (2,)], "k int"), ["k"])) == [(2,)]
    assert {tuple(r) for r in S.key_violations(base, ["k"]).collect()} == {(1, 2), (None, 1)}


def test_model_tables_round_trip(spark, database):
    runs = open_table(spark, "runs", database)
    runs.merge(spark.createDataFrame([("r", "e", "FINISHED", {"f1": 0.5}, {}, {"k": "v"})], runs.read().schema))
    assert runs.read().first()["metrics"] == {"f1": 0.5}


def test_catalogs(spark):
    assert "spark_catalog" in S.list_catalogs(spark) and S.list_catalogs(spark, ["spark_catalog"]) == []


def test_clone_of_a_versioned_table_survives_another_schema(spark, database):
    source = S.VersionedTable(spark, f"{database}.plain")
    source.overwrite(spark.createDataFrame([(1, "a")], "k int, v string"))
    S.clone(spark, source.name, f"{database}.plain_clone")
    source.overwrite(spark.createDataFrame([(2.0,)], "x double"))
    assert rows(spark.table(f"{database}.plain_clone")) == [(1, "a")] and rows(source.read()) == [(2.0,)]
