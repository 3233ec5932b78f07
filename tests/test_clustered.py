from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from keelson.sources import tables as S
from keelson.sources.clustered import FILE, ClusteredTable

SCHEMA = "k long, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def made(spark, name, n=2000, per_file=100, keys=("k",)):
    store = ClusteredTable(spark, name, per_file).create(spark.createDataFrame([], SCHEMA).schema, keys, "it's clustered", replace=True)
    store.merge(spark.range(n).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    return store


def paths(spark, store):
    found = spark.table(store.current_version()).select(F.col(FILE).alias("f"), F.col("_metadata.file_path").alias("p")).distinct().collect()
    return {r.f: r.p.removeprefix("file:") for r in found}


def test_files_are_ranges_and_a_merge_rewrites_what_it_touches(spark, database):
    store = made(spark, f"{database}.ranges")
    spans = spark.table(store.current_version()).groupBy(FILE).agg(F.min("k").alias("a"), F.max("k").alias("z")).orderBy("a").collect()
    assert len(spans) >= 15 and all(x.z < y.a for x, y in zip(spans, spans[1:]))
    before = paths(spark, store)
    size = {f: os.path.getsize(p) for f, p in before.items()}
    store.merge(spark.range(500, 510).select(F.col("id").alias("k"), F.lit("b").alias("v")))  # half a per cent
    now = paths(spark, store)
    stay = before.keys() & now.keys()
    assert len(before) - len(stay) <= 2 and all(before[f] == now[f] for f in stay)
    written = sum(os.path.getsize(p) for f, p in now.items() if f not in before)
    assert written <= 0.2 * sum(size.values())
    assert store.read().where("v = 'b'").count() == 10 and store.read().count() == 2000


def test_keys_reach_the_files(spark, database):
    store = made(spark, f"{database}.pushed")
    update = spark.createDataFrame([(700, "x"), (1500, "y"), (5000, "z")], SCHEMA)
    assert len(store.touched(update)) == 2 and store.touched(update.limit(0)) == []
    assert store.touched(update.where("k = 5000")) == []
    assert spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold") == "10"
    hadoop, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(next(iter(paths(spark, store).values())))
    opened = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, hadoop))
    key, value = opened.getFooter().getBlocks().get(0).getColumns()
    assert key.getBloomFilterOffset() > 0 > value.getBloomFilterOffset()
    opened.close()


def test_merges_match_the_other_layouts(spark, database):
    one, two = made(spark, f"{database}.one", 300, 40), S.KeyedTable(spark, f"{database}.two", 4)
    two.create(spark.createDataFrame([], SCHEMA).schema, ["k"], replace=True).merge(one.read())
    for batch in ([(5, "x"), (301, "n")], [(-4, "m"), (299, "y"), (301, "o")], [], [(i, "all") for i in range(0, 300, 7)]):
        update = spark.createDataFrame(batch, SCHEMA)
        for store in (one, two):
            store.merge(update)
        assert rows(one.read()) == rows(two.read())
    dropped = one.vacuum()
    assert len(dropped) == 4 and rows(one.read()) == rows(two.read())
    one.recluster()
    assert rows(one.read()) == rows(two.read()) and len(one.files()) <= 10
    again = ClusteredTable(spark, one.name)
    assert again.keys() == ["k"] and again.description() == "it's clustered" and again.rows_per_file() == 40
    one.drop()
    assert not one.exists() and one.versions() == []


def test_broken_keys_and_latest(spark, database):
    store = made(spark, f"{database}.strict", 50, 10)
    for bad in ([(2, "x"), (2, "y")], [(None, "x")]):
        with pytest.raises(ValueError, match="breaks the key"):
            store.merge(spark.createDataFrame(bad, SCHEMA))
    store.merge(spark.createDataFrame([(2, "x"), (2, "y"), (60, "n"), (3, "0")], SCHEMA), on_duplicate="latest", order=["v"])
    got = dict(rows(store.read()))
    assert (got[2], got[60], got[3], len(got)) == ("y", "n", "a", 51)
    with pytest.raises(ValueError, match="not in the schema"):
        ClusteredTable(spark, f"{database}.nokey").create(store.read().schema, ["other"])


def test_clone_keeps_its_files(spark, database):
    store = made(spark, f"{database}.cloned", 100, 10)
    S.clone(spark, store.name, f"{database}.cloned_view")
    store.merge(spark.range(100).select(F.col("id").alias("k"), F.lit("b").alias("v")))
    store.vacuum()
    assert {r.v for r in spark.table(f"{database}.cloned_view").collect()} == {"a"} and {r.v for r in store.read().collect()} == {"b"}
