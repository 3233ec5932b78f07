"""Registered queries: scans, sinks, keyed tables, splits and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions import text as X
from keelson.operators.splits import TRAIN_VAL_TEST, sample_n, split_marker
from keelson.plans.registry import flag, query, sql_bucket, table
from keelson.functions.hashing import bucket
from keelson.session import scratch_path
from keelson.sources import tables as S
from keelson.sources.clustered import FILE, ClusteredTable


def scratch_database(spark: SparkSession) -> str:
    """One database per application below the shared scratch folder."""
    name = "keelson_" + X.user_slug(spark.sparkContext.applicationId).lower()
    if not spark.catalog.databaseExists(name):
        path = scratch_path(spark, "database").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{path}'")
    return name


def fresh_database(spark: SparkSession) -> str:
    """A database of its own below the shared scratch folder."""
    name = scratch_name(spark, "db").split(".")[1]
    path = scratch_path(spark, "database").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{path}'")
    S.create_database(spark, name)  # there already: nothing happens
    return name


def scratch_name(spark: SparkSession, label: str) -> str:
    import uuid

    return f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex[:12]}"


@query("table_scan", "select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders")
def table_scan(spark, sf_dir) -> DataFrame:
    orders = S.scan_parquet(spark, f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("csv_ingest", """
select c_custkey::varchar customer_id, c_name as name, c_nationkey nation, c_mktsegment segment,
       case when c_acctbal >= 0 then c_acctbal end balance
from customer""")
def csv_ingest(spark, sf_dir) -> DataFrame:
    """Negative balances are written as text that is not a number."""
    path = scratch_path(spark, "csv")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise(F.lit("n/a"))
    table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), balance.alias("balance"),
    ).write.csv(path, header=True)
    return S.read_csv(spark, path, "customer_id string, name string, nation int, segment string, balance double")


@query("feature_read", """
select o_orderkey, o_totalprice, case when o_orderstatus = 'F' then 1 else 0 end closed from orders""")
def feature_read(spark, sf_dir) -> DataFrame:
    """The feature table's name is taken from a run's tags."""
    features = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", flag(F.col("o_orderstatus") == "F").alias("closed")
    )
    store = S.KeyedTable(spark, scratch_name(spark, "order_features"))
    store.create(features.schema, ["o_orderkey"], "order features").merge(features)
    tagged = spark.range(1).select(F.create_map(F.lit("db_table"), F.lit(store.name)).alias("tags"))
    name = tagged.select(X.tag_lookup("tags", "db_table").alias("name")).first()["name"]
    return S.scan_table(spark, name)


@query("overwrite_roundtrip", "select c_custkey, c_name, round(c_acctbal * 2, 2) double_balance from customer")
def overwrite_roundtrip(spark, sf_dir) -> DataFrame:
    """The second write replaces the schema of the first."""
    name = scratch_name(spark, "overwritten")
    customer = table(spark, sf_dir, "customer")
    S.overwrite(customer.select("c_custkey", "c_nationkey"), name)
    doubled = customer.select("c_custkey", "c_name", F.round(F.col("c_acctbal") * 2, 2).alias("double_balance"))
    S.overwrite(doubled, name)
    return spark.table(name)


@query("append_log", "select event_id, ts, value, case when value > 20 then 1 else 0 end prediction from events")
def append_log(spark, sf_dir) -> DataFrame:
    """Two appends, the second with its columns in another order."""
    name = scratch_name(spark, "log")
    scored = table(spark, sf_dir, "events").select(
        "event_id", "ts", "value", flag(F.col("value") > 20).alias("prediction")
    )
    part = bucket("event_id") < 25
    S.append(scored.filter(part), name)
    S.append(scored.filter(~part).select("prediction", "value", "event_id", "ts"), name)
    return spark.table(name)


@query("key_violations", "select o_custkey, count(*) row_count from orders group by 1 having count(*) > 1")
def key_violations(spark, sf_dir) -> DataFrame:
    return S.key_violations(table(spark, sf_dir, "orders"), ["o_custkey"])


@query("feature_upsert", f"""
with base as (select o_orderkey, o_custkey, o_totalprice from orders where {sql_bucket('o_orderkey')} < 90),
upd as (select o_orderkey, o_custkey, round(o_totalprice + 1, 2) o_totalprice from orders
        where {sql_bucket('o_orderkey')} >= 85)
select * from base where o_orderkey not in (select o_orderkey from upd) union all select * from upd""")
def feature_upsert(spark, sf_dir) -> DataFrame:
    """The parts overlap: some update rows replace, the others are new."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    place = bucket("o_orderkey")
    updates = orders.filter(place >= 85).withColumn("o_totalprice", F.round(F.col("o_totalprice") + 1, 2))
    return S.upsert(orders.filter(place < 90), updates, ["o_orderkey"])


@query("keyed_merge", f"""
select o_orderkey, case when {sql_bucket('o_orderkey')} >= 85 then round(o_totalprice + 1, 2)
       else o_totalprice end o_totalprice from orders""")
def keyed_merge(spark, sf_dir) -> DataFrame:
    """The same upsert through a keyed table: create, load, merge, read."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    place = bucket("o_orderkey")
    store = S.KeyedTable(spark, scratch_name(spark, "merged"), parts=8)
    store.create(orders.schema, ["o_orderkey"], "orders by key").merge(orders.filter(place < 90))
    store.merge(orders.filter(place >= 85).withColumn("o_totalprice", F.round(F.col("o_totalprice") + 1, 2)))
    return store.read()


@query("snapshot_clone", "select c_custkey, c_acctbal from customer")
def snapshot_clone(spark, sf_dir) -> DataFrame:
    """The clone keeps the version it was taken from while the source moves on."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    store = S.KeyedTable(spark, scratch_name(spark, "source"))
    store.create(customer.schema, ["c_custkey"]).merge(customer)
    target = scratch_name(spark, "clone")
    S.clone(spark, store.name, target)
    store.merge(customer.withColumn("c_acctbal", F.lit(0.0)))
    return spark.table(target)


@query("replace_keeps_clone", "select c_custkey, c_acctbal from customer")
def replace_keeps_clone(spark, sf_dir) -> DataFrame:
    """The source starts afresh and is cleaned up; the clone still reads its version."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    store = S.KeyedTable(spark, scratch_name(spark, "replaced"), parts=4)
    store.create(customer.schema, ["c_custkey"]).merge(customer)
    target = scratch_name(spark, "clone")
    S.clone(spark, store.name, target)
    store.create(customer.schema, ["c_custkey"], replace=True).merge(customer.limit(10))
    store.vacuum()
    return spark.table(target)


@query("merge_touched_partitions", """
select o_orderkey, case when o_orderkey <= 40 then -1.0 else o_totalprice end o_totalprice from orders""")
def merge_touched_partitions(spark, sf_dir) -> DataFrame:
    """A small update reads and writes only the partitions its keys lie in."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    store = S.KeyedTable(spark, scratch_name(spark, "touched"), parts=64)
    store.create(orders.schema, ["o_orderkey"]).merge(orders)
    store.merge(orders.filter("o_orderkey <= 40").withColumn("o_totalprice", F.lit(-1.0)))
    return store.read()


@query("merge_touched_files", """
select o_orderkey, o_custkey, case when o_orderkey <= (select max(o_orderkey) from orders) / 200 then -1.0 else o_totalprice end o_totalprice,
       true most_files_stay, true written_in_proportion from orders
union all select (select max(o_orderkey) from orders) + 1 + c_custkey, c_custkey, c_acctbal, true, true from customer where c_custkey <= 10""")
def merge_touched_files(spark, sf_dir) -> DataFrame:
    """Half a per cent of the keys, neighbours of each other, and a few new ones: the other files stay where they are."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    store = ClusteredTable(spark, scratch_name(spark, "clustered"), rows_per_file=max(1, orders.count() // 40))
    store.create(orders.schema, ["o_orderkey"], "orders in ranges of the key").merge(orders)
    before = store.files()
    highest = orders.agg(F.max("o_orderkey")).first()[0]
    changed = orders.filter(F.col("o_orderkey") <= highest / 200).withColumn("o_totalprice", F.lit(-1.0))
    new = table(spark, sf_dir, "customer").filter("c_custkey <= 10").select((F.col("c_custkey") + (highest + 1)).alias("o_orderkey"),
        F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("o_totalprice"))
    store.merge(changed.unionByName(new))
    stay = set(before) & set(store.files())
    version = spark.table(store.current_version())
    share = version.agg(F.avg(F.when(F.col(FILE).isin(sorted(stay)), 0.0).otherwise(1.0))).first()[0]
    return store.read().withColumns({
        "most_files_stay": F.lit(len(stay) >= 0.9 * len(before)), "written_in_proportion": F.lit(share <= 0.1)})


@query("merge_scattered_files", f"""
select o_orderkey, o_custkey, case when {sql_bucket('o_orderkey')} = 7 then -1.0 else o_totalprice end o_totalprice from orders""")
def merge_scattered_files(spark, sf_dir) -> DataFrame:
    """Keys from everywhere, two per row of the key: a price and a customer; then one more clustering."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    store = ClusteredTable(spark, scratch_name(spark, "scattered"), rows_per_file=max(1, orders.count() // 5))
    store.create(orders.schema, ["o_custkey", "o_orderkey"]).merge(orders.filter(bucket("o_orderkey") != 7))
    store.merge(orders.filter(bucket("o_orderkey") == 7).withColumn("o_totalprice", F.lit(0.0)))
    store.merge(orders.filter(bucket("o_orderkey") == 7).withColumn("o_totalprice", F.lit(-1.0)))
    store.recluster()
    store.vacuum()
    return store.read()


@query("latest_runs", """
select o_custkey, arg_max(o_orderkey, o_orderkey) last_order, arg_max(o_orderstatus, o_orderkey) status from orders group by 1""")
def latest_runs(spark, sf_dir) -> DataFrame:
    """The latest row per key with a map among its columns."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("tags"))
    return S.latest_per_key(orders, ["o_custkey"], ["o_orderkey"]).select(
        "o_custkey", F.col("o_orderkey").alias("last_order"), F.col("tags")["status"].alias("status"))


@query("preview_limit", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def preview_limit(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return S.preview(orders, 20, F.col("o_totalprice").desc(), "o_orderkey")


@query("prefix_columns", "select c_nationkey, c_name from customer")
def prefix_columns(spark, sf_dir) -> DataFrame:
    """The columns whose names start alike."""
    customer = table(spark, sf_dir, "customer")
    return customer.select(*X.prefixed(customer.columns, "c_na"))


@query("namespaces", "select 'customer_copy' table_name, count(*) n, false has_reserved from customer")
def namespaces(spark, sf_dir) -> DataFrame:
    """A database is made and used, its table is found by name, and reserved catalogs are left out."""
    name, before = fresh_database(spark), spark.catalog.currentDatabase()
    S.create_database(spark, name, use=True)
    try:
        S.overwrite(table(spark, sf_dir, "customer").select("c_custkey"), "customer_copy")
        found = [t.name for t in spark.catalog.listTables(name)]
    finally:
        spark.catalog.setCurrentDatabase(before)
    reserved = "spark_catalog" in S.list_catalogs(spark, without=["spark_catalog"])
    return spark.table(f"{name}.{found[0]}").agg(F.lit(found[0]).alias("table_name"), F.count(F.lit(1)).alias("n"), F.lit(reserved).alias("has_reserved"))


# --- splits and samples -------------------------------------------------------

@query("split_90_10", f"""
select o_orderkey, case when {sql_bucket('o_orderkey')} < 90 then 'bronze' else 'update' end part from orders""")
def split_90_10(spark, sf_dir) -> DataFrame:
    marker = split_marker(["o_orderkey"], {"bronze": 90, "update": 10})
    return table(spark, sf_dir, "orders").select("o_orderkey", marker.alias("part"))


@query("split_baseline", f"""
select event_id, case when {sql_bucket('event_id')} < 25 then 'baseline' else 'log' end part from events""")
def split_baseline(spark, sf_dir) -> DataFrame:
    marker = split_marker(["event_id"], {"baseline": 25, "log": 75})
    return table(spark, sf_dir, "events").select("event_id", marker.alias("part"))


@query("split_60_20_20", f"""
select case when {sql_bucket('event_id')} < 60 then 'train' when {sql_bucket('event_id')} < 80 then 'val'
       else 'test' end split, count(*) n, min(event_id) first_id, max(event_id) last_id
from events group by 1""")
def split_60_20_20(spark, sf_dir) -> DataFrame:
    marker = split_marker(["event_id"], TRAIN_VAL_TEST)
    return table(spark, sf_dir, "events").groupBy(marker.alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query("sample_n", """
select doc_id, n_chars from documents order by md5('20260101|' || doc_id::varchar), doc_id limit 100""")
def sample_documents(spark, sf_dir) -> DataFrame:
    """SP4 with the fixed seed."""
    return sample_n(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), ["doc_id"], 100, 20260101)


# --- scalar functions ---------------------------------------------------------

@query("sf_clean_text", """
select p_partkey, lower(regexp_replace(p_name || ' (' || p_brand || '-' || p_type || ')', '[() -]', '_', 'g')) cleaned
from part""")
def sf_clean_text(spark, sf_dir) -> DataFrame:
    raw = F.concat("p_name", F.lit(" ("), "p_brand", F.lit("-"), "p_type", F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", X.clean_text(raw).alias("cleaned"))


@query("sf_identifier", r"select c_custkey, regexp_replace(c_name || '--José x', '[^\w\p{L}]+', '_', 'g') slug from customer")
def sf_identifier(spark, sf_dir) -> DataFrame:
    raw = F.concat("c_name", F.lit("--José x"))
    return table(spark, sf_dir, "customer").select("c_custkey", X.identifier(raw).alias("slug"))


USERS = """case when c_acctbal < 0 then '@' || c_name when c_nationkey < 10 then c_name
                else c_name || '@' || c_mktsegment || '@x.io' end"""


@query("sf_cut_domain", rf"""
select c_custkey, regexp_replace({USERS}, '^(.+)@[^@]*$', '\1') user_name from customer""")
def sf_cut_domain(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", X.cut_domain(F.expr(USERS)).alias("user_name"))


@query("sf_three_level", "select c_custkey, 'prod.' || c_mktsegment || '.' || c_name full_name from customer")
def sf_three_level(spark, sf_dir) -> DataFrame:
    name = X.three_level(F.lit("prod"), "c_mktsegment", "c_name")
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("full_name"))


@query("sf_run_name", "select event_id, 'automl_' || strftime(ts, '%Y-%m-%d_%H:%M:%S') run_name from events")
def sf_run_name(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", X.run_name("automl_", "ts").alias("run_name"))


@query("sf_split_list", """
select o_orderkey, len(string_split(s, ',')) n_parts, string_split(s, ',')[1] head, string_split(s, ',')[2] tail
from (select o_orderkey, case when o_orderstatus = 'P' then o_orderpriority
                              else o_orderpriority || ',' || o_orderstatus end s from orders)""")
def sf_split_list(spark, sf_dir) -> DataFrame:
    raw = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.concat_ws(",", "o_orderpriority", "o_orderstatus"))
    parts = X.split_list(raw)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.size(parts).cast("bigint").alias("n_parts"),
        F.get(parts, F.lit(0)).alias("head"), F.get(parts, F.lit(1)).alias("tail"),
    )


@query("sf_strip_prefix", """
select o_orderkey, case when o_orderstatus = 'F' then 'val_' || o_orderpriority
                        else o_orderstatus || '_val_' || o_orderpriority end metric,
       case when o_orderstatus = 'F' then o_orderpriority
            else o_orderstatus || '_val_' || o_orderpriority end stripped from orders""")
def sf_strip_prefix(spark, sf_dir) -> DataFrame:
    raw = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("val_"), "o_orderpriority")).otherwise(
        F.concat("o_orderstatus", F.lit("_val_"), "o_orderpriority"))
    named = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("metric"))
    return named.withColumn("stripped", X.strip_prefix("metric", "val_"))


@query("sf_try_numeric", """
select o_orderkey, try_cast(o_orderpriority as double) whole, try_cast(substr(o_orderpriority, 1, 1) as double) head
from orders""")
def sf_try_numeric(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", X.try_numeric("o_orderpriority").alias("whole"),
        X.try_numeric(F.substring("o_orderpriority", 1, 1)).alias("head"),
    )


@query("sf_tag_lookup", """
select o_orderkey, o_orderpriority source, case when o_orderstatus = 'F' then 'gender' else 'none' end demographic
from orders""")
def sf_tag_lookup(spark, sf_dir) -> DataFrame:
    tags = F.when(
        F.col("o_orderstatus") == "F",
        F.create_map(F.lit("source"), F.col("o_orderpriority"), F.lit("demographic_vars"), F.lit("gender")),
    ).otherwise(F.create_map(F.lit("source"), F.col("o_orderpriority")))
    return table(spark, sf_dir, "orders").select("o_orderkey", tags.alias("tags")).select(
        "o_orderkey", X.tag_lookup("tags", "source").alias("source"),
        X.tag_lookup("tags", "demographic_vars").alias("demographic"),
    )
