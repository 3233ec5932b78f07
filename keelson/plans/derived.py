"""Frames derived from the given tables, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators.drift import SIDE
from keelson.operators.score import as_label, logistic
from keelson.operators.splits import TRAIN_VAL_TEST, with_split
from keelson.plans.registry import flag, sql_bucket, table

# --- fixed values: domains of the given tables, in sorted order ---
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]

CHURN_DAYS = 180


# --- customers with an order history and a churn label ---

def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer. The label is unknown for a negative balance."""
    orders = table(spark, sf_dir, "orders")
    history = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.max("o_totalprice").alias("top_price"),
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("last"),
    )
    newest = orders.agg(F.max("o_orderdate")).scalar()
    joined = table(spark, sf_dir, "customer").join(history, F.col("c_custkey") == F.col("o_custkey"), "left")
    idle = F.coalesce(F.col("last.o_orderdate") < newest - F.expr(f"INTERVAL {CHURN_DAYS} DAYS"), F.lit(True))
    return joined.select(
        "c_custkey", "c_mktsegment", "c_acctbal",
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.coalesce("top_price", F.lit(0.0)).alias("top_price"),
        F.col("last.o_orderpriority").alias("last_priority"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).when(idle, F.lit("Yes")).otherwise(F.lit("No")).alias("churn"),
    )


CUSTOMERS = f"""
history as (
  select o_custkey, count(*) n_orders, max(o_totalprice) top_price, max(o_orderdate) last_date,
         (max(struct_pack(d := o_orderdate, k := o_orderkey, p := o_orderpriority))).p last_priority
  from orders group by 1),
customers as (
  select c_custkey, c_mktsegment, c_acctbal, coalesce(n_orders, 0) n_orders, coalesce(top_price, 0.0) top_price,
         last_priority,
         case when c_acctbal < 0 then null
              when last_date is null
                or last_date < (select max(o_orderdate) from orders) - interval {CHURN_DAYS} day then 'Yes'
              else 'No' end churn
  from customer left join history on c_custkey = o_custkey)
"""


def split_sql(key: str) -> str:
    return f"case when {sql_bucket(key)} < 60 then 'train' when {sql_bucket(key)} < 80 then 'val' else 'test' end"


# --- line items scored by a fixed logistic model ---
LINE_WEIGHTS = {"l_quantity": 0.04, "l_discount": -8.0, "l_tax": 3.0}
LINE_INTERCEPT = -1.0


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    marked = with_split(lines, ["l_orderkey"], TRAIN_VAL_TEST)
    return marked.withColumn("score", F.round(logistic(LINE_WEIGHTS, LINE_INTERCEPT), 6)).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "split", "score",
        flag(F.col("l_returnflag") == "R").alias("label"),
        as_label(F.col("score")).alias("prediction"),
    )


LINE_Z = "(((-1.0 + 0.04 * l_quantity) + (-8.0) * l_discount) + 3.0 * l_tax)"
LINES = f"""
raw as (
  select *, {split_sql('l_orderkey')} split, round(1.0 / (1.0 + exp(-{LINE_Z})), 6) score from lineitem),
lines as (
  select l_orderkey, l_linenumber, l_returnflag, l_linestatus, split, score,
         case when l_returnflag = 'R' then 1 else 0 end as label,
         case when score > 0.5 then 1 else 0 end prediction
  from raw)
"""


# --- events as an inference log ---
SLICES = {"clicks": "event_type = 'click'", "high_value": "value > 50"}
HALF = "TIMESTAMP_NTZ '2024-01-16 00:00:00'"


def inference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors carry no value; two models share the day."""
    events = table(spark, sf_dir, "events")
    return prepare_log(events)


def prepare_log(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        flag(F.col("value") > 20).alias("prediction"),
        F.round(F.lit(1.0) - F.exp(-F.col("value") / F.lit(50.0)), 6).alias("score"),
        flag(F.col("event_type").isin("purchase", "view")).alias("label"),
        F.when(F.hour("ts") < 12, F.lit("1")).otherwise(F.lit("2")).alias("version"),
    )


LOG = """
log as (
  select event_id, ts, user_id, event_type, case when event_type <> 'error' then value end as value,
         case when value > 20 then 1 else 0 end prediction,
         round(1.0 - exp(-value / 50.0), 6) score,
         case when event_type in ('purchase', 'view') then 1 else 0 end as label,
         case when extract(hour from ts) < 12 then '1' else '2' end as version
  from events)
"""
SLICED = """
sliced as (
  select *, 'all' slice from log
  union all select *, 'clicks' from log where event_type = 'click'
  union all select *, 'high_value' from log where value > 50)
"""


def drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First half of the month as baseline; values of the second half are scaled by 1.5."""
    log = inference_log(spark, sf_dir)
    base = F.col("ts") < F.expr(HALF)
    return log.withColumns({
        SIDE: base, "value": F.when(base, F.col("value")).otherwise(F.col("value") * F.lit(1.5)),
    })


DRIFTED = LOG + """,
tagged as (
  select * exclude (value), ts < timestamp '2024-01-16' is_baseline,
         case when ts < timestamp '2024-01-16' then value else value * 1.5 end as value
  from log)
"""


# --- model metadata out of orders and line items ---
RUN_STATUS = {"F": "FINISHED", "O": "RUNNING", "P": "FAILED"}


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a run, its customer the experiment; metrics come from its lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.round(F.lit(1.0) - F.avg("l_discount"), 6).alias("val_f1_score"),
        F.round(F.lit(1.0) - F.avg("l_tax"), 6).alias("test_f1_score"),
    )
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = F.when(F.col("o_orderstatus") == "F", "FINISHED").when(
        F.col("o_orderstatus") == "O", "RUNNING").otherwise("FAILED")
    measured = F.col("val_f1_score").isNotNull()
    names = F.array(F.lit("val_f1_score"), F.lit("test_f1_score"))
    return joined.select(
        F.concat(F.lit("run-"), "o_orderkey").alias("run_id"),
        F.concat(F.lit("exp-"), "o_custkey").alias("experiment_id"),
        status.alias("status"),
        F.when(measured, F.map_from_arrays(names, F.array("val_f1_score", "test_f1_score"))).otherwise(
            F.map_from_arrays(names, F.array(F.lit(None).cast("double"), F.lit(None).cast("double")))
        ).alias("metrics"),
        F.create_map(F.lit("max_depth"), F.substring("o_orderpriority", 1, 1)).alias("params"),
        F.create_map(F.lit("source"), F.col("o_orderpriority"), F.lit("owner"), F.col("o_custkey").cast("string"))
        .alias("tags"),
    )


RUNS = """
line_metrics as (
  select l_orderkey, round(1.0 - avg(l_discount), 6) val_f1_score, round(1.0 - avg(l_tax), 6) test_f1_score
  from lineitem group by 1),
runs as (
  select 'run-' || o_orderkey run_id, 'exp-' || o_custkey experiment_id,
         case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'RUNNING' else 'FAILED' end as status,
         val_f1_score, test_f1_score, substr(o_orderpriority, 1, 1) max_depth,
         o_orderpriority source, o_custkey::varchar owner
  from orders left join line_metrics on o_orderkey = l_orderkey)
"""


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer is a model, an order one of its versions; the inputs come from its lines."""
    inputs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set(F.struct(
            F.concat(F.lit("line_"), "l_linenumber").alias("name"), F.lit("double").alias("type")
        ))).alias("signature")
    )
    orders = table(spark, sf_dir, "orders").join(inputs, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return orders.select(
        F.concat(F.lit("model-"), "o_custkey").alias("name"),
        (F.col("o_orderkey") + 1).cast("int").alias("version"),
        F.concat(F.lit("run-"), "o_orderkey").alias("run_id"),
        F.concat(F.lit("runs:/run-"), "o_orderkey", F.lit("/model")).alias("source"),
        F.when(F.col("o_orderstatus") != "P", F.concat("o_orderpriority", F.lit(" trained "), F.to_date("o_orderdate")))
        .alias("description"),
        "signature",
        F.col("o_orderstatus").alias("stage"),
    )


VERSIONS = """
inputs as (select l_orderkey, count(distinct l_linenumber) n_inputs from lineitem group by 1),
versions as (
  select 'model-' || o_custkey as name, (o_orderkey + 1)::int as version, 'run-' || o_orderkey run_id,
         'runs:/run-' || o_orderkey || '/model' source,
         case when o_orderstatus <> 'P' then o_orderpriority || ' trained ' || o_orderdate::date end description,
         coalesce(n_inputs, 0) n_inputs, o_orderstatus stage
  from orders left join inputs on o_orderkey = l_orderkey)
"""


def model_aliases(versions: DataFrame) -> DataFrame:
    """The newest open version is the challenger, the newest closed one the champion."""
    kind = F.when(F.col("stage") == "O", "Challenger").when(F.col("stage") == "F", "Champion")
    named = versions.select("name", kind.alias("alias"), "version").filter(F.col("alias").isNotNull())
    return named.groupBy("name", "alias").agg(F.max("version").alias("version"))


ALIASES = """
aliases as (
  select name, case stage when 'O' then 'Challenger' else 'Champion' end alias, max(version) as version
  from versions where stage in ('O', 'F') group by 1, 2)
"""


# --- labelled documents for training ---
DOCUMENT_FEATURES = ["n_chars", "n_words", "digit_share", "upper_share"]


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts reduced to counts by built-in functions; label is the quality flag."""
    text, chars = F.col("text"), F.greatest(F.length("text"), F.lit(1)).cast("double")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(text, r"\s+")).cast("double").alias("n_words"),
        (F.length(F.regexp_replace(text, r"[^0-9]", "")) / chars).alias("digit_share"),
        (F.length(F.regexp_replace(text, r"[^A-Z]", "")) / chars).alias("upper_share"),
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return with_split(documents.join(labels, "doc_id"), ["doc_id"])


