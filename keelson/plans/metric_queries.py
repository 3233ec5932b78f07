"""Registered queries: evaluation, scoring, explanation and training."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.functions.text import agrees
from keelson.operators import boosting as B
from keelson.operators import explain as E
from keelson.operators import metrics as M
from keelson.operators import search as S
from keelson.operators import train as L
from keelson.operators.gates import slice_gate as gate
from keelson.operators.score import as_label, batch_score as score_batch, logistic, model_udf
from keelson.operators.splits import with_split
from keelson.plans.derived import (
    CUSTOMERS,
    DOCUMENT_FEATURES,
    LINE_INTERCEPT,
    LINE_WEIGHTS,
    LINE_Z,
    LINES,
    LOG,
    customers,
    inference_log,
    labelled_documents,
    scored_lines,
    split_sql,
)
from keelson.plans.registry import flag, query, rounded, sql_bucket, table
from keelson.session import staged

SCORED_AT = "TIMESTAMP_NTZ '2024-02-01 00:00:00'"


# --- the flagship: accuracy per slice on held-out customers --------------------

@query("heldout_slice_accuracy", f"""
with {CUSTOMERS},
held as (select c_mktsegment, case churn when 'Yes' then 1 else 0 end as label,
                case when 1.0 / (1.0 + exp(-(2.0 + (-0.2) * n_orders))) > 0.5 then 1 else 0 end prediction
         from customers where {split_sql('c_custkey')} = 'test' and churn is not null)
select c_mktsegment, sum(case when label = prediction then 1 else 0 end)::bigint acc, count(*) obs,
       round(sum(case when label = prediction then 1 else 0 end)::double / count(*), 6) pct_acc
from held group by 1""")
def heldout_slice_accuracy(spark, sf_dir) -> DataFrame:
    rows = with_split(customers(spark, sf_dir), ["c_custkey"]).filter("split = 'test' and churn is not null")
    scored = rows.select(
        "c_mktsegment", flag(F.col("churn") == "Yes").alias("label"),
        as_label(logistic({"n_orders": -0.2}, 2.0)).alias("prediction"),
    )
    return rounded(M.slice_accuracy(scored, ["c_mktsegment"]), "pct_acc")


@query("slice_accuracy", f"""
with {LOG}
select event_type, version, sum(case when prediction = label then 1 else 0 end)::bigint acc, count(*) obs,
       round(sum(case when prediction = label then 1 else 0 end)::double / count(*), 6) pct_acc
from log group by 1, 2""")
def slice_accuracy(spark, sf_dir) -> DataFrame:
    return rounded(M.slice_accuracy(inference_log(spark, sf_dir), ["event_type", "version"]), "pct_acc")


@query("slice_accuracy_cube", f"""
with {LOG}
select event_type, version, sum(case when prediction = label then 1 else 0 end)::bigint acc, count(*) obs,
       round(sum(case when prediction = label then 1 else 0 end)::double / count(*), 6) pct_acc
from log group by cube (event_type, version)""")
def slice_accuracy_cube(spark, sf_dir) -> DataFrame:
    log = inference_log(spark, sf_dir)
    return rounded(M.slice_accuracy(log, ["event_type", "version"], cube=True), "pct_acc")


@query("slice_gate", f"""
with {LOG}, s as (select event_type, version, avg(case when prediction = label then 1.0 else 0.0 end) a
                  from log group by 1, 2)
select version, count(*) slices, round(min(a), 6) min_accuracy,
       case when min(a) > 0.55 then 'pass' else 'fail' end demo_test,
       case when max(a) <> 0 then 'pass' else 'fail' end literal_test
from s group by 1""")
def slice_gate(spark, sf_dir) -> DataFrame:
    slices = M.slice_accuracy(inference_log(spark, sf_dir), ["event_type", "version"])
    literal = gate(slices, ["version"], mode="literal").select("version", F.col("demo_test").alias("literal_test"))
    return rounded(gate(slices, ["version"]).join(literal, "version"), "min_accuracy")


@query("confusion_matrix", f"""
with {LOG}, grid as (select * from (values (0, 0), (0, 1), (1, 0), (1, 1)) t(a, p)),
c as (select label a, prediction p, count(*) n from log group by 1, 2)
select a::int as label, p::int prediction, coalesce(n, 0)::bigint n from grid left join c using (a, p)""")
def confusion_matrix(spark, sf_dir) -> DataFrame:
    return M.confusion_matrix(inference_log(spark, sf_dir))


def _areas_sql(by: str) -> str:
    """Curve areas per group from window sums over distinct scores."""
    return f"""
scores as (select {by}, score, count(*) filter (where label = 1) pos, count(*) filter (where label = 0) neg
           from lines group by 1, 2),
ranked as (select {by}, pos, neg,
             sum(pos) over w::double tp, sum(neg) over w::double fp,
             sum(pos) over (partition by {by})::double np, sum(neg) over (partition by {by})::double nn
           from scores window w as (partition by {by} order by score desc)),
areas as (select {by}, sum(neg * (tp - pos + pos / 2.0)) / (max(np) * max(nn)) roc_auc,
                 sum(pos * tp / (tp + fp)) / max(np) average_precision
          from ranked group by 1)"""


CLASSIFIER = f"""
with {LINES}, {_areas_sql('split')},
m as (select split, count(*) example_count,
        count(*) filter (where prediction = 1 and label = 1) tp, count(*) filter (where prediction = 1 and label = 0) fp,
        count(*) filter (where prediction = 0 and label = 1) fn, count(*) filter (where prediction = 0 and label = 0) tn,
        avg(case when label = 1 then -ln(score) else -ln(1 - score) end) log_loss
      from lines group by 1)
select m.split, example_count, tp, fp, fn, tn, round(log_loss, 6) log_loss,
       round((tp + tn)::double / example_count, 6) accuracy,
       round(coalesce(tp::double / nullif(tp + fp, 0), 0), 6) "precision",
       round(coalesce(tp::double / nullif(tp + fn, 0), 0), 6) recall,
       round(coalesce(2.0 * tp::double / nullif(2 * tp + fp + fn, 0), 0), 6) f1,
       round(roc_auc, 6) roc_auc, round(average_precision, 6) average_precision
from m join areas using (split)"""
RATES = ["log_loss", "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]


@query("classifier_metrics", CLASSIFIER)
def classifier_metrics(spark, sf_dir) -> DataFrame:
    return rounded(M.classifier_metrics(scored_lines(spark, sf_dir)), *RATES)


@query("metric_compare", f"""
with c as ({CLASSIFIER})
select metric, max(case when split = 'val' then v end) val, max(case when split = 'test' then v end) test
from (select split, 'f1' metric, f1 v from c union all select split, 'accuracy', accuracy from c
      union all select split, 'log_loss', log_loss from c) group by 1""")
def metric_compare(spark, sf_dir) -> DataFrame:
    metrics = rounded(M.classifier_metrics(scored_lines(spark, sf_dir), areas=False), "f1", "accuracy", "log_loss")
    return M.metric_compare(metrics, "val", "test", ["f1", "accuracy", "log_loss"])


def _curve_sql(columns: str) -> str:
    return f"""
with {LINES},
scores as (select score threshold, count(*) filter (where label = 1) pos, count(*) filter (where label = 0) neg
           from lines group by 1),
ranked as (select threshold, sum(pos) over w::bigint tp, sum(neg) over w::bigint fp,
                  sum(pos) over ()::double np, sum(neg) over ()::double nn
           from scores window w as (order by threshold desc))
select threshold, tp, fp, {columns} from ranked"""


@query("roc_curve", _curve_sql("round(tp / np, 6) tpr, round(fp / nn, 6) fpr"))
def roc_curve(spark, sf_dir) -> DataFrame:
    return rounded(M.roc_curve(scored_lines(spark, sf_dir)), "tpr", "fpr")


@query("pr_curve", _curve_sql('round(tp::double / (tp + fp), 6) "precision", round(tp / np, 6) recall'))
def pr_curve(spark, sf_dir) -> DataFrame:
    return rounded(M.pr_curve(scored_lines(spark, sf_dir)), "precision", "recall")


@query("roc_auc", f"""
with {LINES}, {_areas_sql('l_linestatus')}
select l_linestatus, round(roc_auc, 6) roc_auc, round(average_precision, 6) average_precision from areas""")
def roc_auc(spark, sf_dir) -> DataFrame:
    areas = M.curve_areas(scored_lines(spark, sf_dir), by=["l_linestatus"]).drop("n_pos", "n_neg")
    return rounded(areas, "roc_auc", "average_precision")


# --- scoring ------------------------------------------------------------------

SCORED = f"""
select l_orderkey, l_linenumber, l_partkey, case when 1.0 / (1.0 + exp(-{LINE_Z})) > 0.5 then 1 else 0 end prediction,
       timestamp '2024-02-01' prediction_time, 'prod.churn' model_name, 'Champion' model_alias, '3' model_version
from lineitem"""
INPUTS = list(LINE_WEIGHTS)


def _score_lines(lines: DataFrame, predict) -> DataFrame:
    scored = score_batch(lines, INPUTS, predict, "prod.churn", "Champion", "3", at=F.expr(SCORED_AT))
    return scored.select(
        "l_orderkey", "l_linenumber", "l_partkey", "prediction", "prediction_time",
        "model_name", "model_alias", "model_version",
    )


@query("batch_score", SCORED)
def batch_score(spark, sf_dir) -> DataFrame:
    return _score_lines(table(spark, sf_dir, "lineitem"), as_label(logistic(LINE_WEIGHTS, LINE_INTERCEPT)))


@query("scoring_time", "select l_orderkey, l_linenumber, true recent, '3' model_version from lineitem")
def scoring_time(spark, sf_dir) -> DataFrame:
    """Without a stated time, rows carry that of the run."""
    lines = table(spark, sf_dir, "lineitem")
    scored = score_batch(lines, INPUTS, as_label(logistic(LINE_WEIGHTS, LINE_INTERCEPT)), "prod.churn", "Champion", "3")
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("prediction_time")
    return scored.select("l_orderkey", "l_linenumber", age.between(0, 600).alias("recent"), "model_version")


def _load_linear():
    weights, intercept = np.array(list(LINE_WEIGHTS.values())), LINE_INTERCEPT

    def predict(matrix: np.ndarray) -> np.ndarray:
        z = np.full(len(matrix), intercept)
        for j, w in enumerate(weights):
            z = z + w * matrix[:, j]
        return (1.0 / (1.0 + np.exp(-z)) > 0.5).astype("int32")

    return predict


@query("udf_score", SCORED)
def udf_score(spark, sf_dir) -> DataFrame:
    """The same model as an opaque vectorised UDF."""
    return _score_lines(table(spark, sf_dir, "lineitem"), model_udf(_load_linear, "int"))


# --- explanation --------------------------------------------------------------

SHAP_WEIGHTS = {"n_orders": -0.2, "c_acctbal": 0.001, "top_price": 0.00001}


def _linear() -> F.Column:
    z = F.lit(2.0)
    for name, w in SHAP_WEIGHTS.items():
        z = z + F.lit(w) * F.col(name)
    return z


@query("shapley_importance", f"""
with {CUSTOMERS},
parts as (select *, {split_sql('c_custkey')} split from customers),
bg as (select * from parts where split = 'train' order by md5('7-background|' || c_custkey::varchar), c_custkey limit 100),
ex as (select * from parts where split = 'val' order by md5('7-example|' || c_custkey::varchar), c_custkey limit 100),
m as (select avg(n_orders) n, avg(c_acctbal) a, avg(top_price) t from bg)
select 'n_orders' feature, round(avg(abs(-0.2 * (n_orders - n))), 6) importance from ex, m
union all select 'c_acctbal', round(avg(abs(0.001 * (c_acctbal - a))), 6) from ex, m
union all select 'top_price', round(avg(abs(0.00001 * (top_price - t))), 6) from ex, m""")
def shapley_importance(spark, sf_dir) -> DataFrame:
    """For a linear scorer the attribution is w * (x - mean of x over the background)."""
    rows = with_split(customers(spark, sf_dir), ["c_custkey"])
    values = E.shapley_importance(
        rows.filter("split = 'val'"), rows.filter("split = 'train'"), list(SHAP_WEIGHTS), ["c_custkey"], _linear()
    )
    return rounded(values, "importance")


@query("kernel_attribution", f"""
with {CUSTOMERS},
parts as (select *, {split_sql('c_custkey')} split from customers),
bg as (select * from parts where split = 'train' order by md5('7-background|' || c_custkey::varchar), c_custkey limit 37),
ex as (select * from parts where split = 'val' order by md5('7-example|' || c_custkey::varchar), c_custkey limit 37),
m as (select avg(n_orders) n, avg(c_acctbal) a, avg(top_price) t, avg(c_acctbal * n_orders) an from bg)
select c_custkey, unnest(['n_orders', 'c_acctbal', 'top_price']) feature,
       unnest([round(-0.2113 * (n_orders - n) + 0.0005135 * (c_acctbal * n_orders - c_acctbal * n + a * n_orders - an), 6),
               round(0.0005135 * (c_acctbal * n_orders - a * n_orders + c_acctbal * n - an), 6),
               round(0.0000133 * (top_price - t), 6)]) attribution from ex, m""")
def kernel_attribution(spark, sf_dir) -> DataFrame:
    """A scorer with an interaction: balance times number of orders is shared between the two by the Shapley value."""
    rows = with_split(customers(spark, sf_dir), ["c_custkey"])
    scorer = F.lit(2.0) - F.lit(0.2113) * F.col("n_orders") + F.lit(0.001027) * F.col("c_acctbal") * F.col("n_orders") + F.lit(0.0000133) * F.col("top_price")
    values = E.kernel_values(
        rows.filter("split = 'val'"), rows.filter("split = 'train'"), ["n_orders", "c_acctbal", "top_price"], ["c_custkey"], scorer, n=37)
    return rounded(values, "attribution")


PERM_Z = "(((-2.0 + 0.9 * price) + 0.2 * urgency))"


def _moved(column: str, shift: int) -> str:
    ring = "partition by blk order by md5('7|' || o_orderkey::varchar), o_orderkey"
    whole = f"{ring} rows between unbounded preceding and unbounded following"
    ends = " ".join(f"when {back} then nth_value({column}, {shift - back}) over ({whole})" for back in range(shift))
    return f"""
case count(*) over (partition by blk) - row_number() over ({ring}) {ends}
     else lead({column}, {shift}) over ({ring}) end moved_{column}"""


@query("permutation_importance", f"""
with o as (select o_orderkey, o_totalprice / 100000.0 as price, substr(o_orderpriority, 1, 1)::double urgency,
                  case when o_orderstatus = 'F' then 1 else 0 end as label,
                  {sql_bucket('o_orderkey', salt='7-block', buckets=200)} blk from orders),
mv as (select *, {_moved('price', 1)}, {_moved('urgency', 2)} from o),
acc as (select avg(case when (1.0 / (1.0 + exp(-((-2.0 + 0.9 * price) + 0.2 * urgency))) > 0.5)::int = label
                        then 1.0 else 0.0 end) a0,
               avg(case when (1.0 / (1.0 + exp(-((-2.0 + 0.9 * moved_price) + 0.2 * urgency))) > 0.5)::int = label
                        then 1.0 else 0.0 end) a1,
               avg(case when (1.0 / (1.0 + exp(-((-2.0 + 0.9 * price) + 0.2 * moved_urgency))) > 0.5)::int = label
                        then 1.0 else 0.0 end) a2 from mv)
select 'price' feature, round(a0, 6) accuracy, round(a1, 6) shuffled_accuracy, round(a0 - a1, 6) importance from acc
union all select 'urgency', round(a0, 6), round(a2, 6), round(a0 - a2, 6) from acc""")
def permutation_importance(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / F.lit(100000.0)).alias("price"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("urgency"),
        flag(F.col("o_orderstatus") == "F").alias("label"),
    )
    out = E.permutation_importance(
        orders, ["price", "urgency"], ["o_orderkey"], "label", logistic({"price": 0.9, "urgency": 0.2}, -2.0)
    )
    return rounded(out, "accuracy", "shuffled_accuracy", "importance")


# --- training: what is certain whatever the fitted numbers are -------------------

LABELLED = f"""
labelled as (select doc_id, quality as label, {split_sql('doc_id')} split from documents join labels using (doc_id))"""


@query("train_gbt", f"""
with {LABELLED}
select split, count(*) n, 1 counted, 1 beats_majority from labelled group by 1""")
def train_gbt(spark, sf_dir) -> DataFrame:
    """Boosted trees with early stopping on labelled documents: every row scored, and on the
    train part at least as many right as the commoner label would get."""
    rows = staged(labelled_documents(spark, sf_dir), "documents")
    scored = L.score(L.fit(rows, DOCUMENT_FEATURES, "label", "gbt", {"rounds": 10}), rows)
    right, ones = F.sum(agrees("prediction", "label")), F.sum("label")
    majority = F.greatest(ones, F.count(F.lit(1)) - ones)
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), flag(F.count_if(F.col("score").between(0, 1)) == F.count(F.lit(1))).alias("counted"),
        flag((F.col("split") != "train") | (right >= majority)).alias("beats_majority"))


@query("trial_metrics", f"""
with {LABELLED}
select split, count(*) example_count, sum(label)::bigint positives, 1 adds_up from labelled group by 1""")
def trial_metrics(spark, sf_dir) -> DataFrame:
    """The confusion cells of each part add up to its rows and its positives."""
    rows = staged(labelled_documents(spark, sf_dir), "documents")
    found = L.trial_metrics(L.fit(rows, DOCUMENT_FEATURES, "label", "logistic"), rows, "label")
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return found.select("split", "example_count", (F.col("tp") + F.col("fn")).alias("positives"),
                        flag(total == F.col("example_count")).alias("adds_up"))


def _trials(trials: DataFrame) -> DataFrame:
    """Status, whether the loss is the negative validation F1, and which trial is the best."""
    f1 = F.col("metrics")["val_f1"]
    ranked = trials.withColumn("best", F.min("loss").over(W.partitionBy(F.lit(0))))  # a row per trial
    return ranked.select("trial_id", "family", "status", flag(F.coalesce(F.col("loss") == -f1, F.col("loss").isNull())).alias("loss_is_f1"),
                         flag(F.count_if(F.col("loss") == F.col("best")).over(W.partitionBy(F.lit(0))) >= 1).alias("has_best"))


@query("hyper_search", f"""
with {LABELLED}, trials(trial_id, status) as (values ('trial-0000', 'FINISHED'), ('trial-0001', 'FINISHED'))
select trial_id, 'gbt' family, status, 1 loss_is_f1, 1 has_best from trials where exists (select 1 from labelled)""")
def hyper_search(spark, sf_dir) -> DataFrame:
    space = {"max_depth": [2, 3], "rounds": [4, 6], "learning_rate": [0.1, 0.3]}
    return _trials(L.hyper_search(labelled_documents(spark, sf_dir), DOCUMENT_FEATURES, "label", space, n=2))


# --- second-order boosting, tree by tree ----------------------------------------

BOOST_EDGES = {"l_quantity": [5, 10, 15, 20, 25, 30, 35, 40, 45], "l_discount": [0.015, 0.035, 0.055, 0.075], "l_tax": [0.015, 0.035, 0.055]}
BOOST_LABEL = "case when (0.04 * l_quantity - 8.0 * l_discount + 3.0 * l_tax > 0.75) <> (l_orderkey % 7 = 0) then 1 else 0 end"


def _boost_sql(rounds: int) -> str:
    """The trees of depth two as one statement: a chain of histograms, best splits and leaves per round."""
    def cut(column: str) -> str:
        return " + ".join(f"({column} > {e})::int" for e in BOOST_EDGES[column])

    def level(rows: str, out: str) -> str:
        return f"""
{out}_s as (select node, f, bin, sum(g) g, sum(h) h from (
     select node, g, h, unnest([0, 1, 2]) f, unnest([b0, b1, b2]) bin from {rows}) group by all),
{out}_c as (select node, f, bin, sum(g) over o gl, sum(h) over o hl, sum(g) over w ga, sum(h) over w ha from {out}_s
     window o as (partition by node, f order by bin), w as (partition by node, f)),
{out}_g as (select node, f, bin, hl, ha - hl hr, round((gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)) / 2, 9) gain from {out}_c),
{out} as (select node, f, bin, gain from {out}_g where hl >= 5 and hr >= 5 and gain > 0
     qualify row_number() over (partition by node order by gain desc, f, bin) = 1)"""

    def move(rows: str, splits: str, out: str) -> str:
        return f"""
{out} as (select * replace (case when s.node is null then r.node
     when (case s.f when 0 then b0 when 1 then b1 else b2 end) <= s.bin then 2 * r.node else 2 * r.node + 1 end as node)
     from {rows} r left join {splits} s on s.node = r.node)""".replace("select *", "select r.*")

    parts = [f"""
r0 as (select l_orderkey k, l_linenumber n, {cut('l_quantity')} b0, {cut('l_discount')} b1, {cut('l_tax')} b2, {BOOST_LABEL}::double y, 0.0::double m
       from lineitem)"""]
    for i in range(1, rounds + 1):
        parts += [f"""
g{i} as (select k, n, b0, b1, b2, y, m, 1 node, p - y g, p * (1 - p) h from (select *, 1 / (1 + exp(-m)) p from r{i - 1}))""",
                  level(f"g{i}", f"a{i}"), move(f"g{i}", f"a{i}", f"h{i}"), level(f"h{i}", f"c{i}"), move(f"h{i}", f"c{i}", f"i{i}"), f"""
l{i} as (select node, -sum(g) / (sum(h) + 1) * 1.5 w from i{i} group by 1)""", f"""
r{i} as (select k, n, b0, b1, b2, y, m + w m from i{i} join l{i} using (node))"""]
    rows = " union all ".join(f"""
select {i} round, node, f feature, bin, round(gain, 6) gain, null::double weight from a{i}
union all select {i}, node, f, bin, round(gain, 6), null from c{i} union all select {i}, node, null, null, null, round(w, 6) from l{i}"""
                              for i in range(1, rounds + 1))
    return f"with {','.join(parts)} {rows}"


@query("boosted_trees", _boost_sql(3))
def boosted_trees(spark, sf_dir) -> DataFrame:
    """All nodes of three trees of depth two, learning rate above one."""
    lines = table(spark, sf_dir, "lineitem").withColumn("label", F.expr(BOOST_LABEL))
    settings = B.Boosting(rounds=3, depth=2, learning_rate=1.5, min_child_weight=5.0)
    model = B.fit_boosted(lines, list(BOOST_EDGES), "label", settings, BOOST_EDGES)
    rows = [(i, n.node, n.feature, n.bin, n.gain, n.weight) for i, tree in enumerate(model.trees, 1) for n in tree]
    return rounded(spark.createDataFrame(rows, "round int, node int, feature int, bin int, gain double, weight double"), "gain", "weight")


# Finished orders as trials of a search: settings from their lines, the loss their mean discount.
SEARCH_SPACE = {"depth": [1, 2, 3, 4, 5], "lines": [1, 2, 3, 4, 5, 6, 7], "flag": ["A", "N", "R"]}


def _order_trials(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("string").alias("lines"), F.max("l_returnflag").alias("flag"), F.round(F.avg("l_discount"), 6).alias("loss"))
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    names = F.array(F.lit("depth"), F.lit("lines"), F.lit("flag"))
    return orders.select(
        F.concat(F.lit("run-"), "o_orderkey").alias("trial_id"), F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("FAILED").alias("status"),
        F.map_from_arrays(names, F.array(F.substring("o_orderpriority", 1, 1), "lines", "flag")).alias("params"), "loss")


def _space_rows() -> str:
    rows = []
    for name, values in SEARCH_SPACE.items():
        for i, v in enumerate(values):
            x = f"{float(v)}, 1.0" if isinstance(v, int) else "null, null"
            rows.append(f"('{name}', '{v}', {i}, {x})")
    return ", ".join(rows)


LAWS = f"""
t as (select 'run-' || o_orderkey trial_id, substr(any_value(o_orderpriority), 1, 1) depth, count(*)::varchar as lines,
             max(l_returnflag) flag, round(avg(l_discount), 6) loss
      from orders join lineitem on l_orderkey = o_orderkey where o_orderstatus = 'F' group by o_orderkey),
g as (select *, row_number() over (order by loss, trial_id) <= ceil(sqrt(count(*) over ())) good from t),
taken as (select good, 'depth' param, depth v from g union all select good, 'lines', lines from g union all select good, 'flag', flag from g),
space(param, value, place, x, width) as (values {_space_rows()}),
counted as (select s.*, count(*) filter (where good) n_good, count(*) filter (where not good) n_bad
            from space s left join taken on taken.param = s.param and v = s.value group by all),
laid as (select s.param, s.value, s.place, count(*) size, sum(k * n_good) g, sum(k * n_bad) b
         from (select s.*, o.n_good, o.n_bad, case when s.x is null then (s.value = o.value)::int::double
                      else exp(-power((s.x - o.x) / s.width, 2) / 2) end k
               from space s join counted o on o.param = s.param) s group by all),
laws as (select param, value, place, (g + 1.0 / size) / sum(g + 1.0 / size) over (partition by param) good,
                (b + 1.0 / size) / sum(b + 1.0 / size) over (partition by param) bad from laid)"""


@query("search_densities", f"""
with {LAWS} select param, value, round(good, 6) good, round(bad, 6) bad, round(ln(good / bad), 6) gain from laws""")
def search_densities(spark, sf_dir) -> DataFrame:
    """The two laws of every parameter from all finished trials."""
    laws = S.densities(_order_trials(spark, sf_dir), SEARCH_SPACE)
    return rounded(laws.select("param", "value", "good", "bad", "gain"), "good", "bad", "gain")


@query("search_proposals", f"""
with {LAWS},
steps as (select *, sum(good) over (partition by param order by place) high,
                 row_number() over (partition by param order by place desc) = 1 last from laws),
draws as (select p.i proposal, c.i candidate, param,
                 ('0x' || substr(md5('7|' || p.i || '|' || c.i || '|' || param), 1, 7))::bigint / 268435456.0 u
          from range(5) p(i), range(24) c(i), (select distinct param from laws)),
drawn as (select proposal, candidate, steps.* from draws join steps using (param)
          where u >= high - good and (last or u < high)),
settings as (select proposal, candidate, max(case when param = 'depth' then value end) depth, max(case when param = 'lines' then value end) as lines,
                    max(case when param = 'flag' then value end) flag, sum(ln(good / bad)) gain from drawn group by 1, 2)
select proposal, candidate::int candidate, depth, lines, flag, round(gain, 6) gain from settings
qualify row_number() over (partition by proposal order by round(gain, 9) desc, candidate) = 1""")
def search_proposals(spark, sf_dir) -> DataFrame:
    """Five settings for parallel fits, each the best of 24 draws."""
    found = S.propose(S.densities(_order_trials(spark, sf_dir), SEARCH_SPACE), 5)
    return rounded(found.select("proposal", "candidate", *[F.col("params")[c].alias(c) for c in ("depth", "lines", "flag")], "gain"), "gain")


@query("early_stopping", """
with r as (select o_custkey, o_totalprice loss, row_number() over (partition by o_custkey order by o_orderkey) n from orders),
i as (select *, loss < coalesce(min(loss) over (partition by o_custkey order by n rows between unbounded preceding and 1 preceding), 1e99) lower from r),
b as (select *, max(case when lower then n end) over (partition by o_custkey order by n) best from i),
s as (select o_custkey, coalesce(min(case when n - best >= 3 then n end), max(n)) stop_round, max(n) rounds from b group by 1)
select o_custkey, best best_round, (select loss from r where r.o_custkey = b.o_custkey and r.n = b.best) best_loss, stop_round, rounds
from s join b using (o_custkey) where b.n = stop_round""")
def early_stopping(spark, sf_dir) -> DataFrame:
    """A customer's orders as the losses of a fit: it stops after three rounds without gain."""
    losses = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("round"), F.col("o_totalprice").alias("loss"))
    return S.patience_stop(losses, ["o_custkey"], patience=3).withColumns({
        c: F.col(c).cast("bigint") for c in ("best_round", "stop_round", "rounds")})


@query("auto_classify", f"""
with {LABELLED}, families(family) as (values ('logistic'), ('tree'), ('forest'))
select 'trial-' || family trial_id, family, 'FINISHED' status, 1 loss_is_f1, 1 has_best from families
where exists (select 1 from labelled)""")
def auto_classify(spark, sf_dir) -> DataFrame:
    return _trials(L.auto_classify(labelled_documents(spark, sf_dir), DOCUMENT_FEATURES, "label", exclude=["gbt"]))


@query("pipeline_features", f"""
with o as (select o_orderkey, case when o_orderkey % 10 <> 0 then o_totalprice end price, o_orderpriority prio,
                  {split_sql('o_orderkey')} split from orders),
t as (select coalesce(price, (select avg(price) from o where split = 'train')) filled from o where split = 'train'),
s as (select avg(filled) m, stddev_pop(filled) d from t)
select o_orderkey, round((coalesce(price, m) - m) / d, 6) price, (prio = '2-HIGH')::int::double p2, (prio = '3-MEDIUM')::int::double p3,
       (prio = '4-NOT SPECIFIED')::int::double p4, (prio = '5-LOW')::int::double p5, (o_orderkey % 7)::double rest
from o, s where split = 'val'""")
def pipeline_features(spark, sf_dir) -> DataFrame:
    """The cells of a model's vector on the val part: statistics and vocabulary come from the train part."""
    orders = with_split(table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderpriority").alias("prio"), (F.col("o_orderkey") % 7).alias("rest")), ["o_orderkey"])
    stages, _ = L.preprocessing(orders.filter("split = 'train'"), ["price"], ["prio"], ["rest"])
    cells = Pipeline(stages=stages).fit(orders).transform(orders.filter("split = 'val'"))
    names = ["price", "p2", "p3", "p4", "p5", "rest"]
    out = cells.withColumn("_cells", vector_to_array("features")).select(
        "o_orderkey", *[F.get("_cells", F.lit(i)).alias(n) for i, n in enumerate(names)])
    return rounded(out, "price")
