"""What the physical plans must look like."""

from __future__ import annotations

import re

import __spark_entry__ as entry
from keelson.operators import metrics as M
from keelson.operators import monitor as A
from keelson.plans.registry import QUERIES
from keelson.plans.derived import inference_log, scored_lines


def final_plan(df) -> str:
    """The adaptive plan as it was run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if "== Initial Plan ==" in text else text


def test_curves_read_the_table_once(spark, tiny):
    areas = M.curve_areas(scored_lines(spark, tiny))
    areas.collect()
    plan = areas._jdf.queryExecution().executedPlan().toString()  # the scan stands below a subquery's own plans
    assert "ReusedExchange" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_quantity", "l_discount", "l_tax", "l_returnflag"}


def test_scoring_is_one_stage_without_python(spark, tiny):
    plan = final_plan(entry.queries()["batch_score"](spark, tiny))
    assert "Exchange" not in plan and "Python" not in plan


def test_sketch_profile_shuffles_once(spark, tiny):
    log = inference_log(spark, tiny)
    plan = final_plan(A.profile(log, ["value"], "ts", "1 day", "version", {"clicks": "event_type = 'click'"}))
    assert len(re.findall(r"\bExchange\b", plan)) == 1 and plan.count("FileScan") == 1


def test_metrics_of_all_parts_come_from_one_scan(spark, tiny):
    plan = final_plan(M.classifier_metrics(scored_lines(spark, tiny), areas=False))
    assert plan.count("FileScan") == 1 and len(re.findall(r"\bExchange\b", plan)) == 1


def test_filters_reach_the_scan(spark, tiny):
    plan = final_plan(entry.queries()["experiment_search"](spark, tiny))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string>" in plan
    missing = entry.queries()["missing_in_prod"](spark, tiny)
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = missing._jdf.queryExecution().explainString(formatted)  # prints long filter lists in full
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan and "GreaterThan(o_totalprice,250000.0)" in plan


def test_no_cross_joins(spark, tiny):
    training = {"train_gbt", "trial_metrics", "hyper_search", "auto_classify"}
    written = {"stream_monitor", "stream_upsert", "stream_score"}
    for name, query in QUERIES.items():
        if name in training | written:
            continue
        plan = query(spark, tiny)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
