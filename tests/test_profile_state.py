from __future__ import annotations

import math
import re
import statistics

import pytest
from pyspark.sql import functions as F

from keelson.operators import monitor as A
from keelson.operators import profile_state as P
from keelson.plans.derived import inference_log

SCHEMA = "ts timestamp, value double, extra int"


def log(spark, n=4000):
    value = "if(id % 11 = 0, null, 1e9 + (id * 7919) % 1000) value"
    return spark.range(n).selectExpr("timestamp_seconds(1704067200 + id * 37) ts", value, "cast(id % 3 as int) extra")


def test_three_granularities_scan_the_log_once(spark, tiny):
    """Only the cells are computed from the log; what is rolled up reads their stored rows."""
    source = inference_log(spark, tiny)
    plan = P.profile_cells(source, ["value"], "ts", model="version", slices={"clicks": "event_type = 'click'"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("events.parquet") == 1
    rolled = P.profile_windows(source, ["value"], "ts", ["5 minutes", "1 hour", "1 day"], model="version")
    text = rolled._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in text and text.count("profile-cells") >= 3


@pytest.mark.parametrize("window", ["5 minutes", "1 hour", "1 day"])
def test_rolled_up_equals_direct(spark, window):
    frame, columns = log(spark), ["value", "extra"]
    got = P.profile_windows(frame, columns, "ts", [window], slices={"even": "extra = 0"}).drop("granularity")
    want = A.profile(frame, columns, "ts", window, slices={"even": "extra = 0"}, exact=True)
    keys = ["window_start", "slice", "column"]
    a, b = ({tuple(r[k] for k in keys): r for r in x.collect()} for x in (got, want))
    assert a.keys() == b.keys() and got.columns == want.columns
    for k, r in a.items():
        for c in ("window_end", "n", "n_null", "n_zero", "min", "max"):
            assert r[c] == b[k][c], (k, c)
        for c in ("mean", "std"):
            assert r[c] == pytest.approx(b[k][c], rel=1e-12 if c == "mean" else 1e-6)
    held = P.within_bounds(got, frame, columns, "ts", window, slices={"even": "extra = 0"})
    assert held.where("NOT (p25_ok AND p50_ok AND p75_ok AND n_distinct_ok)").count() == 0 < held.count()


def test_deviations_keep_their_digits(spark):
    """A spread of one beside a level of a billion is lost in sums of squares, not in merged deviations."""
    frame = log(spark, 600).withColumn("value", F.lit(1e9) + F.col("extra"))
    day = P.profile_windows(frame, ["value"], "ts", ["1 day"]).first()
    values = [r.value for r in frame.collect()]
    assert day["std"] == pytest.approx(statistics.pstdev(values), rel=1e-7) and math.isclose(day["mean"], statistics.fmean(values), rel_tol=1e-12)


def test_states_merge_in_any_order(spark):
    frame = log(spark).withColumn("batch", F.col("extra"))
    apart = P.profile_cells(frame, ["value"], "ts", by=["batch"])
    assert apart.select("batch").distinct().count() == 3
    together = P.state_profile(P.roll_up(apart, "1 day", drop=["batch"]), "1 day")
    direct = P.state_profile(P.roll_up(P.profile_cells(frame, ["value"], "ts"), "1 day"), "1 day")
    for a, b in zip(*(sorted(x.collect(), key=lambda r: r.window_start) for x in (together, direct)), strict=True):
        assert [a[c] for c in ("n", "n_null", "min", "max")] == [b[c] for c in ("n", "n_null", "min", "max")]
        assert a["mean"] == pytest.approx(b["mean"]) and a["std"] == pytest.approx(b["std"], rel=1e-6)


def test_odd_cells(spark):
    rows = spark.createDataFrame([(None, 1.0, 1), ("2024-01-01 00:00:00", None, 1), ("2024-01-01 00:06:00", None, 2)], "ts string, value double, extra int")
    frame = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    day = {r.window_start is None: r for r in P.profile_windows(frame, ["value"], "ts", ["1 day"]).collect()}
    assert (day[False].n, day[False].n_null, day[False].n_distinct, day[False]["mean"], day[False].p50, day[False]["std"]) == (2, 2, 0, None, None, None)
    assert P.profile_windows(frame.limit(0), ["value"], "ts", ["1 hour", "1 day"]).count() == 0
    with pytest.raises(ValueError, match="multiple"):
        P.roll_up(P.profile_cells(frame, ["value"], "ts", "7 minutes"), "1 hour", "7 minutes")


def test_a_large_group_is_checked_by_many_tasks(spark, monkeypatch):
    """Values of one day are counted by slices of them; both zeros are one value."""
    monkeypatch.setattr(P, "TASK_ROWS", 100, raising=False)
    value = "case when id % 11 = 0 then null when id % 7 = 0 then 0d when id % 7 = 1 then -0d else (id * 7919) % 300 end value"
    frame = spark.range(2000).selectExpr("timestamp_seconds(1704067200 + id) ts", value)
    profiled = P.profile_windows(frame, ["value"], "ts", ["1 day"])
    held = P.within_bounds(profiled, frame, ["value"], "ts", "1 day")
    assert held.where("p25_ok AND p50_ok AND p75_ok AND n_distinct_ok").count() == held.count() == 1
    near = frame.select(F.countDistinct("value").alias("d")).first().d
    for shown, ok in ((near, True), (near * 1.08 + 1.5, False), (near * 0.92 - 1.5, False)):
        asked = profiled.withColumn("n_distinct", F.lit(shown))
        assert P.within_bounds(asked, frame, ["value"], "ts", "1 day").first().n_distinct_ok is ok
    for p25, ok in ((-1.0, False), (0.0, True), (300.0, False)):
        assert P.within_bounds(profiled.withColumn("p25", F.lit(p25)), frame, ["value"], "ts", "1 day").first().p25_ok is ok
    plan = held._jdf.queryExecution().executedPlan().toString()
    found = [int(n) for n in re.findall(r"hashpartitioning\([^)]*_cut[^)]*, (\d+)\)", plan)]
    assert found and min(found) >= 20
