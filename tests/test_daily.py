from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from keelson.sources.daily import BATCH, DAY, DailyLog, refresh_days, replace_days
from keelson.sources.tables import KeyedTable, drop_table

SCHEMA = "id int, ts string, v double"


def batch(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))


def setting(spark, database, label):
    names = [f"{database}.{label}{kind}" for kind in ("_log", "_days", "_marks")]
    for name in names[:2]:
        drop_table(spark, name)
    return DailyLog(spark, names[0], "ts"), names[1], KeyedTable(spark, names[2])


def totals(name, seen):
    def compute(rows, days, upto):
        seen.append((sorted(days), upto))
        replace_days(rows.groupBy(DAY).agg(F.count("*").alias("n"), F.sum("v").alias("v")), name)

    return compute


def files(spark, name):
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    return {d: sorted(os.listdir(f"{root}/{d}")) for d in os.listdir(root) if d.startswith("day=")}


def test_late_rows_reopen_their_days_alone(spark, database):
    log, name, marks = setting(spark, database, "late")
    seen = []
    compute = totals(name, seen)
    assert log.append(batch(spark, (1, "2024-01-01 01:00", 1.0), (2, "2024-01-02 01:00", 2.0), (3, "2024-01-03 23:59:59", 3.0))) == 1
    assert refresh_days(log, "c", marks, compute) == [date(2024, 1, d) for d in (1, 2, 3)]
    before = files(spark, name)
    assert log.append(batch(spark, (4, "2024-01-02 00:00", 5.0), (5, "2024-01-04 00:00", 4.0))) == 2
    assert refresh_days(log, "c", marks, compute) == [date(2024, 1, d) for d in (2, 4)]
    after = files(spark, name)
    assert {d for d in after if before.get(d) != after[d]} == {"day=2024-01-02", "day=2024-01-04"}
    full = log.read().groupBy(DAY).agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    assert sorted(map(tuple, spark.table(name).select(DAY, "n", "v").collect())) == sorted(map(tuple, full.collect()))
    assert refresh_days(log, "c", marks, compute) == [] and seen[-1] == ([date(2024, 1, 2), date(2024, 1, 4)], 2)
    assert refresh_days(log, "other", marks, lambda *_: None) == [date(2024, 1, d) for d in (1, 2, 3, 4)]


def test_only_changed_days_are_read(spark, database):
    log, name, marks = setting(spark, database, "read")
    log.append(batch(spark, *[(d, f"2024-02-{d:02d} 10:00", 1.0) for d in range(1, 20)]))
    refresh_days(log, "c", marks, totals(name, []))
    log.append(batch(spark, (50, "2024-02-07 11:00", 1.0)))
    plans = []
    refresh_days(log, "c", marks, lambda rows, days, upto: plans.append((rows.inputFiles(), rows._jdf.queryExecution().executedPlan().toString())))
    (read, plan), = plans
    assert "PartitionFilters: [isnotnull(batch" in plan and "day" in plan
    assert {r.d for r in log.read().where("day = '2024-02-07'").select(F.col("day").cast("string").alias("d")).collect()} == {"2024-02-07"}


def test_a_failed_refresh_is_repeated(spark, database):
    log, name, marks = setting(spark, database, "failed")
    log.append(batch(spark, (1, "2024-01-01 01:00", 1.0)))

    def broken(*_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        refresh_days(log, "c", marks, broken)
    assert refresh_days(log, "c", marks, totals(name, [])) == [date(2024, 1, 1)]
    assert spark.table(name).count() == 1


def test_odd_batches(spark, database):
    log, name, marks = setting(spark, database, "odd")
    assert log.last_batch() == 0 and not log.exists() and refresh_days(log, "c", marks, totals(name, [])) == []
    with pytest.raises(ValueError, match="no day"):
        log.append(batch(spark, (1, None, 1.0)))
    log.append(batch(spark, (1, "2024-01-01 01:00", None)))
    assert log.append(batch(spark)) == 1 and log.last_batch() == 1
    log.append(batch(spark, (2, "2024-01-01 01:00", 1.0)).select("v", "ts", "id"))
    assert sorted((r.id, r[BATCH]) for r in log.read().collect()) == [(1, 1), (2, 2)] and log.read(1).count() == 1
