"""Registered queries: monitoring, drift, business outputs and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.hashing import bucket
from keelson.operators import drift as D
from keelson.operators import monitor as A
from keelson.operators import outputs as O
from keelson.operators import profile_state as P
from keelson.operators import significance as G
from keelson.operators.features import FeatureSpec
from keelson.plans.derived import (
    DRIFTED,
    LOG,
    PRIORITIES,
    SLICED,
    SLICES,
    drifted,
    inference_log,
    prepare_log,
)
from keelson.plans.registry import query, rounded, sql_bucket, table
from keelson.plans.table_queries import scratch_name
from keelson.session import is_folder, scratch_path
from keelson.sources.daily import DAY, DailyLog, refresh_days, replace_days
from keelson.sources.tables import KeyedTable
from keelson.streaming import jobs

STATS = ["min", "max", "std", "p25", "p50", "p75"]


def _rounded_profile(df: DataFrame) -> DataFrame:
    """The mean keeps more digits: with two decimals in the data a mean of 32 rows can
    end exactly between two values of six digits."""
    return rounded(rounded(df, *[c for c in STATS if c in df.columns]), "mean", digits=8)



def _profile_sql(source: str, keys: str, columns: list[str], quantiles: bool = True) -> str:
    """One exact profile per column, stacked."""
    def one(c: str) -> str:
        v = f"{c}::double"
        marks = f""", round(quantile_cont({v}, 0.25), 6) p25, round(quantile_cont({v}, 0.5), 6) p50,
        round(quantile_cont({v}, 0.75), 6) p75, count(distinct {v}) n_distinct""" if quantiles else ""
        lead = f"{keys}, " if keys else ""
        group = f"group by {keys}" if keys else ""
        return f"""
select {lead}'{c}' "column", count(*) n, count(*) filter (where {c} is null) n_null,
       round(min({v}), 6) min, round(max({v}), 6) max, round(avg({v}), 8) mean, round(stddev_pop({v}), 6) std,
       count(*) filter (where {v} = 0) n_zero{marks}
from {source} {group}"""

    return " union all ".join(one(c) for c in columns)


def _windows(size: str) -> str:
    return f"""{LOG}, {SLICED},
w as (select *, time_bucket(interval '{size}', ts) window_start,
             time_bucket(interval '{size}', ts) + interval '{size}' window_end, version model_version from sliced)"""


PROFILED = "window_start, window_end, model_version, slice"


@query("monitor_profile", f"with {_windows('5 minutes')} " + _profile_sql("w", PROFILED, ["value", "user_id"]))
def monitor_profile(spark, sf_dir) -> DataFrame:
    log = inference_log(spark, sf_dir)
    out = A.profile(log, ["value", "user_id"], "ts", "5 minutes", "version", _slices(), exact=True)
    return _rounded_profile(out)


def _slices():
    return {"clicks": F.col("event_type") == "click", "high_value": F.expr(SLICES["high_value"])}


@query("monitor_profile_daily", f"with {_windows('1 day')} " + _profile_sql("w", PROFILED, ["value", "user_id"]))
def monitor_profile_daily(spark, sf_dir) -> DataFrame:
    log = inference_log(spark, sf_dir)
    return _rounded_profile(A.profile(log, ["value", "user_id"], "ts", "1 day", "version", _slices(), exact=True))


@query("data_profile", _profile_sql("customer", "", ["c_acctbal", "c_nationkey"]))
def data_profile(spark, sf_dir) -> DataFrame:
    return _rounded_profile(A.profile(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"], exact=True))


@query("category_profile", f"""
with {_windows('1 day')},
c as (select window_start, window_end, model_version, slice, event_type as value, count(*) n from w group by all),
t as (select *, row_number() over (partition by window_start, model_version, slice order by n desc, value desc) rn from c)
select window_start, window_end, model_version, slice, 'event_type' "column", sum(n)::bigint n, 0::bigint n_null,
       count(*) n_distinct, max(case when rn = 1 then value end) top_value, max(case when rn = 1 then n end) top_rows
from t group by all""")
def category_profile(spark, sf_dir) -> DataFrame:
    return A.category_profile(inference_log(spark, sf_dir), ["event_type"], "ts", "1 day", "version", _slices())


@query("refresh_late_rows", f"""
with {_windows('1 day')}, p as ({_profile_sql('w', PROFILED, ['value', 'user_id'])})
select *, case when window_start < timestamp '2024-01-06' then 3 when window_start < timestamp '2024-01-16' then 1 else 2 end::bigint written_by
from p""")
def refresh_late_rows(spark, sf_dir) -> DataFrame:
    """Three batches, the third with late rows of the first five days, and a refresh after each: the result is that of a
    profile of everything, and ``written_by`` tells which batch a day was last written after."""
    rows, half = inference_log(spark, sf_dir), F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    late = (bucket("event_id") < 10) & (F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-06 00:00:00'"))
    log = DailyLog(spark, scratch_name(spark, "log"), "ts")
    results, marks = scratch_name(spark, "daily_profile"), KeyedTable(spark, scratch_name(spark, "marks"))

    def compute(changed: DataFrame, days, upto: int) -> None:
        profiled = A.profile(changed, ["value", "user_id"], "ts", "1 day", "version", _slices(), exact=True)
        replace_days(profiled.withColumns({"written_by": F.lit(upto).cast("bigint"), DAY: F.to_date("window_start")}), results)

    for batch in (rows.filter(half & ~late), rows.filter(~half), rows.filter(late)):
        log.append(batch)
        refresh_days(log, "profile", marks, compute)
    return _rounded_profile(spark.table(results).drop(DAY))


GRANULARITIES = ("5 minutes", "1 hour", "1 day")
SKETCH_FLAGS = ["p25_ok", "p50_ok", "p75_ok", "n_distinct_ok"]


def _rolled_sql(size: str) -> str:
    flags = ", ".join(f"true {f}" for f in SKETCH_FLAGS)
    return (f"select '{size}' granularity, *, {flags} from (with {_windows(size)} "
            + _profile_sql("w", PROFILED, ["value", "user_id"], quantiles=False) + ")")


@query("profile_rollup", " union all ".join(map(_rolled_sql, GRANULARITIES)))
def profile_rollup(spark, sf_dir) -> DataFrame:
    """Five-minute cells of one scan, rolled up to hours and days; sketches are held against the rows."""
    log, columns = inference_log(spark, sf_dir), ["value", "user_id"]
    profiled = P.profile_windows(log, columns, "ts", GRANULARITIES, P.CELL, "version", _slices())
    out = None
    for size in GRANULARITIES:
        one = profiled.filter(F.col("granularity") == size)
        one = P.within_bounds(one, log, columns, "ts", size, "version", _slices()).drop("p25", "p50", "p75", "n_distinct")
        out = one if out is None else out.unionByName(one)
    return _rounded_profile(out)


RATES_SQL = """
round((tp + tn)::double / n, 6) accuracy, round(coalesce(tp::double / nullif(tp + fp, 0), 0), 6) "precision",
round(coalesce(tp::double / nullif(tp + fn, 0), 0), 6) recall,
round(coalesce(2.0 * tp::double / nullif(2 * tp + fp + fn, 0), 0), 6) f1"""


def _quality_sql(source: str, keys: str) -> str:
    return f"""
select {keys}, n, tp, fp, fn, tn, {RATES_SQL}
from (select {keys}, count(*) n,
        count(*) filter (where prediction = 1 and label = 1) tp, count(*) filter (where prediction = 1 and label = 0) fp,
        count(*) filter (where prediction = 0 and label = 1) fn, count(*) filter (where prediction = 0 and label = 0) tn
      from {source} where label is not null group by {keys})"""


@query("monitor_quality", f"with {_windows('1 hour')} " + _quality_sql("w", PROFILED))
def monitor_quality(spark, sf_dir) -> DataFrame:
    out = A.quality(inference_log(spark, sf_dir), "label", "prediction", "ts", "1 hour", "version", _slices())
    return rounded(out, "accuracy", "precision", "recall", "f1")


def _fair_sql(name: str, predicate: str) -> str:
    def gap(top: str, bottom: str) -> str:
        def side(test: str) -> str:
            return (f"count(*) filter (where {test} and {top})::double"
                    f" / nullif(count(*) filter (where {test} and {bottom}), 0)")
        return f"round({side(f'({predicate})')} - ({side(f'(({predicate}) is not true)')}), 6)"

    return f"""
select '{name}' slice, count(*) filter (where {predicate}) n_in, count(*) filter (where ({predicate}) is not true) n_out,
       {gap('prediction = 1', 'true')} statistical_parity,
       {gap('prediction = 1 and label = 1', 'label = 1')} equal_opportunity,
       {gap('prediction = 1 and label = 1', 'prediction = 1')} predictive_parity,
       {gap('prediction = 1 and label = 0', 'label = 0')} predictive_equality
from log"""


@query("fairness", f"with {LOG} " + " union all ".join(_fair_sql(n, p) for n, p in SLICES.items()))
def fairness(spark, sf_dir) -> DataFrame:
    out = A.fairness(inference_log(spark, sf_dir), SLICES, "label", "prediction")
    return rounded(out, "statistical_parity", "equal_opportunity", "predictive_parity", "predictive_equality")


# --- drift --------------------------------------------------------------------

DAYS = LOG + ", w as (select *, time_bucket(interval '1 day', ts) window_start from log)"
BASELINE = f"{sql_bucket('event_id')} < 25"


@query("drift_deltas", f"""
with {DAYS},
p as (select window_start, version model_version, 'value' "column", count(*)::double "count", avg(value) mean,
             count(*) filter (where value is null)::double / count(*) null_share,
             count(*) filter (where value = 0)::double / count(*) zero_share,
             count(distinct value)::double / count(*) distinct_share
      from w where not ({BASELINE}) group by 1, 2),
b as (select count(*)::double "count", avg(value) mean, count(*) filter (where value is null)::double / count(*) null_share,
             count(*) filter (where value = 0)::double / count(*) zero_share,
             count(distinct value)::double / count(*) distinct_share from w where {BASELINE}),
d as (select window_start, model_version, "column", unnest(['baseline', 'consecutive']) kind,
        unnest([p."count" - b."count", p."count" - lag(p."count") over o]) delta_count,
        unnest([p.mean - b.mean, p.mean - lag(p.mean) over o]) delta_mean,
        unnest([p.null_share - b.null_share, p.null_share - lag(p.null_share) over o]) delta_null_share,
        unnest([p.zero_share - b.zero_share, p.zero_share - lag(p.zero_share) over o]) delta_zero_share,
        unnest([p.distinct_share - b.distinct_share, p.distinct_share - lag(p.distinct_share) over o]) delta_distinct_share
      from p, b window o as (partition by model_version order by window_start))
select window_start, model_version, "column", kind, metric, round(v, 6) as value
from (select window_start, model_version, "column", kind, 'delta_count' metric, delta_count v from d
      union all select window_start, model_version, "column", kind, 'delta_mean', delta_mean from d
      union all select window_start, model_version, "column", kind, 'delta_null_share', delta_null_share from d
      union all select window_start, model_version, "column", kind, 'delta_zero_share', delta_zero_share from d
      union all select window_start, model_version, "column", kind, 'delta_distinct_share', delta_distinct_share from d)
where v is not null""")
def drift_deltas(spark, sf_dir) -> DataFrame:
    """Days of the log against the hashed baseline quarter and against the day before."""
    log, place = inference_log(spark, sf_dir), bucket("event_id") < 25
    current = A.profile(log.filter(~place), ["value"], "ts", "1 day", "version", exact=True)
    reference = A.profile(log.filter(place), ["value"], exact=True)
    out = D.drift_deltas(current, reference, keys=["model_version", "column"], match=["column"])
    return rounded(out, "value")


BINS = 10


def _bins_sql(source: str, keys: str = "") -> str:
    """Shares per bin of the baseline's range; p is the log, q the baseline."""
    return f"""
edges as (select min(value) lo, max(value) hi from {source} where is_baseline),
binned as (select is_baseline, case when value >= hi then {BINS - 1} when value <= lo then 0 else
             least(greatest(floor((value - lo) / ((hi - lo) / {BINS}.0)), 0), {BINS - 1})::int end bin
           from {source}, edges where value is not null),
shares as (select b.i bin,
    greatest((select count(*) from binned where bin = b.i and not is_baseline)::double
             / (select count(*) from binned where not is_baseline), 0.0001) p,
    greatest((select count(*) from binned where bin = b.i and is_baseline)::double
             / (select count(*) from binned where is_baseline), 0.0001) q
  from range({BINS}) b(i))"""


PSI = f"{DRIFTED}, {_bins_sql('tagged')}"
JS = """, t as (select sum(p) sp, sum(q) sq from shares), n as (select p / sp p, q / sq q from shares, t)
select round(sqrt(sum((p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2) / ln(2)), 6) js_distance from n"""
CDF = f"""{DRIFTED},
c as (select value, count(*) filter (where is_baseline) b, count(*) filter (where not is_baseline) l
      from tagged where value is not null group by 1),
f as (select value, abs(sum(l) over o / sum(l) over ()::double - sum(b) over o / sum(b) over ()::double) gap,
             lead(value) over o next from c window o as (order by value))"""
CATEGORIES = f"""{DRIFTED},
c as (select case when value > 100 then 'large' else event_type end category,
             count(*) filter (where not is_baseline) p, count(*) filter (where is_baseline) q from tagged group by 1),
t as (select sum(p)::double np, sum(q)::double nq from c)"""


def _categorised(spark, sf_dir) -> DataFrame:
    """Event types, with the large (scaled) values as a type of their own."""
    kind = F.when(F.col("value") > 100, F.lit("large")).otherwise(F.col("event_type"))
    return drifted(spark, sf_dir).select(D.SIDE, kind.alias("category"))


@query("drift_psi", f"with {PSI} select round(sum((p - q) * ln(p / q)), 6) psi from shares")
def drift_psi(spark, sf_dir) -> DataFrame:
    return rounded(D.psi(drifted(spark, sf_dir), "value"), "psi")


@query("drift_js", f"with {PSI}{JS}")
def drift_js(spark, sf_dir) -> DataFrame:
    return rounded(D.js_distance(drifted(spark, sf_dir), "value"), "js_distance")


@query("drift_ks", f"with {CDF} select round(max(gap), 6) ks from f")
def drift_ks(spark, sf_dir) -> DataFrame:
    return rounded(D.ks(drifted(spark, sf_dir), "value"), "ks")


@query("drift_ks_by_version", f"""
with {DRIFTED},
c as (select version, value, count(*) filter (where is_baseline) b, count(*) filter (where not is_baseline) l
      from tagged where value is not null group by 1, 2),
f as (select version, abs(sum(l) over o / sum(l) over (partition by version)::double
                          - sum(b) over o / sum(b) over (partition by version)::double) gap
      from c window o as (partition by version order by value))
select version, round(max(gap), 6) ks from f group by 1""")
def drift_ks_by_version(spark, sf_dir) -> DataFrame:
    return rounded(D.ks(drifted(spark, sf_dir), "value", ["version"]), "ks")


@query("drift_wasserstein", f"with {CDF} select round(coalesce(sum(gap * (next - value)), 0), 6) wasserstein from f")
def drift_wasserstein(spark, sf_dir) -> DataFrame:
    return rounded(D.wasserstein(drifted(spark, sf_dir), "value"), "wasserstein")


@query("drift_chi2", f"""
with {CATEGORIES}
select round(sum(power(p - (p + q) * np / (np + nq), 2) / ((p + q) * np / (np + nq))
               + power(q - (p + q) * nq / (np + nq), 2) / ((p + q) * nq / (np + nq))), 6) chi2, count(*) - 1 dof
from c, t""")
def drift_chi2(spark, sf_dir) -> DataFrame:
    return rounded(D.chi2(_categorised(spark, sf_dir), "category"), "chi2")


@query("drift_tv", f"with {CATEGORIES} select round(sum(abs(p / np - q / nq)) / 2, 6) tv_distance from c, t")
def drift_tv(spark, sf_dir) -> DataFrame:
    return rounded(D.tv_distance(_categorised(spark, sf_dir), "category"), "tv_distance")


@query("drift_linf", f"with {CATEGORIES} select round(max(abs(p / np - q / nq)), 6) linf_distance from c, t")
def drift_linf(spark, sf_dir) -> DataFrame:
    return rounded(D.linf_distance(_categorised(spark, sf_dir), "category"), "linf_distance")


SIDES = f"""{LOG}, tagged as (select *, ts < timestamp '2024-01-16' is_baseline, extract(hour from ts)::int as hour from log)"""


def _sides(spark, sf_dir) -> DataFrame:
    """Both halves of the month as they are; errors of the last hour only in the second."""
    return inference_log(spark, sf_dir).withColumns({D.SIDE: F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'"), "hour": F.hour("ts")})


@query("drift_ks_test", f"""
with {SIDES},
c as (select hour, value, count(*) filter (where is_baseline) b, count(*) filter (where not is_baseline) l
      from tagged where value is not null and not (hour = 23 and is_baseline) group by 1, 2),
f as (select hour, value, sum(l) over o / sum(l) over (partition by hour)::double - sum(b) over o / nullif(sum(b) over (partition by hour), 0)::double gap,
             sum(l) over (partition by hour) n, sum(b) over (partition by hour) m from c window o as (partition by hour order by value)),
k as (select hour, max(abs(gap)) ks, max(n)::bigint n_log, max(m)::bigint n_base from f group by 1),
x as (select *, sqrt(n_log * n_base::double / (n_log + n_base)) e from k)
select hour, round(ks, 6) ks, n_log, n_base, case when ks is not null then
  round(least(1, greatest(0, 2 * list_sum(list_transform(range(1, 2000), lambda j: power(-1, j - 1) * exp(-2 * j * j * power((e + 0.12 + 0.11 / e) * ks, 2)))))), 6) end p_value
from x""")
def drift_ks_test(spark, sf_dir) -> DataFrame:
    """Per hour of the day; the last hour has no baseline."""
    rows = _sides(spark, sf_dir).filter((F.col("hour") < 23) | ~F.col(D.SIDE))
    return rounded(G.ks_test(rows, "value", ["hour"]), "ks", "p_value")


@query("drift_chi2_test", f"""
with {SIDES},
c as (select hour, event_type, count(*) filter (where not is_baseline) p, count(*) filter (where is_baseline) q
      from tagged where not (hour = 23 and is_baseline) group by 1, 2),
t as (select *, sum(p) over (partition by hour) np, sum(q) over (partition by hour) nq from c),
k as (select hour, case when max(nq) > 0 then sum(power(p - (p + q) * np / (np + nq), 2) / ((p + q) * np / (np + nq))
                 + power(q - (p + q) * nq / (np + nq), 2) / ((p + q) * nq / (np + nq))) end chi2, count(*) - 1 dof from t group by 1)
select hour, round(chi2, 6) chi2, dof, round(1 - list_sum(list_transform(range(0, 400),
         lambda n: exp((dof / 2.0 + n) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2.0 + n + 1)))), 6) p_value from k""")
def drift_chi2_test(spark, sf_dir) -> DataFrame:
    """Event types per hour of the day; the last hour has no baseline."""
    rows = _sides(spark, sf_dir).filter((F.col("hour") < 23) | ~F.col(D.SIDE))
    return rounded(G.chi2_test(rows, "event_type", ["hour"]), "chi2", "p_value")


@query("retrain_series", f"""
with {LOG},
d as (select date_trunc('day', ts)::timestamp as day, version, case when day(ts) <> 12 then avg(prediction) end risk
      from log where not (version = '2' and day(ts) = 9) group by 1, 2, day(ts)),
b as (select version, avg(risk) target from d where day < timestamp '2024-01-06' group by 1),
r as (select d.*, case when day >= timestamp '2024-01-20' then 1 else 0 end run, coalesce(risk - target - 0.002, 0) step from d join b using (version)),
s as (select *, sum(step) over (partition by version, run order by day) total from r),
c as (select *, total - least(0, min(total) over (partition by version, run order by day)) cusum from s)
select day, version, round(risk, 6) risk, run, round(cusum, 6) cusum, cusum > 0.05 alarm,
       cusum > 0.05 and sum((cusum > 0.05)::int) over (partition by version, run order by day) = 1 first_alarm from c""")
def retrain_series(spark, sf_dir) -> DataFrame:
    """The share of positive predictions per day and model against its first five days; retrained on the 20th. One day has no
    value, and one model lacks a day."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    log = inference_log(spark, sf_dir).filter(~((F.col("version") == "2") & (F.dayofmonth("ts") == 9)))
    daily = log.groupBy(day, "version").agg(F.avg("prediction").alias("risk"))
    daily = daily.withColumn("risk", F.when(F.dayofmonth("day") != 12, F.col("risk")))
    base = daily.filter(F.col("day") < F.expr("TIMESTAMP_NTZ '2024-01-06 00:00:00'")).groupBy("version").agg(F.avg("risk").alias("target"))
    retrained = F.col("day") == F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    out = G.cusum(daily.join(base, "version"), ["version"], "day", "risk", F.col("target"), 0.002, 0.05, retrained)
    return rounded(out.drop("target"), "risk", "cusum")


def _rate_sql(c: str) -> str:
    return f"""
select '{c}' "column", round(avg({c}::double) filter (where is_baseline), 6) base_rate,
       round(avg({c}::double) filter (where not is_baseline), 6) log_rate,
       round(avg({c}::double) filter (where not is_baseline) - avg({c}::double) filter (where is_baseline), 6) shift
from tagged"""


@query("drift_prediction", f"with {DRIFTED} {_rate_sql('prediction')} union all {_rate_sql('label')}")
def drift_prediction(spark, sf_dir) -> DataFrame:
    out = D.rate_shift(drifted(spark, sf_dir), ["prediction", "label"])
    return rounded(out, "base_rate", "log_rate", "shift")


@query("drift_windows", f"""
with {DRIFTED},
edges as (select min(value) lo, max(value) hi from tagged where is_baseline),
binned as (select is_baseline, date_trunc('day', ts) as day, version, case when value >= hi then {BINS - 1} when value <= lo then 0 else
             least(greatest(floor((value - lo) / ((hi - lo) / {BINS}.0)), 0), {BINS - 1})::int end bin
           from tagged, edges where value is not null),
base as (select i bin, greatest((select count(*) from binned where is_baseline and bin = i)::double
                / (select count(*) from binned where is_baseline), 0.0001) q from range({BINS}) r(i)),
grp as (select day, version, count(*) n from binned where not is_baseline group by 1, 2),
cnt as (select day, version, bin, count(*) c from binned where not is_baseline group by 1, 2, 3),
s as (select grp.day, grp.version, n, q, greatest(coalesce(c, 0)::double / n, 0.0001) p
      from grp cross join base left join cnt
        on cnt.day = grp.day and cnt.version = grp.version and cnt.bin = base.bin),
t as (select *, p / sum(p) over (partition by day, version) a, q / sum(q) over (partition by day, version) b from s)
select day::timestamp as day, version, max(n) n, round(sum((p - q) * ln(p / q)), 6) psi,
       round(sqrt(greatest(sum((a * ln(a / ((a + b) / 2)) + b * ln(b / ((a + b) / 2))) / 2) / ln(2), 0)), 6) js_distance
from t group by 1, 2""")
def drift_windows(spark, sf_dir) -> DataFrame:
    """PSI and JS per day and model of the second half against the first half."""
    tagged = drifted(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    out = D.window_psi(tagged.filter(~F.col(D.SIDE)), tagged.filter(D.SIDE), "value", ["day", "version"], BINS)
    return rounded(out, "psi", "js_distance")


@query("drift_missing_sides", f"""
with {DRIFTED},
t as (select *, date_trunc('day', ts) as day, case when day(ts) = 20 then null else value end v
      from tagged where not (is_baseline and event_type = 'view')),
edges as (select min(v) lo, max(v) hi from t where is_baseline),
binned as (select is_baseline, day, event_type, case when v >= hi then {BINS - 1} when v <= lo then 0 else
             least(greatest(floor((v - lo) / ((hi - lo) / {BINS}.0)), 0), {BINS - 1})::int end bin
           from t, edges where v is not null),
grp as (select day, event_type, count(v) n from t where not is_baseline group by 1, 2),
cnt as (select day, event_type, bin, count(*) c from binned where not is_baseline group by 1, 2, 3),
bt as (select event_type, count(*) b from binned where is_baseline group by 1),
bc as (select event_type, bin, count(*) c from binned where is_baseline group by 1, 2),
s as (select grp.day, grp.event_type, n, b, greatest(coalesce(cnt.c, 0)::double / nullif(n, 0), 0.0001) p,
             greatest(coalesce(bc.c, 0)::double / b, 0.0001) q
      from grp cross join range({BINS}) r(i) left join bt on bt.event_type = grp.event_type
      left join cnt on cnt.day = grp.day and cnt.event_type = grp.event_type and cnt.bin = i
      left join bc on bc.event_type = grp.event_type and bc.bin = i),
u as (select *, p / sum(p) over (partition by day, event_type) a, q / sum(q) over (partition by day, event_type) c from s)
select day::timestamp as day, event_type, max(n) n,
       case when max(n) > 0 and max(b) > 0 then round(sum((p - q) * ln(p / q)), 6) end psi,
       case when max(n) > 0 and max(b) > 0 then
         round(sqrt(greatest(sum((a * ln(a / ((a + c) / 2)) + c * ln(c / ((a + c) / 2))) / 2) / ln(2), 0)), 6) end js_distance
from u group by 1, 2""")
def drift_missing_sides(spark, sf_dir) -> DataFrame:
    """A day without values, and an event type the baseline lacks, keep their rows with a NULL statistic."""
    tagged = drifted(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz")).withColumn(
        "value", F.when(F.dayofmonth("ts") != 20, F.col("value")))
    baseline = tagged.filter(F.col(D.SIDE) & (F.col("event_type") != "view"))
    out = D.window_psi(tagged.filter(~F.col(D.SIDE)), baseline, "value", ["day", "event_type"], BINS, ["event_type"])
    return rounded(out.select("day", "event_type", "n", "psi", "js_distance"), "psi", "js_distance")


@query("drift_empty_baseline", f"""
with {DRIFTED} select null::double psi, null::double js_distance, null::double wasserstein, count(value) n
from tagged where not is_baseline""")
def drift_empty_baseline(spark, sf_dir) -> DataFrame:
    """Without a baseline there is no statistic, and no error."""
    log = drifted(spark, sf_dir).filter(~F.col(D.SIDE))
    n = log.agg(F.count("value").alias("n"))
    return n.select(
        D.psi(log, "value").scalar().alias("psi"), D.js_distance(log, "value").scalar().alias("js_distance"),
        D.wasserstein(log, "value").scalar().alias("wasserstein"), "n")


def _psi_sql(column: str) -> str:
    return f"""
select day, '{column}' as column, unnest(['psi', 'js_distance']) metric, unnest([round(sum((p - q) * ln(p / q)), 6),
       round(sqrt(greatest(sum((a * ln(a / ((a + b) / 2)) + b * ln(b / ((a + b) / 2))) / 2) / ln(2), 0)), 6)]) as value
from (select *, p / sum(p) over (partition by day) a, q / sum(q) over (partition by day) b from (
  select grp.day, greatest(coalesce(cnt.c, 0)::double / n, 0.0001) p, greatest(coalesce(bc.c, 0)::double / b, 0.0001) q
  from (select day, count({column}) n from t where not is_baseline group by 1) grp
  cross join range({BINS}) r(i) cross join (select count({column}) b from t where is_baseline)
  left join (select day, {column}_bin bin, count(*) c from t where not is_baseline group by 1, 2) cnt on cnt.day = grp.day and cnt.bin = i
  left join (select {column}_bin bin, count(*) c from t where is_baseline group by 1) bc on bc.bin = i)) group by 1"""


def _bin_sql(column: str) -> str:
    lo, hi = (f"(select {f}({column}) from tagged where is_baseline)" for f in ("min", "max"))
    return f"""case when {column} is null then null when {column} >= {hi} then {BINS - 1} when {column} <= {lo} then 0 else
  least(greatest(floor(({column} - {lo}) / (({hi} - {lo}) / {BINS}.0)), 0), {BINS - 1})::int end {column}_bin"""


@query("baseline_drift", f"""
with {DRIFTED}, t as (select *, date_trunc('day', ts)::timestamp as day, {_bin_sql('value')}, {_bin_sql('user_id')} from tagged),
tv as (select day, 'event_type' as column, 'tv_distance' metric, round(sum(abs(coalesce(c, 0)::double / n - q)) / 2, 6) as value
       from (select day, count(*) n from t where not is_baseline group by 1) grp
       cross join (select event_type, count(*)::double / sum(count(*)) over () q from t where is_baseline group by 1) base
       left join (select day d, event_type e, count(*) c from t where not is_baseline group by 1, 2) on d = grp.day and e = base.event_type
       group by 1)
select * from ({_psi_sql('value')} union all {_psi_sql('user_id')} union all select * from tv)""")
def baseline_drift(spark, sf_dir) -> DataFrame:
    """All columns of the log against the baseline from one set of counts."""
    tagged = drifted(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    out = D.baseline_drift(tagged.filter(~F.col(D.SIDE)), tagged.filter(D.SIDE), ["value", "user_id"], ["event_type"], ["day"], (), BINS)
    return rounded(out.select("day", "column", "metric", "value"), "value")


@query("drift_windows_tv", f"""
with {DRIFTED},
base as (select event_type, count(*)::double / sum(count(*)) over () q from tagged where is_baseline group by 1),
grp as (select date_trunc('day', ts) as day, version, count(*) n from tagged where not is_baseline group by 1, 2),
cnt as (select date_trunc('day', ts) as day, version, event_type, count(*) c from tagged where not is_baseline group by 1, 2, 3)
select grp.day::timestamp as day, grp.version, max(n) n, round(sum(abs(coalesce(c, 0)::double / n - q)) / 2, 6) tv_distance
from grp cross join base left join cnt
  on cnt.day = grp.day and cnt.version = grp.version and cnt.event_type = base.event_type
group by 1, 2""")
def drift_windows_tv(spark, sf_dir) -> DataFrame:
    """Total variation of the event types per day and model against the first half."""
    tagged = drifted(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    out = D.window_tv(tagged.filter(~F.col(D.SIDE)), tagged.filter(D.SIDE), "event_type", ["day", "version"])
    return rounded(out, "tv_distance")


# --- business outputs ---------------------------------------------------------

@query("at_risk_daily", f"""
with {LOG},
last as (select *, row_number() over (partition by ts::date, user_id order by ts desc, event_id desc) rn from log)
select ts::date as day, user_id, ts, event_id, prediction, score from last where rn = 1 and prediction = 1""")
def at_risk_daily(spark, sf_dir) -> DataFrame:
    return O.at_risk_daily(inference_log(spark, sf_dir), "user_id", "ts", "prediction", "score", tie=["event_id"])


@query("risk_evolution", f"""
with {LOG}
select date_trunc('day', ts)::timestamp as period, count(*) n, round(avg(prediction::double), 6) risk_rate,
       round(avg(score), 6) mean_score from log group by 1""")
def risk_evolution(spark, sf_dir) -> DataFrame:
    out = O.risk_evolution(inference_log(spark, sf_dir), "ts", "prediction", "score")
    return rounded(out.withColumn("period", F.col("period").cast("timestamp_ntz")), "risk_rate", "mean_score")


LIMITS = {"psi": ("above", 0.1), "ks": ("above", 0.2), "accuracy": ("below", 0.55), "rate_shift": ("above", 0.05)}


@query("retrain_signal", f"""
with {CDF}, {_bins_sql('tagged')},
v as (select 'psi' metric, sum((p - q) * ln(p / q)) v, 0.1::double as "limit" from shares
      union all select 'ks', max(gap), 0.2::double from f
      union all select 'accuracy', avg(case when prediction = label then 1.0 else 0.0 end), 0.55::double from log
      union all select 'rate_shift', abs(avg(prediction::double) filter (where not is_baseline)
                       - avg(prediction::double) filter (where is_baseline)), 0.05::double from tagged)
select metric, round(v, 6) as value, "limit", case when metric = 'accuracy' then v < "limit" else v > "limit" end retrain
from v""")
def retrain_signal(spark, sf_dir) -> DataFrame:
    """Drift and quality values, each from its own aggregate, against their limits."""
    tagged, log = drifted(spark, sf_dir), inference_log(spark, sf_dir)
    hit = F.avg(F.when(F.col("prediction") == F.col("label"), F.lit(1.0)).otherwise(F.lit(0.0)))
    shift = D.rate_shift(tagged, ["prediction"]).select(F.abs("shift").alias("value"))
    values = [
        ("psi", D.psi(tagged, "value").toDF("value")), ("ks", D.ks(tagged, "value").toDF("value")),
        ("accuracy", log.agg(hit.alias("value"))), ("rate_shift", shift),
    ]
    union = None
    for name, frame in values:
        named = frame.select(F.lit(name).alias("metric"), "value")
        union = named if union is None else union.unionByName(named)
    return rounded(D.retrain_signal(union, LIMITS), "value")


# --- streaming ----------------------------------------------------------------

def event_stream(spark, sf_dir, name: str = "events") -> DataFrame:
    """A table as a stream of its files, be it a folder of them or a single one."""
    stream = spark.readStream.schema(table(spark, sf_dir, name).schema)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if is_folder(spark, path):
        return stream.parquet(path)
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


CLOSED = "w.window_end <= (select max(ts) from events) - interval '10 minutes'"


@query("stream_monitor", f"""
with {_windows('1 hour')}, closed as (select * from w where {CLOSED})
select *, {", ".join(f"true {f}" for f in SKETCH_FLAGS)} from (""" + _profile_sql("closed", PROFILED, ["value"], quantiles=False) + ")")
def stream_monitor(spark, sf_dir) -> DataFrame:
    """Windows the watermark has passed; the open ones are still held as state. Sketches are held against the rows."""
    path = scratch_path(spark, "stream-monitor")
    log = prepare_log(event_stream(spark, sf_dir))
    profiled = jobs.stream_monitor(log, ["value"], "ts", "1 hour", "10 minutes", "version", _slices())
    jobs.append_to(profiled, path).awaitTermination()
    out = spark.read.parquet(path).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    out = P.within_bounds(out, inference_log(spark, sf_dir), ["value"], "ts", "1 hour", "version", _slices(),
                          distinct_error=4 * A.DISTINCT_ERROR)
    return _rounded_profile(out.drop("p25", "p50", "p75", "n_distinct"))


@query("stream_upsert", f"""
select o_orderkey, round(case when {sql_bucket('o_orderkey')} >= 85 then o_totalprice
                              else -1.0 end, 2) o_totalprice,
       {", ".join(f'''(case when o_orderpriority = '{v}' then 1 else 0 end)::bigint
          "o_orderpriority_{v.lower().replace("-", "_").replace(" ", "_")}"''' for v in PRIORITIES)}
from orders where {sql_bucket('o_orderkey')} >= 85 or {sql_bucket('o_orderkey')} < 90""")
def stream_upsert(spark, sf_dir) -> DataFrame:
    """The stream brings the true price of some keys, new and old; the base holds -1."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    spec = FeatureSpec(["o_orderpriority"]).fit(orders)
    place = bucket("o_orderkey")
    base = spec.transform(orders.filter(place < 90).withColumn("o_totalprice", F.lit(-1.0)))
    store = KeyedTable(spark, scratch_name(spark, "stream_features"))
    store.create(base.schema, ["o_orderkey"]).merge(base)
    arriving = event_stream(spark, sf_dir, "orders").filter(place >= 85).select(orders.columns)
    jobs.stream_upsert(arriving, store, spec.transform, order=["o_totalprice"]).awaitTermination()
    return rounded(store.read(), "o_totalprice", digits=2)


@query("stream_upsert_late", """
select o_orderkey, case when o_orderkey % 4 = 0 then 2 else 3 end::bigint as version,
       round(o_totalprice + case when o_orderkey % 4 = 0 then 2 else 3 end, 2) price from orders""")
def stream_upsert_late(spark, sf_dir) -> DataFrame:
    """Three micro-batches over a table in partitions: keys come again and again, some twice in a batch, and for many the newest
    row comes first and older ones late."""
    orders = table(spark, sf_dir, "orders")
    versions = orders.select("o_orderkey", "o_totalprice", F.explode(F.sequence(F.lit(1), F.when(F.col("o_orderkey") % 4 == 0, 2).otherwise(3))).alias("version"))
    rows = versions.select("o_orderkey", F.col("version").cast("bigint").alias("version"), F.round(F.col("o_totalprice") + F.col("version"), 2).alias("price"))
    folder, state, schema = scratch_path(spark, "arriving"), scratch_path(spark, "stream-state"), rows.schema
    store = KeyedTable(spark, scratch_name(spark, "late_features"), parts=8)
    store.create(schema, ["o_orderkey"]).merge(rows.filter("version = 1 AND o_orderkey % 3 = 0"))
    for i in range(3):
        due = F.when(F.col("o_orderkey") % 5 == 0, 0).otherwise((F.col("o_orderkey") + F.col("version")) % 3)  # a fifth all at once
        rows.filter(due == i).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        jobs.stream_upsert(stream, store, lambda batch: batch, order=["version"], checkpoint=state).awaitTermination()
    return store.read()


@query("stream_score", f"with {LOG} select event_id, ts, prediction, score from log")
def stream_score(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "stream-score")
    scored = jobs.stream_score(event_stream(spark, sf_dir), prepare_log).select("event_id", "ts", "prediction", "score")
    jobs.append_to(scored, path).awaitTermination()
    return spark.read.parquet(path)
