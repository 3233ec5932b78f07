"""Registered queries: runs, registry tables, gates and promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.text import tag_lookup
from keelson.operators import gates as G
from keelson.operators import metrics as M
from keelson.operators import registry as R
from keelson.operators.score import predicts
from keelson.plans.derived import (
    ALIASES,
    RUNS,
    VERSIONS,
    model_aliases,
    model_versions,
    runs,
)
from keelson.plans.registry import flag, query, table
from keelson.plans.table_queries import fresh_database
from keelson.sources.model_tables import open_table, scan_runs


def _flat(df: DataFrame) -> DataFrame:
    return df.select(
        "run_id", "experiment_id", "status", R.metric("val_f1_score").alias("val_f1_score"),
        R.metric("test_f1_score").alias("test_f1_score"), tag_lookup("tags", "source").alias("source"),
    )


@query("runs_scan", f"""
with {RUNS} select run_id, experiment_id, status, val_f1_score, test_f1_score, source from runs""")
def runs_scan(spark, sf_dir) -> DataFrame:
    """Runs written to their keyed table and read back as a source."""
    database = fresh_database(spark)
    found, store = runs(spark, sf_dir), open_table(spark, "runs", database)
    store.merge(found.select(store.read().columns))
    return _flat(scan_runs(spark, database))


@query("run_tags_set", f"""
with {RUNS}
select run_id, case when status = 'FAILED' then 'checked' else source end source, owner,
       case when status = 'FAILED' then 'yes' end reviewed from runs""")
def run_tags_set(spark, sf_dir) -> DataFrame:
    """Tags set on recorded runs: one replaces the old value, one is new, the others stay."""
    database = fresh_database(spark)
    found, store = runs(spark, sf_dir), open_table(spark, "runs", database)
    store.merge(found.select(store.read().columns))
    tags = F.create_map(F.lit("source"), F.lit("checked"), F.lit("reviewed"), F.lit("yes"))
    failed = found.filter("status = 'FAILED'").select("run_id", tags.alias("tags"))
    store.merge(R.set_run_tags(scan_runs(spark, database), failed))
    return scan_runs(spark, database).select("run_id", *[F.try_element_at("tags", F.lit(t)).alias(t) for t in ("source", "owner", "reviewed")])


@query("runs_by_tag", f"""
with {RUNS} select run_id, experiment_id, status, val_f1_score, test_f1_score, source from runs
where source = '2-HIGH'""")
def runs_by_tag(spark, sf_dir) -> DataFrame:
    return _flat(R.runs_by_tag(runs(spark, sf_dir), "source", "2-HIGH"))


@query("best_run", f"""
with {RUNS} select run_id, val_f1_score from runs where status = 'FINISHED'
order by val_f1_score desc nulls last, run_id limit 1""")
def best_run(spark, sf_dir) -> DataFrame:
    return _flat(R.best_run(runs(spark, sf_dir))).select("run_id", "val_f1_score")


@query("best_run_per_experiment", f"""
with {RUNS}, f as (select *, row_number() over (partition by experiment_id order by val_f1_score desc, run_id) rn
                   from runs where status = 'FINISHED' and val_f1_score is not null)
select experiment_id, run_id, val_f1_score as value from f where rn = 1""")
def best_run_per_experiment(spark, sf_dir) -> DataFrame:
    return R.best_run_per_experiment(runs(spark, sf_dir))


@query("best_trial", f"""
with {RUNS} select run_id, round(-val_f1_score, 6) loss from runs where val_f1_score is not null
order by loss, run_id limit 1""")
def best_trial(spark, sf_dir) -> DataFrame:
    trials = _flat(runs(spark, sf_dir)).filter("val_f1_score is not null")
    return R.best_trial(trials.select("run_id", F.round(-F.col("val_f1_score"), 6).alias("loss")), key="run_id")


def _experiments(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("exp-"), "o_orderkey").alias("experiment_id"),
        F.concat(F.lit("/"), "o_orderpriority", F.lit("/"), "o_orderstatus").alias("name"),
        F.col("o_orderdate").alias("last_update_time"),
    )


@query("latest_experiment", """
select 'exp-' || o_orderkey experiment_id, '/' || o_orderpriority || '/' || o_orderstatus as name,
       o_orderdate last_update_time
from orders where o_orderpriority = '1-URGENT' order by o_orderdate desc, 'exp-' || o_orderkey limit 1""")
def latest_experiment(spark, sf_dir) -> DataFrame:
    return R.latest_experiment(_experiments(spark, sf_dir), "/1-URGENT/%")


@query("experiment_search", """
select p_partkey experiment_id, '/' || p_type || '/' || p_name as name from part
where '/' || p_type || '/' || p_name like '/PROMO/red%'""")
def experiment_search(spark, sf_dir) -> DataFrame:
    named = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("experiment_id"), F.concat(F.lit("/"), "p_type", F.lit("/"), "p_name").alias("name")
    )
    return R.search_experiments(named, "/PROMO/red%")


# --- tags ---------------------------------------------------------------------

LAST_TAGS = """
last as (select user_id, event_type as key, props as value, ts,
                row_number() over (partition by user_id, event_type order by ts desc, props desc) rn from events)"""


def _tag_log(spark, sf_dir) -> DataFrame:
    """Events as a log of tag writes: the type is the tag, the properties its value."""
    return table(spark, sf_dir, "events").select(
        "user_id", F.col("event_type").alias("key"), F.col("props").alias("value"), "ts"
    )


@query("latest_tags", f"with {LAST_TAGS} select user_id, key, value, ts from last where rn = 1")
def latest_tags(spark, sf_dir) -> DataFrame:
    return R.latest_tags(_tag_log(spark, sf_dir), ["user_id"])


@query("tags_map", f"""
with {LAST_TAGS} select user_id, count(*) n_tags, string_agg(key || '=' || value, ';' order by key) tags
from last where rn = 1 group by 1""")
def tags_map(spark, sf_dir) -> DataFrame:
    """The map is printed as text, keys sorted."""
    mapped = R.tags_map(R.latest_tags(_tag_log(spark, sf_dir), ["user_id"]), ["user_id"])
    text = F.array_join(F.transform(
        F.map_entries("tags"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return mapped.select("user_id", F.size("tags").cast("bigint").alias("n_tags"), text.alias("tags"))


# --- versions, aliases, promotion -----------------------------------------------

@query("next_version", f"""
with {VERSIONS}, closed as (select name, max(version) last from versions where stage = 'F' group by 1)
select 'model-' || c_custkey as name, (coalesce(last, 0) + 1)::int as version
from customer left join closed on name = 'model-' || c_custkey""")
def next_version(spark, sf_dir) -> DataFrame:
    names = table(spark, sf_dir, "customer").select(F.concat(F.lit("model-"), "c_custkey").alias("name"))
    return R.next_version(names, model_versions(spark, sf_dir).filter("stage = 'F'"))


@query("register_versions", f"""
with {VERSIONS}, {ALIASES},
closed as (select name, max(version) last from versions where stage = 'F' group by 1)
select v.name, (coalesce(last, 0) + 1)::int as version, run_id, source, description, v.n_inputs
from versions v join aliases a on a.name = v.name and a.version = v.version and alias = 'Challenger'
left join closed on closed.name = v.name""")
def register_versions(spark, sf_dir) -> DataFrame:
    """The newest open version of each model is registered behind the closed ones."""
    versions = model_versions(spark, sf_dir)
    newest = model_aliases(versions).filter("alias = 'Challenger'").drop("alias")
    fields = ["name", "version", "run_id", "source", "description", "signature"]
    candidates = versions.join(newest, ["name", "version"]).drop("version")
    registered = R.register(candidates, versions.filter("stage = 'F'").select(fields))
    return registered.select(*fields[:-1], _inputs())


def _inputs() -> F.Column:
    return F.size(F.coalesce("signature", F.array())).cast("bigint").alias("n_inputs")


@query("resolve_alias", f"""
with {VERSIONS}, {ALIASES}, {RUNS}
select a.name, a.version, v.run_id, v.source, r.status, r.val_f1_score
from aliases a join versions v using (name, version) left join runs r on r.run_id = v.run_id
where alias = 'Challenger'""")
def resolve_alias(spark, sf_dir) -> DataFrame:
    versions = model_versions(spark, sf_dir)
    found = R.resolve_alias(model_aliases(versions), versions, runs(spark, sf_dir))
    return found.select("name", "version", "run_id", "source", "status", R.metric("val_f1_score").alias("val_f1_score"))


@query("champion_or_none", f"""
with {VERSIONS}, {ALIASES}
select 'model-' || c_custkey as name, version, version is not null has_champion
from customer left join (select * from aliases where alias = 'Champion') a on a.name = 'model-' || c_custkey""")
def champion_or_none(spark, sf_dir) -> DataFrame:
    names = table(spark, sf_dir, "customer").select(F.concat(F.lit("model-"), "c_custkey").alias("name"))
    return R.champion_or_none(names, model_aliases(model_versions(spark, sf_dir)))


@query("missing_in_prod", """
select 'model-' || c_custkey as name from customer
where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT' and o_totalprice > 250000)""")
def missing_in_prod(spark, sf_dir) -> DataFrame:
    """Names with an urgent large order exist in the destination."""
    names = table(spark, sf_dir, "customer").select(F.concat(F.lit("model-"), "c_custkey").alias("name"))
    there = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT' and o_totalprice > 250000")
    return R.missing_names(there.select(F.concat(F.lit("model-"), "o_custkey").alias("name")), names)


@query("alias_upsert", f"""
with {VERSIONS}, {ALIASES}, upd as (select name, 'Champion' alias, max(version) as version from versions group by 1)
select name, alias, version from upd
union all select name, alias, version from aliases where (name, alias) not in (select (name, alias) from upd)""")
def alias_upsert(spark, sf_dir) -> DataFrame:
    """The champion moves to the newest version; challengers stay."""
    versions = model_versions(spark, sf_dir)
    newest = versions.groupBy("name").agg(F.max("version").alias("version"))
    return R.set_alias(model_aliases(versions), newest.withColumn("alias", F.lit("Champion")))


@query("describe_versions", f"""
with {VERSIONS}
select name, version, case when stage = 'P' then 'pending review' else description end description from versions""")
def describe_versions(spark, sf_dir) -> DataFrame:
    versions = model_versions(spark, sf_dir)
    updates = versions.filter("stage = 'P'").select("name", "version", F.lit("pending review").alias("description"))
    return R.describe(versions, updates).select("name", "version", "description")


@query("describe_models", f"""
with {VERSIONS}
select name, case when max(stage) = 'P' then 'has pending versions' else min(description) end description from versions group by 1""")
def describe_models(spark, sf_dir) -> DataFrame:
    """Models with a pending version get a new description."""
    versions = model_versions(spark, sf_dir)
    models = versions.groupBy("name").agg(F.min("description").alias("description"))
    pending = versions.filter("stage = 'P'").select("name", F.lit("has pending versions").alias("description")).distinct()
    return R.describe_models(models, pending)


PROMOTED = """
prod as (select 'prod.' || name as name, max(version) last from versions where stage = 'P' group by 1),
chosen as (select v.* from versions v join aliases a on a.name = v.name and a.version = v.version
           where alias = 'Challenger'),
copies as (select 'prod.' || c.name as name, (coalesce(last, 0) + 1)::int as version, run_id,
                  'models:/' || c.name || '/' || c.version source, description,
                  c.name from_name, c.version from_version
           from chosen c left join prod on prod.name = 'prod.' || c.name)"""


def _promotion(spark, sf_dir, gates: DataFrame | None = None, tags: DataFrame | None = None) -> R.Promotion:
    versions = model_versions(spark, sf_dir)
    target = versions.filter("stage = 'P'").withColumn("name", F.concat(F.lit("prod."), "name"))
    return R.promote(model_aliases(versions), versions, target, F.concat(F.lit("prod."), "name"), gates, tags=tags)


@query("promote", f"""
with {VERSIONS}, {ALIASES}, {PROMOTED}
select name, version, run_id, source, description, from_name, from_version from copies""")
def promote(spark, sf_dir) -> DataFrame:
    copies = _promotion(spark, sf_dir).versions
    return copies.select("name", "version", "run_id", "source", "description", "from_name", "from_version")


@query("promote_tags", f"""
with {VERSIONS}, {ALIASES}, {PROMOTED}
select name, version, 'run' "key", run_id "value" from copies""")
def promote_tags(spark, sf_dir) -> DataFrame:
    """A version's tags go to the target with it."""
    versions = model_versions(spark, sf_dir)
    tags = versions.select("name", "version", F.lit("run").alias("key"), F.col("run_id").alias("value"),
                           F.lit("2026-01-01").cast("timestamp").alias("ts"))
    return _promotion(spark, sf_dir, tags=tags).tags.select("name", "version", "key", "value")


@query("create_models", f"""
with {VERSIONS}, {ALIASES}, {PROMOTED}
select distinct name from copies where name not in (select name from prod)""")
def create_models(spark, sf_dir) -> DataFrame:
    """The names a promotion has to create in the target."""
    return _promotion(spark, sf_dir).new_names


@query("predicts_all", """
select (count(*) = count(o_totalprice))::int whole, (count(*) = count(nullif(o_orderstatus, 'P')))::int gap from orders""")
def predicts_all(spark, sf_dir) -> DataFrame:
    """M4 over all rows: one model answers everywhere, one leaves NULLs."""
    orders = table(spark, sf_dir, "orders")
    gap = F.when(F.col("o_orderstatus") != "P", F.lit(1))
    return spark.createDataFrame([(predicts(orders, [], F.col("o_totalprice")), predicts(orders, [], gap))], "whole int, gap int")


@query("promote_aliases", f"""
with {VERSIONS}, {ALIASES}, {PROMOTED}
select name, 'Champion' alias, version from copies union all select from_name, 'Champion', from_version from copies""")
def promote_aliases(spark, sf_dir) -> DataFrame:
    done = _promotion(spark, sf_dir)
    return done.target_aliases.unionByName(done.source_aliases)


# --- gates --------------------------------------------------------------------

def _line_evidence(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Predictions, slices and artifacts of every version, read off its order's lines."""
    versions = model_versions(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", flag(F.col("l_discount") < 0.1).alias("predicts"),
        flag(F.col("l_quantity") > 10).alias("prediction"), flag(F.col("l_tax") > 0.01).alias("label"), "l_linenumber",
    )
    keyed = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("model-"), "o_custkey").alias("name"),
        (F.col("o_orderkey") + 1).cast("int").alias("version"),
    )
    evidence = lines.join(keyed, F.col("l_orderkey") == F.col("o_orderkey"))
    slices = M.slice_accuracy(evidence, ["name", "version", "l_returnflag"])
    return versions, evidence.select("name", "version", "predicts"), slices, evidence.filter("l_linenumber > 3")


GATES = """
lines as (select l_orderkey, l_returnflag, case when l_discount < 0.1 then 1 else 0 end predicts,
                 case when (l_quantity > 10) = (l_tax > 0.01) then 1.0 else 0.0 end hit, l_linenumber from lineitem),
slices as (select l_orderkey, l_returnflag, avg(hit) a from lines group by 1, 2),
tested as (select l_orderkey, case when min(a) > 0.55 then 'pass' else 'fail' end demo_test from slices group by 1),
evidence as (select l_orderkey, min(predicts) predicts, max(case when l_linenumber > 3 then 1 else 0 end) has_artifacts
             from lines group by 1),
report as (
  select name, version, coalesce(predicts, 0)::int predicts, case when n_inputs > 0 then 1 else 0 end has_signature,
         coalesce(demo_test, 'none') demo_test,
         case when length(description) > 20 then 1 else 0 end has_description,
         coalesce(has_artifacts, 0)::int has_artifacts
  from versions left join evidence e on e.l_orderkey = version - 1 left join tested t on t.l_orderkey = version - 1)"""
PASSED = "predicts = 1 and has_signature = 1 and demo_test = 'pass' and has_description = 1 and has_artifacts = 1"


@query("gate_report", f"with {VERSIONS}, {GATES} select *, {PASSED} passed from report")
def gate_report(spark, sf_dir) -> DataFrame:
    return G.gate_report(*_line_evidence(spark, sf_dir))


@query("signature_gate", f"""
with {VERSIONS}, {GATES},
fits as (select l_orderkey from lineitem group by 1 having count(distinct l_linenumber) = 3 and max(l_linenumber) = 3)
select report.*, case when f.l_orderkey is null then 0 else 1 end signature_matches, {PASSED} and f.l_orderkey is not null passed
from report left join fits f on f.l_orderkey = version - 1""")
def signature_gate(spark, sf_dir) -> DataFrame:
    """The stored inputs of every version against a table of three lines: one more gate."""
    evidence = _line_evidence(spark, sf_dir)
    versions = evidence[0]
    declared = versions.select("name", "version", F.explode("signature").alias("f")).select(
        F.col("name").alias("model"), "version", "f.name", "f.type")
    wanted = F.array(*[F.struct(F.lit(f"line_{i}").alias("name"), F.lit("double").alias("type")) for i in (1, 2, 3)])
    present = versions.select(F.col("name").alias("model"), "version", F.inline(wanted))
    changes = G.signature_diff(declared, present, ["model", "version"]).select(F.col("model").alias("name"), "version", "change")
    return G.gate_report(*evidence, changes=changes)


@query("promote_gated", f"""
with {VERSIONS}, {ALIASES}, {PROMOTED}, {GATES}
select copies.name, copies.version, from_name, from_version from copies
join report r on r.name = from_name and r.version = from_version where {PASSED}""")
def promote_gated(spark, sf_dir) -> DataFrame:
    """Promotion blocked for versions that failed a gate."""
    report = G.gate_report(*_line_evidence(spark, sf_dir))
    return _promotion(spark, sf_dir, report).versions.select("name", "version", "from_name", "from_version")


SIGNATURES = """
signatures as (select distinct o_custkey, o_orderstatus stage, 'line_' || l_linenumber as name,
                 max(l_returnflag) over (partition by o_custkey, o_orderstatus, l_linenumber) as type
               from orders join lineitem on o_orderkey = l_orderkey)"""


@query("signature_diff", f"""
with {SIGNATURES}
select coalesce(o.o_custkey, n.o_custkey) o_custkey, coalesce(o.name, n.name) as name, o.type old_type, n.type new_type,
       case when o.type is null then 'added' when n.type is null then 'removed' else 'retyped' end change
from (select * from signatures where stage = 'F') o full join (select * from signatures where stage = 'O') n
  on o.o_custkey = n.o_custkey and o.name = n.name
where o.type is distinct from n.type""")
def signature_diff(spark, sf_dir) -> DataFrame:
    """Inputs of a customer's closed orders against those of the open ones."""
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    signatures = joined.groupBy(
        "o_custkey", "o_orderstatus", F.concat(F.lit("line_"), "l_linenumber").alias("name")
    ).agg(F.max("l_returnflag").alias("type"))
    old, new = (signatures.filter(F.col("o_orderstatus") == s) for s in ("F", "O"))
    return G.signature_diff(old, new, ["o_custkey"])
