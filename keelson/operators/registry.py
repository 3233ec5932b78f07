"""Searches and updates over model-metadata frames.

Frames follow :mod:`keelson.sources.model_tables`. Updates return the rows to write;
the caller merges them into the keyed table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.sources.tables import insert_missing, upsert

CHAMPION = "Champion"
CHALLENGER = "Challenger"


# --- experiments and runs -----------------------------------------------------

def search_experiments(experiments: DataFrame, pattern: str) -> DataFrame:
    """Experiments whose name matches a LIKE pattern."""
    return experiments.filter(F.col("name").like(pattern))


def latest_experiment(experiments: DataFrame, pattern: str = "%") -> DataFrame:
    """The experiment updated last; ties go to the smallest id."""
    found = search_experiments(experiments, pattern)
    return found.orderBy(F.col("last_update_time").desc_nulls_last(), "experiment_id").limit(1)


def runs_by_tag(runs: DataFrame, key: str, value: str) -> DataFrame:
    """Runs with a tag value."""
    return runs.filter(F.try_element_at("tags", F.lit(key)) == F.lit(value))


def finished(runs: DataFrame) -> DataFrame:
    """P13."""
    return runs.filter(F.col("status") == "FINISHED")


def metric(name: str) -> Column:
    return F.try_element_at("metrics", F.lit(name))


def best_run(runs: DataFrame, by: str = "val_f1_score") -> DataFrame:
    """The finished run with the highest metric; ties go to the smallest run id."""
    return finished(runs).orderBy(metric(by).desc_nulls_last(), "run_id").limit(1)


def best_run_per_experiment(runs: DataFrame, by: str = "val_f1_score") -> DataFrame:
    """T2 for every experiment at once; runs without the metric are left out."""
    scored = finished(runs).select("experiment_id", "run_id", metric(by).alias("value"))
    order = F.struct((-F.col("value")).alias("loss"), "run_id")
    best = scored.filter(F.col("value").isNotNull()).groupBy("experiment_id").agg(F.min(order).alias("b"))
    return best.select("experiment_id", "b.run_id", (-F.col("b.loss")).alias("value"))


def best_trial(trials: DataFrame, loss: str = "loss", key: str = "trial_id") -> DataFrame:
    """The trial with the smallest loss. A score to maximise enters as its negative."""
    return trials.orderBy(F.col(loss).asc_nulls_last(), key).limit(1)


# --- tags ---------------------------------------------------------------------

def latest_tags(log: DataFrame, entity: Sequence[str], key: str = "key", value: str = "value", ts: str = "ts") -> DataFrame:
    """Last write wins per entity and key; equal times go to the greatest value."""
    last = log.groupBy(*entity, key).agg(F.max(F.struct(ts, value)).alias("_last"))
    return last.select(*entity, key, F.col(f"_last.{value}").alias(value), F.col(f"_last.{ts}").alias(ts))


def tags_map(latest: DataFrame, entity: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    """The tags of an entity as one map, keys sorted. Input holds a key once per
    entity, so a map is as long as the list of tag names, not as the log."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))))
    return latest.groupBy(*entity).agg(F.map_from_entries(entries).alias("tags"))


def set_run_tags(runs: DataFrame, tags: DataFrame) -> DataFrame:
    """R1 for runs: the changed rows of ``runs`` after setting ``tags`` (``run_id, tags``, a row per run): a new value
    replaces one of the same key, other tags stay. Unknown runs give no row."""
    new = tags.select("run_id", F.col("tags").alias("_new"))
    old = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    stays = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys("_new"), k))
    return runs.join(new, "run_id").withColumn("tags", F.map_concat(stays, "_new")).select(*runs.columns)


# --- versions and aliases -----------------------------------------------------

def next_version(names: DataFrame, versions: DataFrame) -> DataFrame:
    """The version number the next registration of each name gets."""
    last = versions.groupBy("name").agg(F.max("version").alias("_last"))
    return names.select("name").distinct().join(last, "name", "left").select(
        "name", (F.coalesce(F.col("_last"), F.lit(0)) + F.lit(1)).cast("int").alias("version")
    )


def register(candidates: DataFrame, versions: DataFrame) -> DataFrame:
    """R2: version rows for candidates (one per name: ``name, run_id, source, description, signature``)."""
    numbered = candidates.join(next_version(candidates, versions), "name")
    return numbered.select(*versions.columns)


def set_alias(aliases: DataFrame, updates: DataFrame) -> DataFrame:
    """One version per (name, alias)."""
    return upsert(aliases, updates.select("name", "alias", "version"), ["name", "alias"])


def describe(versions: DataFrame, updates: DataFrame) -> DataFrame:
    """Replace the description of (name, version) rows; other rows stay."""
    new = updates.select("name", "version", F.col("description").alias("_new"))
    joined = versions.join(new, ["name", "version"], "left")
    return joined.withColumn("description", F.coalesce("_new", "description")).select(*versions.columns)


def describe_models(models: DataFrame, updates: DataFrame) -> DataFrame:
    """Replace the description of registered models by name; other models stay."""
    joined = models.join(updates.select("name", F.col("description").alias("_new")), "name", "left")
    return joined.withColumn("description", F.coalesce("_new", "description")).select(*models.columns)


def resolve_alias(
    aliases: DataFrame, versions: DataFrame, runs: DataFrame, alias: str = CHALLENGER
) -> DataFrame:
    """Alias to version to originating run."""
    pointed = aliases.filter(F.col("alias") == alias)
    return pointed.join(versions, ["name", "version"]).join(runs, "run_id", "left")


def champion_or_none(names: DataFrame, aliases: DataFrame, alias: str = CHAMPION) -> DataFrame:
    """Every name with its champion version, NULL where there is none."""
    champions = aliases.filter(F.col("alias") == alias).select("name", "version")
    return names.join(champions, "name", "left").withColumn("has_champion", F.col("version").isNotNull())


def missing_names(destination: DataFrame, source: DataFrame) -> DataFrame:
    """Names the destination has to create first."""
    return insert_missing(destination, source.select("name").distinct(), ["name"])


@dataclass
class Promotion:
    """Rows to merge after a promotion."""

    new_names: DataFrame
    versions: DataFrame
    tags: DataFrame | None
    source_aliases: DataFrame
    target_aliases: DataFrame


def promote(
    aliases: DataFrame, versions: DataFrame, target_versions: DataFrame, target_name: Column,
    gates: DataFrame | None = None, challenger: str = CHALLENGER, champion: str = CHAMPION,
    tags: DataFrame | None = None,
) -> Promotion:
    """Copy the challenger of every name to the target and make it champion in both places.

    ``target_name`` maps the source name to the target name; sources that share a target get
    versions one after another, and the last is its champion. With ``gates`` (``name,
    version, passed``) only versions that passed are promoted. The latest ``tags`` (``name,
    version, key, value, ts``) of a version go with it.
    """
    chosen = aliases.filter(F.col("alias") == challenger).join(versions, ["name", "version"])
    if gates is not None:
        passed = gates.filter(F.col("passed")).select("name", "version")
        chosen = chosen.join(passed, ["name", "version"], "left_semi")
    source = F.concat(F.lit("models:/"), F.col("name"), F.lit("/"), F.col("version").cast("string"))
    copies = chosen.select(
        target_name.alias("name"), "run_id", source.alias("source"), "description", "signature",
        F.col("name").alias("from_name"), F.col("version").alias("from_version"),
    )
    place = F.row_number().over(W.partitionBy("name").orderBy("from_name", "from_version")) - 1
    numbered = copies.join(next_version(copies.select("name").distinct(), target_versions), "name").withColumn(
        "version", (F.col("version") + place).cast("int"))
    copied = None
    if tags is not None:
        copied = numbered.select("from_name", "from_version", "name", "version").join(
            tags.select(F.col("name").alias("from_name"), F.col("version").alias("from_version"), "key", "value", "ts"),
            ["from_name", "from_version"]).select("name", "version", "key", "value", "ts")
    return Promotion(
        new_names=missing_names(target_versions.select("name"), copies),
        versions=numbered,
        tags=copied,
        source_aliases=chosen.select("name", F.lit(champion).alias("alias"), "version"),
        target_aliases=numbered.groupBy("name").agg(F.lit(champion).alias("alias"), F.max("version").alias("version")),
    )
