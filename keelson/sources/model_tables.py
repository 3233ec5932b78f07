"""Model metadata as plain tables: experiments, runs, versions, aliases and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keelson.sources.tables import KeyedTable

SCHEMAS = {
    "experiments": "experiment_id string, name string, last_update_time timestamp",
    "runs": (
        "run_id string, experiment_id string, status string, metrics map<string,double>, "
        "params map<string,string>, tags map<string,string>"
    ),
    "model_versions": (
        "name string, version int, run_id string, source string, description string, "
        "signature array<struct<name:string,type:string>>"
    ),
    "model_aliases": "name string, alias string, version int",
    "registered_models": "name string, description string",
    "version_tags": "name string, version int, key string, value string, ts timestamp",
}
KEYS = {
    "experiments": ["experiment_id"],
    "runs": ["run_id"],
    "model_versions": ["name", "version"],
    "model_aliases": ["name", "alias"],
    "registered_models": ["name"],
    "version_tags": ["name", "version", "key"],
}


def open_table(spark: SparkSession, kind: str, database: str) -> KeyedTable:
    """The metadata table of a kind, created on first use."""
    schema = T._parse_datatype_string(SCHEMAS[kind])
    return KeyedTable(spark, f"{database}.{kind}").create(schema, KEYS[kind], f"model metadata: {kind}")


def scan_runs(spark: SparkSession, database: str, experiment_id: str | None = None) -> DataFrame:
    """Runs of one experiment or of all."""
    runs = open_table(spark, "runs", database).read()
    return runs.filter(runs.experiment_id == experiment_id) if experiment_id else runs
