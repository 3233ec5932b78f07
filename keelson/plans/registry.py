"""The list of registered queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is checked by the tests only."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round doubles so that two engines agree on them."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def sql_bucket(key: str, salt: str = "", buckets: int | str = 100) -> str:
    """The SQL twin of :func:`keelson.functions.hashing.bucket`."""
    text = f"({key})::varchar"
    if salt:
        text = f"'{salt}'||{text}"
    return f"((('0x'||substr(md5({text}),1,7))::bigint)%{buckets})"


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
