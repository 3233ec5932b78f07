"""Incremental versions of the batch jobs with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keelson.operators.monitor import long_values, sketch_profile, sliced
from keelson.session import scratch_path
from keelson.sources.tables import KeyedTable


def stream_monitor(
    stream: DataFrame, columns: Sequence[str], ts: str, window: str, watermark: str,
    model: str | None = None, slices: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """ST1: the sketch profile per tumbling window; a window is emitted once it is closed.

    State holds one fixed-size row per open window, model, slice and column.
    """
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    timed = timed.withColumn("_span", F.window("_ts", window))
    keys = ["_span"]
    if model:
        timed = timed.withColumn("model_version", F.col(model).cast("string"))
        keys.append("model_version")
    if slices is not None:
        timed = sliced(timed, slices)
        keys.append("slice")
    profiled = sketch_profile(*long_values(timed, columns, keys))
    rest = [c for c in profiled.columns if c != "_span"]
    return profiled.select(
        F.col("_span.start").alias("window_start"), F.col("_span.end").alias("window_end"), *rest
    )


def stream_score(stream: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """ST3: scoring is row-wise, so the batch function serves the stream unchanged."""
    return score(stream)


def append_to(df: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Process what is available and append it to a Parquet folder, exactly once."""
    checkpoint = checkpoint or scratch_path(df.sparkSession, "stream-state")
    return (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_upsert(
    stream: DataFrame, table: KeyedTable, featurise: Callable[[DataFrame], DataFrame],
    order: Sequence[str], checkpoint: str | None = None,
) -> StreamingQuery:
    """ST2: featurise each micro-batch and merge it into a keyed table, latest row per key.

    A batch that is replayed after a failure merges to the same rows.
    """
    checkpoint = checkpoint or scratch_path(table.spark, "stream-state")

    def merge(batch: DataFrame, _: int) -> None:
        table.merge(featurise(batch), on_duplicate="latest", order=order)

    return (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
