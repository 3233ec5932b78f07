"""Logs in days and batches, and results that are recomputed only for the days that changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.text import quote_name
from keelson.session import staging
from keelson.sources.tables import KeyedTable, align, append

DAY, BATCH = "day", "batch"
MARKS = "consumer string, batch bigint"


class DailyLog:
    """An append-only table partitioned by day and batch.

    Every append is a batch of its own with a number above all others, so what came since a mark is known from
    the partitions alone, however late its rows are. Batches are numbered by one writer at a time.
    """

    def __init__(self, spark: SparkSession, name: str, ts: str):
        self.spark, self.name, self.ts = spark, name, ts

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def parts(self) -> DataFrame:
        """(day, batch) of every partition, from the catalog."""
        if not self.exists():
            return self.spark.createDataFrame([], f"{DAY} date, {BATCH} bigint")
        found = self.spark.sql(f"SHOW PARTITIONS {quote_name(*self.name.split('.'))}")
        day, batch = (F.regexp_extract("partition", f"{c}=([^/]*)", 1) for c in (DAY, BATCH))
        return found.select(F.to_date(day).alias(DAY), batch.cast("bigint").alias(BATCH))

    def last_batch(self) -> int:
        return self.parts().agg(F.max(BATCH)).first()[0] or 0

    def append(self, rows: DataFrame) -> int:
        """Append rows by name as one batch; returns its number. Rows without a time are refused."""
        number = self.last_batch() + 1
        placed = rows.withColumns({DAY: F.to_date(F.col(self.ts)), BATCH: F.lit(number).cast("bigint")})
        with staging(placed, "batch") as stored:
            if stored.where(F.col(DAY).isNull()).limit(1).count():
                raise ValueError(f"rows without {self.ts} have no day")
            if stored.isEmpty() and self.exists():
                return number - 1
            append(stored.repartition(DAY), self.name, partition_by=(DAY, BATCH))
        return number

    def read(self, upto: int | None = None) -> DataFrame:
        rows = self.spark.table(self.name)
        return rows if upto is None else rows.where(F.col(BATCH) <= upto)

    def days_between(self, after: int, upto: int) -> list[date]:
        """The days that batches after one mark and up to another have rows of: at most one entry per day."""
        new = self.parts().where((F.col(BATCH) > after) & (F.col(BATCH) <= upto))
        return [r[0] for r in new.select(DAY).distinct().orderBy(DAY).collect()]


def replace_days(df: DataFrame, name: str, by: Sequence[str] = (DAY,)) -> None:
    """Overwrite the partitions of a table that the rows lie in, and no others; the first call makes the table."""
    spark = df.sparkSession
    columns = [*[c for c in df.columns if c not in by], *by]
    if not spark.catalog.tableExists(name):
        df.select(*columns).write.partitionBy(*by).saveAsTable(name)
        return
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "dynamic")  # an insert by table name takes it from the session only
        align(df, spark.table(name).schema).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, before)


def refresh_days(log: DailyLog, consumer: str, marks: KeyedTable, compute: Callable[[DataFrame, list[date], int], None]) -> list[date]:
    """Call ``compute(rows, days, upto)`` for the days that batches since the consumer's mark brought rows of.

    ``rows`` are all rows of those days up to the last batch, old and late ones alike, read from these partitions only.
    The mark moves when ``compute`` has written its results, so a failed refresh is simply repeated; with results
    that replace whole days it then writes the same rows again. Returns the days.
    """
    spark = log.spark
    marks.create(T.StructType.fromDDL(MARKS), ["consumer"], "last batch that each consumer has taken in")
    known = marks.read().where(F.col("consumer") == consumer).first()
    upto = log.last_batch()
    days = log.days_between(known[BATCH] if known else 0, upto)
    if days:
        compute(log.read(upto).where(F.col(DAY).isin(days)), days, upto)
        marks.merge(spark.createDataFrame([(consumer, upto)], MARKS))
    return days
