"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "keelson", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; ``conf`` entries win over the defaults.

    Dots in option names are written as double underscores
    (``spark__sql__shuffle__partitions="8"``).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables that every executor can reach.

    ``spark.checkpoint.dir`` names it. A local session without that setting gets a
    temporary folder; a cluster session without it is refused, because a machine-local
    folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="keelson-")
    spark.conf.set("spark.checkpoint.dir", folder)
    context.setCheckpointDir(folder)
    _delete_on_exit(spark, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/keelson/{label}-{uuid.uuid4().hex}"
    _delete_on_exit(spark, path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For frames that several jobs read: they then see the same rows without computing
    them again, and a lost executor loses nothing. The rows are written when this is called, also by functions that return a
    frame, and stay until the session's JVM ends; :func:`staging` is for results that are consumed at once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like :func:`staged`, removed at the end of the block."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; a missing one is fine."""
    filesystem, jvm_path = _filesystem(spark, path)
    filesystem.delete(jvm_path, True)


def require_lasting_tables(spark: SparkSession) -> None:
    """Refuse a cluster session whose tables would vanish with it or with a machine.

    Feature tables, registry and log are catalog tables: on a cluster they need a catalog of their
    own (``spark.sql.catalogImplementation``) and a stated warehouse folder that executors share.
    """
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        return
    if spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory":
        raise RuntimeError("the catalog is in-memory: tables would vanish with the session")
    warehouse = spark.sparkContext.getConf().get("spark.sql.warehouse.dir", "")
    if not warehouse:
        raise RuntimeError("set spark.sql.warehouse.dir to a folder all executors share")


def is_folder(spark: SparkSession, path: str) -> bool:
    filesystem, jvm_path = _filesystem(spark, path)
    return filesystem.getFileStatus(jvm_path).isDirectory()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders directly below a folder."""
    filesystem, jvm_path = _filesystem(spark, path)
    return [f.getPath().getName() for f in filesystem.listStatus(jvm_path) if f.isDirectory()]


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    filesystem, jvm_path = _filesystem(spark, path)
    filesystem.deleteOnExit(jvm_path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
