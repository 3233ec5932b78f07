"""Keyed tables whose files are clustered by key, so that a merge rewrites only the files it has to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.text import quote_name
from keelson.session import child_folders, delete_path, staging
from keelson.sources.tables import KEY_PROPERTY, NEWER, SEPARATOR, KeyedTable, align, drop_table, latest_per_key, upsert

FILE = "_file"
ROWS_PROPERTY = "keelson.rows_per_file"
FEW_KEYS = 1000
LISTED = 500  # partitions per statement


class ClusteredTable(KeyedTable):
    """A versioned table with one row per key, in files of about ``rows_per_file`` rows that are ranges of the key.

    A file is a partition of its own, named after the version that wrote it, which says where it lies. A merge finds
    the files that hold a key of its update by a semi-join on the key columns, with the update's range (and, of few keys,
    the keys themselves) pushed down to the files' statistics and Bloom filters. It writes their rows and the new keys
    to new files and takes every other file over by its location. So a merge writes in proportion to the files its
    keys lie in: few for an update of neighbouring keys, all for one spread over the whole range.
    """

    def __init__(self, spark: SparkSession, name: str, rows_per_file: int = 1_000_000):
        super().__init__(spark, name)
        self._rows_per_file = rows_per_file

    def rows_per_file(self) -> int:
        stored = self._properties(self.name).get(ROWS_PROPERTY) if self.exists() else None
        return int(stored) if stored else self._rows_per_file

    def create(self, schema: T.StructType, keys: Sequence[str], description: str = "", replace: bool = False) -> ClusteredTable:
        """Create the empty table unless it exists; ``replace`` starts afresh."""
        if self.exists() and not replace:
            return self
        unknown = [k for k in keys if k not in schema.names]
        if unknown:
            raise ValueError(f"key columns {unknown} are not in the schema")
        version = self._new_name()
        self._register(schema, version, [])
        self._show(version, schema.names, keys, self._rows_per_file, description)
        if replace:
            self.vacuum()
        return self

    def files(self, version: str | None = None) -> list[str]:
        """The names of the files of a version, the current one by default."""
        quoted = quote_name(*(version or self.current_version()).split("."))
        return [r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {quoted}").collect()]

    def merge(self, updates: DataFrame, on_duplicate: str = "fail", order: Sequence[str] = ()) -> None:
        """Upsert ``updates``, as :meth:`KeyedTable.merge` does."""
        keys, old = self.keys(), self.current_version()
        schema = self.read().schema
        with staging(align(updates, schema), "merge") as rows:
            if on_duplicate != "latest":
                self._check(rows, keys)
            n = rows.count()
            if not n:
                return
            touched = self.touched(rows)
            base = self.spark.table(old).where(F.col(FILE).isin(touched)) if touched else self.spark.table(old).limit(0)
            if on_duplicate == "latest":
                stored = base.drop(FILE).join(rows.select(*keys).distinct(), keys, "left_semi")
                both = stored.withColumn(NEWER, F.lit(0)).unionByName(rows.withColumn(NEWER, F.lit(1)))
                rows = latest_per_key(both, keys, [*order, NEWER]).drop(NEWER)
            self._rewrite(upsert(base.drop(FILE), rows, keys), base.count() + n, [f for f in self.files(old) if f not in set(touched)])

    def recluster(self) -> None:
        """Write all rows anew as disjoint ranges, after many merges have left small or overlapping files."""
        current = self.read()
        self._rewrite(current, current.count(), [])

    def touched(self, rows: DataFrame) -> list[str]:
        """The files that hold a key of ``rows``: names only, at most one per file."""
        keys = self.keys()
        base = self.spark.table(self.current_version()).select(*keys, FILE)
        for key in keys:
            low, high = rows.agg(F.min(key), F.max(key)).first()
            if low is None:
                return []
            base = base.where(F.col(quote_name(key)).between(F.lit(low), F.lit(high)))
        first = [r[0] for r in rows.select(keys[0]).distinct().limit(FEW_KEYS + 1).collect()]
        setting = "spark.sql.parquet.pushdown.inFilterThreshold"
        before = self.spark.conf.get(setting)
        try:
            if len(first) <= FEW_KEYS:  # few enough to be asked for one by one
                self.spark.conf.set(setting, str(FEW_KEYS))
                base = base.where(F.col(quote_name(keys[0])).isin(first))
            return sorted(r[0] for r in base.join(rows.select(*keys), keys, "left_semi").select(FILE).distinct().collect())
        finally:
            self.spark.conf.set(setting, before)

    def _rewrite(self, merged: DataFrame, rows: int, kept: Sequence[str]) -> None:
        keys, size, version = self.keys(), self.rows_per_file(), self._new_name()
        ranges = [F.col(quote_name(k)) for k in keys]
        name = F.concat(F.lit(version.rsplit(SEPARATOR, 1)[1] + "-"), F.spark_partition_id().cast("string"))
        placed = merged.repartitionByRange(max(1, -(-rows // size)), *ranges).withColumn(FILE, name).sortWithinPartitions(FILE, *ranges)
        writer = placed.write.mode("errorifexists").partitionBy(FILE)
        for key in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(size))
        writer.parquet(self._root(version))
        written = [f.split("=", 1)[1] for f in child_folders(self.spark, self._root(version)) if f.startswith(f"{FILE}=")]
        self._register(merged.schema, version, [*kept, *written])
        self._show(version, merged.columns, keys, size, self.description() or "")

    def _register(self, schema: T.StructType, version: str, files: Sequence[str]) -> None:
        columns = ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in schema)
        quoted = quote_name(*version.split("."))
        self.spark.sql(f"CREATE TABLE {quoted} ({columns}, {FILE} STRING) USING parquet PARTITIONED BY ({FILE}) LOCATION '{self._root(version)}'")
        for low in range(0, len(files), LISTED):
            listed = " ".join(f"PARTITION ({FILE}='{f}') LOCATION '{self._path(f)}'" for f in files[low:low + LISTED])
            self.spark.sql(f"ALTER TABLE {quoted} ADD {listed}")

    def _path(self, file: str) -> str:
        """Where a file lies follows from its name."""
        return f"{self._root(self.name + SEPARATOR + file.split('-', 1)[0])}/{FILE}={file}"

    def _show(self, version: str, columns: Sequence[str], keys: Sequence[str], rows_per_file: int, description: str) -> None:
        properties = {KEY_PROPERTY: ",".join(keys), ROWS_PROPERTY: str(rows_per_file)}
        self._move_view(version, properties, description, ", ".join(quote_name(c) for c in columns))

    def _drop_versions(self, versions: Sequence[str]) -> None:
        """Files of a dropped version go only if no version that stays names them."""
        gone = {f for v in versions for f in self.files(v)}
        in_use = {f for v in self.versions() if v not in versions for f in self.files(v)} if versions else set()
        for version in versions:
            drop_table(self.spark, version)
        for file in sorted(gone - in_use):
            delete_path(self.spark, self._path(file))
