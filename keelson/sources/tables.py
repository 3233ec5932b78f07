"""Scans, sinks and keyed tables on the stock Spark catalog."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.text import quote_name
from keelson.session import delete_path, staging

KEY_PROPERTY = "primary_key"
OWNER_PROPERTY = "keelson.table"
PIN_PROPERTY = "keelson.pinned"
PARTS_PROPERTY = "keelson.parts"
PLACES_PROPERTY = "keelson.places"
SEPARATOR = "__v"
PART, NEWER, SLICE = "_part", "_newer", "_slice"
TASK_ROWS = 250_000  # rows of a merge that one task sorts


# --- scans --------------------------------------------------------------------

def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan of a catalog table."""
    return spark.table(name)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3: scan of a Parquet file or folder."""
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header and a fixed schema; cells that do not parse become NULL."""
    return spark.read.schema(schema).csv(path, header=True, mode="PERMISSIVE")


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first rows under a stated order (top-k, no full sort)."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


# --- namespaces ---------------------------------------------------------------

def create_database(spark: SparkSession, name: str, use: bool = False) -> None:
    """Create a database when missing and optionally switch to it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_name(*name.split('.'))}")
    if use:
        spark.sql(f"USE {quote_name(*name.split('.'))}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {quote_name(*name.split('.'))} CASCADE")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table or view; a missing one is fine."""
    quoted = quote_name(*name.split("."))
    kinds = {t.tableType for t in _catalog_entries(spark, name)}
    spark.sql(f"DROP {'VIEW' if 'VIEW' in kinds else 'TABLE'} IF EXISTS {quoted}")


def list_catalogs(spark: SparkSession, without: Sequence[str] = ()) -> list[str]:
    """Catalog names, minus a reserved list."""
    return [c.name for c in spark.catalog.listCatalogs() if c.name not in without]


def _catalog_entries(spark: SparkSession, name: str):
    *database, table = name.split(".")
    where = ".".join(database) or spark.catalog.currentDatabase()
    if not spark.catalog.databaseExists(where):
        return []
    return [t for t in spark.catalog.listTables(where) if t.name.lower() == table.lower() and not t.isTemporary]


# --- sinks --------------------------------------------------------------------

def overwrite(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table, schema included."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, in table order and type; a missing or an extra name is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    extra = [c for c in df.columns if c not in schema.names]
    if missing or extra:
        raise ValueError(f"columns do not match the table: missing {missing}, unexpected {extra}")
    return df.select(*[F.col(quote_name(f.name)).cast(f.dataType).alias(f.name) for f in schema])


def append(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Append by name; the table is created by the first append."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df = align(df, spark.table(name).schema)
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def clone(spark: SparkSession, source: str, target: str) -> None:
    """Zero-copy clone: a view over the version of the source that is current now.

    A versioned table keeps its old versions, so the clone stays on the version it was
    taken from while the source moves on; over a plain table it follows the source.
    Does nothing when the target exists.
    """
    if spark.catalog.tableExists(target):
        return
    pinned = VersionedTable(spark, source).current_version() or source
    quoted = quote_name(*pinned.split("."))
    if pinned != source:
        spark.sql(f"ALTER TABLE {quoted} SET TBLPROPERTIES ('{PIN_PROPERTY}'='true')")
    columns = ", ".join(quote_name(c) for c in spark.table(source).columns)
    spark.sql(f"CREATE VIEW {quote_name(*target.split('.'))} AS SELECT {columns} FROM {quoted}")


# --- keys and upserts ---------------------------------------------------------

def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count."""
    broken = F.col("row_count") > 1
    for key in keys:
        broken = broken | F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(broken)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest under ``order``; combines map-side, so a hot key is cheap.

    Rows that tie on ``order`` are told apart by a hash of all columns, maps included.
    """
    others = [c for c in df.columns if c not in keys]
    comparable = [F.to_json(F.struct(quote_name(f.name))) for f in df.schema if f.name in others]
    rank = F.struct(*[F.col(quote_name(c)) for c in order], F.xxhash64(*comparable) if comparable else F.lit(0))
    row = F.struct(*[F.col(quote_name(c)) for c in others]) if others else F.lit(0)
    best = df.groupBy(*[quote_name(k) for k in keys]).agg(F.max_by(row, rank).alias("_best"))
    return best.select(*[
        F.col(quote_name(c)) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns])


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], hint: str | None = None) -> DataFrame:
    """Rows of ``updates`` replace rows of the same key or are added.

    ``updates`` must hold each key once. Without a join ``hint`` Catalyst broadcasts a
    small update and sort-merges a large one.
    """
    replaced = updates.select(*keys)
    if hint:
        replaced = replaced.hint(hint)
    return base.join(replaced, list(keys), "left_anti").unionByName(updates.select(*base.columns))


def insert_missing(base: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The candidates whose key the base does not have yet."""
    return candidates.join(base.select(*keys).distinct(), list(keys), "left_anti")


class VersionedTable:
    """Immutable versions plus a view that names the current one.

    Every write builds a new version next to the old one and then moves the view, so
    readers never see half a write and a failed write leaves the table as it was. A
    version carries the name of its table as a property; only tables that do are ever
    listed as versions or dropped.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        """Read by name."""
        return self.spark.table(self.name)

    def description(self) -> str | None:
        return self._properties(self.name).get("comment")

    def current_version(self) -> str | None:
        """Name of the version table behind the view, or None for a plain table."""
        return self._properties(self.name).get("keelson.version") if self.exists() else None

    def versions(self) -> list[str]:
        *database, table = self.name.split(".")
        where = ".".join(database) or self.spark.catalog.currentDatabase()
        shape = re.compile(re.escape(table + SEPARATOR) + "[0-9a-f]{32}", re.IGNORECASE)
        names = [".".join([*database, t.name]) for t in self.spark.catalog.listTables(where) if shape.fullmatch(t.name)]
        return [n for n in names if self._properties(n).get(OWNER_PROPERTY, "").lower() == self.name.lower()]

    def overwrite(self, df: DataFrame, description: str = "") -> None:
        """A new version with the frame's rows and schema."""
        version = self._new_name()
        df.write.mode("errorifexists").saveAsTable(version)
        self._move_view(version, {}, description)

    def vacuum(self) -> list[str]:
        """Drop every version but the current one and those that a clone reads."""
        keep = (self.current_version() or "").lower()
        dropped = [v for v in self.versions() if v.lower() != keep and PIN_PROPERTY not in self._properties(v)]
        self._drop_versions(dropped)
        return dropped

    def drop(self) -> None:
        """Drop the table and its versions, but for those that a clone reads."""
        versions = self.versions()
        drop_table(self.spark, self.name)
        self._drop_versions([v for v in versions if PIN_PROPERTY not in self._properties(v)])

    def _drop_versions(self, versions: Sequence[str]) -> None:
        for version in versions:
            drop_table(self.spark, version)

    def _new_name(self) -> str:
        return f"{self.name}{SEPARATOR}{uuid.uuid4().hex}"

    def _move_view(self, version: str, properties: Mapping[str, str], description: str, columns: str = "*") -> None:
        quoted = quote_name(*version.split("."))
        self.spark.sql(f"ALTER TABLE {quoted} SET TBLPROPERTIES ('{OWNER_PROPERTY}'='{self.name}')")
        listed = ", ".join(f"'{k}'='{v}'" for k, v in {**properties, "keelson.version": version}.items())
        comment = description.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {quote_name(*self.name.split('.'))} COMMENT '{comment}' "
            f"TBLPROPERTIES ({listed}) AS SELECT {columns} FROM {quoted}"
        )

    def _properties(self, name: str) -> dict[str, str]:
        quoted = quote_name(*name.split("."))
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {quoted}").collect()}
        for row in self.spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").collect():
            if row["col_name"] == "Comment" and row["data_type"]:
                found["comment"] = row["data_type"]
        return found


class KeyedTable(VersionedTable):
    """A versioned table with one row per key.

    With ``parts`` the rows are partitioned by a stored hash of the key. A merge then reads
    and writes only the partitions that its update touches; a new version is an external
    table that takes the other partitions over by their location. Without ``parts`` (small
    tables) a merge writes the whole table.
    """

    def __init__(self, spark: SparkSession, name: str, parts: int | None = None):
        super().__init__(spark, name)
        self._parts = parts

    def keys(self) -> list[str]:
        return self._properties(self.name)[KEY_PROPERTY].split(",")

    def parts(self) -> int | None:
        """The number of partitions the table was made with, or else the one asked for here."""
        if not self.exists():
            return self._parts
        stored = self._properties(self.name).get(PARTS_PROPERTY)
        return int(stored) if stored else None

    def create(
        self, schema: T.StructType, keys: Sequence[str], description: str = "", replace: bool = False
    ) -> KeyedTable:
        """Create the empty table unless it exists; ``replace`` starts afresh.

        The new version is published before the old ones go, and those that a clone reads stay.
        """
        if self.exists() and not replace:
            return self
        unknown = [k for k in keys if k not in schema.names]
        if unknown:
            raise ValueError(f"key columns {unknown} are not in the schema")
        version = self._new_name()
        self._write_version(self._placed(self.spark.createDataFrame([], schema), keys, self._parts), version, self._parts, {})
        self._publish(version, schema.names, keys, self._parts, description)
        if replace:
            self.vacuum()
        return self

    def merge(self, updates: DataFrame, on_duplicate: str = "fail", order: Sequence[str] = ()) -> None:
        """Upsert ``updates``.

        A key that is NULL or repeated in the update fails the merge; with
        ``on_duplicate="latest"`` the greatest row under ``order`` wins instead, be it in the
        update or in the table (of equals the update's). An update that is itself read from
        this table is safe: versions never change.
        """
        keys, parts, old = self.keys(), self.parts(), self.current_version()
        current = self.read()
        updates = self._placed(align(updates, current.schema), keys, parts)
        base = self.spark.table(old)
        version = self._new_name()
        if on_duplicate != "latest" and base.isEmpty():  # written once, checked, then published
            self._write_version(updates, version, parts, {})
            self._check(self.spark.table(version), keys, version)
            self._publish(version, current.columns, keys, parts, self.description() or "")
            return
        with staging(updates, "merge") as rows:
            if parts:
                touched = [r[PART] for r in rows.select(PART).distinct().collect()]  # at most `parts`
                if not touched:
                    return
                base = base.where(F.col(PART).isin(touched))
            kept = {}
            if parts:
                kept = {p: writer for p, writer in self._places(old).items() if p not in touched}
            if on_duplicate == "latest":
                merged = self._latest(base, rows, keys, order, parts)
            else:
                self._check(rows, keys)
                merged = upsert(base, rows, keys)
            self._write_version(merged, version, parts, kept)
        self._publish(version, current.columns, keys, parts, self.description() or "")

    @staticmethod
    def _latest(base: DataFrame, updates: DataFrame, keys: list[str], order: Sequence[str], parts: int | None) -> DataFrame:
        """The greatest row of every key out of the table and the update; rows of the table without a key stay as they are.

        The number of tasks grows with the rows, so what one of them sorts does not. Rows of a key that comes often are
        combined by slices of their order first. It is a multiple of ``parts``, so that a task writes into one partition.
        """
        tasks = -(-(base.count() + updates.count()) // TASK_ROWS)
        tasks = max(1, -(-tasks // (parts or 1))) * (parts or 1)
        names = [quote_name(k) for k in keys]
        keyed = F.lit(True)
        for name in names:
            keyed = keyed & F.col(name).isNotNull()
        updates = updates.withColumn(NEWER, F.lit(1))
        if order:
            sliced = updates.withColumn(SLICE, F.pmod(F.xxhash64(*[F.to_json(F.struct(quote_name(c))) for c in order]), F.lit(tasks)))
            updates = latest_per_key(sliced.repartition(tasks, *names, SLICE), [*keys, SLICE], [*order, NEWER]).drop(SLICE)
        both = base.where(keyed).withColumn(NEWER, F.lit(0)).unionByName(updates)
        latest = latest_per_key(both.repartition(tasks, *names), keys, [*order, NEWER]).drop(NEWER)
        return latest.unionByName(base.where(~keyed)) if any(f.nullable for f in base.schema if f.name in keys) else latest

    def _check(self, updates: DataFrame, keys: list[str], version: str | None = None) -> None:
        broken = key_violations(updates, keys).take(1)
        if broken:
            if version:
                self._forget(version)
            raise ValueError(f"update breaks the key {keys}: {broken[0].asDict()}")

    @staticmethod
    def _placed(df: DataFrame, keys: Sequence[str], parts: int | None) -> DataFrame:
        return df.withColumn(PART, F.pmod(F.hash(*[F.col(quote_name(k)) for k in keys]), F.lit(parts))) if parts else df

    def _write_version(self, df: DataFrame, version: str, parts: int | None, kept: Mapping[int, str]) -> None:
        """Write the rows; ``kept`` names the versions that wrote the partitions that are taken over."""
        if not parts:
            df.write.mode("errorifexists").saveAsTable(version)
            return
        root = self._root(version)
        df.write.mode("errorifexists").partitionBy(PART).parquet(root)
        columns = ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in df.schema)
        quoted = quote_name(*version.split("."))
        self.spark.sql(f"CREATE TABLE {quoted} ({columns}) USING parquet PARTITIONED BY ({PART}) LOCATION '{root}'")
        places = {p: version.rsplit(SEPARATOR, 1)[1] for p in range(parts)} | dict(kept)
        listed = " ".join(f"PARTITION ({PART}={p}) LOCATION '{self._folder(p, writer)}'" for p, writer in places.items())
        self.spark.sql(f"ALTER TABLE {quoted} ADD {listed}")
        stored = ",".join(f"{p}:{writer}" for p, writer in places.items())
        self.spark.sql(f"ALTER TABLE {quoted} SET TBLPROPERTIES ('{PLACES_PROPERTY}'='{stored}')")

    def _publish(self, version: str, columns: Sequence[str], keys: Sequence[str], parts: int | None, description: str) -> None:
        properties = {KEY_PROPERTY: ",".join(keys)} | ({PARTS_PROPERTY: str(parts)} if parts else {})
        self._move_view(version, properties, description, ", ".join(quote_name(c) for c in columns))

    def _root(self, version: str) -> str:
        *database, table = version.split(".")
        where = ".".join(database) or self.spark.catalog.currentDatabase()
        return f"{self.spark.catalog.getDatabase(where).locationUri.rstrip('/')}/{table}"

    def _places(self, version: str) -> dict[int, str]:
        """Which version wrote each partition, from one property of the version."""
        stored = self._properties(version).get(PLACES_PROPERTY, "")
        return {int(p): writer for p, writer in (x.split(":") for x in stored.split(",") if x)}

    def _folder(self, part: int, writer: str) -> str:
        return f"{self._root(self.name + SEPARATOR + writer)}/{PART}={part}"

    def _forget(self, version: str) -> None:
        """Drop a version that was never published, with its files."""
        parts = PART in self.spark.table(version).columns
        drop_table(self.spark, version)
        if parts:
            delete_path(self.spark, self._root(version))

    def _drop_versions(self, versions: Sequence[str]) -> None:
        """Partitions of a dropped version go only if no version that stays names them."""
        stays = [v for v in self.versions() if v not in versions] if versions else []
        in_use = {place for v in stays for place in self._places(v).items()}
        gone = {place for v in versions for place in self._places(v).items()}
        super()._drop_versions(versions)
        for part, writer in sorted(gone - in_use):
            delete_path(self.spark, self._folder(part, writer))
