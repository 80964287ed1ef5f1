"""Saved result tables: named versions in the catalogue, and a view that names the newest.

All are in one database whose folder is the shared one, so every session of the application sees them by name, and
with a shared metastore every application does; without one, another application ``attach``es them from the folder.

A save writes a new version and then points the view at it. Readers see the old table or the new one, never none, and a
reader that holds a version keeps it: a version is only dropped once it has been replaced for ``keep_seconds``.
Names may carry a namespace, so two jobs do not meet.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlens.session import scratch_path

DATABASE = "wordlens"
KEEP_SECONDS = 3600.0


def view_name(name: str, namespace: str = "") -> str:
    """A view's name: letters, digits and underscores of the namespace and the name."""
    return f"{DATABASE}." + re.sub(r"\W", "_", f"{namespace}_{name}" if namespace else name).lower()


def _location(spark: SparkSession) -> str:
    return scratch_path(spark, "tables", unique=False)


def _database(spark: SparkSession) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{_location(spark)}'")


def _tables(spark: SparkSession, view: str, mark: str) -> list[str]:
    """Names of a view's tables of one kind, oldest first."""
    _database(spark)
    own = view.split(".")[1]
    found = [r.tableName for r in spark.sql(f"SHOW TABLES IN {DATABASE} LIKE '{own}__{mark}*'").collect()]
    return sorted(f"{DATABASE}.{t}" for t in found if re.fullmatch(rf"{own}__{mark}\d+(_\w+)?", t))


def _made(version: str) -> float:
    return int(re.search(r"__v(\d+)_", version)[1]) / 1000


def save_table(df: DataFrame, name: str, namespace: str = "", keep_seconds: float = KEEP_SECONDS) -> str:
    """Write ``df`` as a new version, publish it under ``name`` and drop old versions; returns the version's name."""
    spark, view = df.sparkSession, view_name(name, namespace)
    _database(spark)
    version = f"{view}__v{time.time_ns() // 1_000_000:015d}_{uuid.uuid4().hex[:8]}"
    df.write.format("parquet").saveAsTable(version)
    publish(spark, version, view)
    expire(spark, name, namespace, keep_seconds)
    return version


def publish(spark: SparkSession, version: str, view: str) -> None:
    """Point the view at a version."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {version}")


def expire(spark: SparkSession, name: str, namespace: str = "", keep_seconds: float = KEEP_SECONDS) -> list[str]:
    """Drop versions that were replaced ``keep_seconds`` ago or earlier; returns their names. The newest always stays."""
    versions = _tables(spark, view_name(name, namespace), "v")
    old = [v for v, after in zip(versions, versions[1:]) if _made(after) <= time.time() - keep_seconds]
    for version in old:
        _drop(spark, version)
    return old


def read_saved(spark: SparkSession, version: str) -> DataFrame:
    """The exact version that ``save_table`` returned (stable even if the name moves on)."""
    return spark.table(version)


def open_table(spark: SparkSession, name: str, namespace: str = "") -> DataFrame:
    """The newest version under ``name``; one that another application wrote to the shared folder is attached first."""
    view = view_name(name, namespace)
    _database(spark)
    if not spark.catalog.tableExists(view) and not attach(spark, name, namespace):
        raise LookupError(f"no table {view} in the catalogue or in {_location(spark)}")
    return spark.table(view)


def _attach_all(spark: SparkSession, view: str, mark: str) -> list[str]:
    """Register a view's tables of some kinds ("v", "c" or "[vc]") that are in the shared folder and not in the catalogue; returns
    all that are in the folder, oldest first. Their files stay if such a table is dropped."""
    own = view.split(".")[1]
    _database(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    try:
        found = files.load(f"{_location(spark)}/{own}__*").select(
            F.regexp_extract("path", rf"/({own}__{mark}\d+(_\w+)?)/[^/]*$", 1).alias("name")).where("name <> ''").distinct()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    names = sorted(r.name for r in found.collect())
    for name in names:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {DATABASE}.{name} USING parquet LOCATION '{_location(spark)}/{name}'")
    return [f"{DATABASE}.{n}" for n in names]


def attach(spark: SparkSession, name: str, namespace: str = "") -> str | None:
    """Register the newest version found in the shared folder, and the view; returns its name."""
    view = view_name(name, namespace)
    versions = _attach_all(spark, view, "v")
    if not versions:
        return None
    publish(spark, versions[-1], view)
    return versions[-1]


def _write(rows: DataFrame, table: str) -> None:
    """Write all rows of a table at a folder of its own in the shared one, whether it, or what a crash left of it, is there or not."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{_location(spark)}/{table.split('.')[1]}'")
    spark.catalog.refreshTable(table)  # another session may have written it
    rows.write.mode("overwrite").insertInto(table)


def _drop(spark: SparkSession, version: str) -> None:
    """Drop a version and its rows; one that was attached leaves an empty folder."""
    if spark.catalog.getTable(version).tableType == "EXTERNAL":
        _write(spark.createDataFrame([], spark.table(version).schema).coalesce(1), version)
    spark.sql(f"DROP TABLE IF EXISTS {version}")


class TableSink:
    """foreachBatch sink of a query in complete mode: each batch is a new version of a named table."""

    def __init__(self, name: str, namespace: str = "", keep_seconds: float = KEEP_SECONDS):
        self.name, self.namespace, self.keep_seconds = name, namespace, keep_seconds

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        save_table(batch, self.name, self.namespace, self.keep_seconds)

    def read(self, spark: SparkSession) -> DataFrame:
        return open_table(spark, self.name, self.namespace)


class GrowingTable:
    """foreachBatch sink of a query in update mode whose values only grow (counts, cells of a sketch, bits).

    A batch writes its changed rows, absolute values, to a table of its own, of which there are ``2 * fold_every``, used in turn. A
    key's newest value is its largest, so a batch that is written again, or read beside what it was folded into, changes
    nothing. Every ``fold_every`` batches all is folded into a version of the named table. Batch 0 of a query starts anew.
    """

    def __init__(self, name: str, keys: Sequence[str], values: Sequence[str], namespace: str = "", fold_every: int = 16,
                 keep_seconds: float = KEEP_SECONDS):
        self.name, self.keys, self.values, self.namespace = name, list(keys), list(values), namespace
        self.fold_every, self.keep_seconds = fold_every, keep_seconds

    @property
    def view(self) -> str:
        return view_name(self.name, self.namespace)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._attach(spark)
        if batch_id == 0:
            for table in self.changes(spark):
                _write(spark.createDataFrame([], spark.table(table).schema).coalesce(1), table)
            for version in _tables(spark, self.view, "v"):
                _drop(spark, version)
            spark.sql(f"DROP VIEW IF EXISTS {self.view}")
        _write(batch.select(*self.keys, *self.values), f"{self.view}__c{batch_id % (2 * self.fold_every):04d}")
        if (batch_id + 1) % self.fold_every == 0:
            self.fold(spark)

    def _attach(self, spark: SparkSession) -> None:
        """A query that goes on in another application finds its tables in the shared folder."""
        _database(spark)
        if not self.changes(spark):
            _attach_all(spark, self.view, "[vc]")

    def changes(self, spark: SparkSession) -> list[str]:
        """Tables of changed rows."""
        return _tables(spark, self.view, "c")

    def read(self, spark: SparkSession) -> DataFrame:
        """Keys and values up to the last batch written."""
        self._attach(spark)
        tables = _tables(spark, self.view, "v")[-1:] + self.changes(spark)
        if not tables:
            raise LookupError(f"{self.view} has no batch")
        for table in tables:
            spark.catalog.refreshTable(table)
        rows = reduce(DataFrame.unionByName, [spark.table(t) for t in tables])
        return rows.groupBy(*self.keys).agg(*[F.max(v).alias(v) for v in self.values])

    def fold(self, spark: SparkSession) -> None:
        """Publish all up to now as a version."""
        save_table(self.read(spark), self.name, self.namespace, self.keep_seconds)
