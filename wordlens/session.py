"""Session construction and the shared scratch folder.

On a cluster every intermediate table, streaming checkpoint and saved result lives under
the shared folder named by ``spark.checkpoint.dir``. Only when that setting is absent
(local tests) do we create a folder of our own and register it as the checkpoint dir.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_LOCAL_ROOTS: dict[str, str] = {}
_SCOPES: list[list] = []


def build_session(master: str | None = None, app: str = "wordlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  initial_partitions: int | None = None,
                  advisory_partition_bytes: int | None = None,
                  max_split_bytes: int | None = None) -> SparkSession:
    """A session with the settings the operators are designed around.

    AQE re-plans joins and coalesces shuffle partitions at run time, skew-join splitting
    is on, the streaming state store is RocksDB (vocabulary and URL state can outgrow
    the JVM heap), and the UI server is off.

    For large inputs: ``initial_partitions`` starts batch shuffles wide (AQE then
    coalesces them to ``advisory_partition_bytes`` each, so a partition fits in
    executor memory without spilling), and ``max_split_bytes`` caps the Parquet split
    size; text-heavy tables expand several-fold when tokenized, so 64 MB splits keep
    a task's exploded words in memory. ``shuffle_partitions`` also fixes the state
    partitions of a new streaming query (they cannot change after its first start).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        # commit a changelog per batch; full snapshots upload in background maintenance
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    if advisory_partition_bytes:
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(advisory_partition_bytes)
    if max_split_bytes:
        conf["spark.sql.files.maxPartitionBytes"] = str(max_split_bytes)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. If it is unset, a local master (tests) gets a
    folder of its own, once per application; a cluster must name one that all its machines share.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover - conf lookup is best effort
            configured = None
    if configured:
        return configured.rstrip("/")
    app_id = spark.sparkContext.applicationId
    root = _LOCAL_ROOTS.get(app_id)
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="wordlens-")
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
        _LOCAL_ROOTS[app_id] = root
    return root


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the scratch root; ``unique`` appends a fresh run id."""
    pieces = [scratch_root(spark), *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate(pieces))


def materialize(df, name: str = "materialized"):
    """Compute ``df`` once and cut its lineage: a Parquet table in the shared folder.

    Used for derived tables that several branches of a plan read (sketch cells, filter
    bits, word counts feeding estimates), so the expensive build runs once and a lost
    executor re-reads the files instead of recomputing the scan. (``checkpoint()``
    would run the plan twice unless persisted: once for its eager count, once to write
    the files; a written table is one job and is read back columnar.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    for scope in _SCOPES:
        scope.append((path, df.schema))
    return spark.read.parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes within are emptied at the end, when what was made of them has been written or read:

        with scratch_scope(spark):
            operator(docs).write.parquet(result)

    DataFrames that read them must not be used afterwards. Scopes may be nested; each empties its own tables and those inside.
    """
    written: list = []
    _SCOPES.append(written)
    try:
        yield
    finally:
        _SCOPES.remove(written)
        for path, schema in written:
            spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)
