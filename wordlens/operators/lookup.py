"""Keyed look-ups of k hash positions against a small keyed table.

Sketch estimates look up k positions per row in a table whose row count is bounded by the sketch's
parameters (d x w cells), not by the data. When that bound fits Spark's broadcast
threshold, the table is broadcast once and probed k times inside one stage. Otherwise, and where the threshold turns
broadcasts off (-1), the positions are exploded, joined with a shuffle and re-aggregated per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes per lookup-table row used for the size bound: an 8-byte key, an 8-byte value
# and the hash-relation overhead of an unsafe row.
ROW_BYTES = 48
UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def byte_size(text: str) -> int:
    """Bytes of a Spark size setting: a number with an optional unit (b, k, kb, m, mb, ...)."""
    match = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)i?b?\s*", str(text).lower())
    if not match:
        raise ValueError(f"not a size: {text!r}")
    return int(match[1]) * UNITS[match[2]]


def broadcast_limit_bytes(spark: SparkSession) -> int:
    """The session's broadcast threshold; negative or 0 if broadcasts are off."""
    return byte_size(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def fits_broadcast(spark: SparkSession, max_rows: int) -> bool:
    """True when a table of at most ``max_rows`` rows is within the session's threshold."""
    return 0 < max_rows * ROW_BYTES <= broadcast_limit_bytes(spark)


def probe_positions(df: DataFrame, positions: list[Column], table: DataFrame, key: str,
                    value: str | None, max_rows: int, prefix: str,
                    row_id: str) -> DataFrame:
    """Add ``{prefix}0..{prefix}{k-1}``: the table value found at each position.

    ``table`` has unique ``key``; ``value`` None means presence (the key itself, null
    when absent). ``max_rows`` is the parameter-derived bound on the table's rows.
    ``row_id`` names a column that determines the positions (the hashed item); it is
    used only when the table is too large to broadcast.
    """
    spark = df.sparkSession
    k = len(positions)
    value_col = value or key
    lookup = table.select(F.col(key).alias("_k"), F.col(value_col).alias("_v"))
    out = df.select("*", *[p.alias(f"_pos{i}") for i, p in enumerate(positions)])
    if fits_broadcast(spark, max_rows):
        # The same build side every time (renamed above the join), so the k probes
        # share one broadcast exchange.
        small = F.broadcast(lookup)
        for i in range(k):
            t = small.alias(f"_t{i}")
            out = (out.join(t, F.col(f"_pos{i}") == F.col(f"_t{i}._k"), "left")
                   .select(*[F.col(c) for c in out.columns if c != f"_pos{i}"],
                           F.col(f"_t{i}._v").alias(f"{prefix}{i}")))
        return out
    # Large table: one row per (item, position), shuffle join on the position, then
    # regroup by item with one conditional aggregate per position (partial-aggregated).
    exploded = (out.select(row_id, *[f"_pos{i}" for i in range(k)]).dropDuplicates([row_id])
                .select(row_id, F.posexplode(F.array(*[F.col(f"_pos{i}") for i in range(k)]))
                        .alias("_i", "_k")))
    found = (exploded.join(lookup, "_k", "left")
             .groupBy(row_id)
             .agg(*[F.max(F.when(F.col("_i") == i, F.col("_v"))).alias(f"{prefix}{i}")
                    for i in range(k)]))
    return out.drop(*[f"_pos{i}" for i in range(k)]).join(found, row_id, "left")
