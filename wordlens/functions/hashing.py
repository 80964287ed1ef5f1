"""Portable hash positions for the Bloom filter and the count-min sketch.

One md5 per item gives two independent 32-bit values h1, h2 (the first and second
8 hex digits). Position i of k is ``(h1 + i * h2) mod m`` (double hashing, Kirsch and
Mitzenmacher, "Less hashing, same performance", 2006), so an item costs one digest, not
k. md5 is used because the same bits come out of any SQL engine, which gives the
sketches an exact external oracle; the arithmetic stays well inside bigint.

Callers project h1 and h2 into columns once (``with_hash_pair``) and derive positions
with plain arithmetic, which stays inside whole-stage codegen (a higher-order
``transform`` lambda would be interpreted and would re-evaluate the digest per element).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hex32(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def hash_pair(item: Column, seed: int | str) -> tuple[Column, Column]:
    """(h1, h2), each in [0, 2^32), of ``seed:item``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), item.cast("string")))
    return _hex32(digest, 1), _hex32(digest, 9)


def with_hash_pair(df: DataFrame, item: Column | str, seed: int | str,
                   names: tuple[str, str] = ("_h1", "_h2")) -> DataFrame:
    """``df`` plus columns h1, h2 (the digest is computed once per row)."""
    col = F.col(item) if isinstance(item, str) else item
    digest = F.md5(F.concat(F.lit(f"{seed}:"), col.cast("string")))
    return (df.withColumn("_digest", digest)
            .withColumn(names[0], _hex32(F.col("_digest"), 1))
            .withColumn(names[1], _hex32(F.col("_digest"), 9))
            .drop("_digest"))


def position(h1: Column, h2: Column, index: Column | int, modulus: int) -> Column:
    """Position ``index`` in [0, modulus) from the pair (h1, h2)."""
    idx = F.lit(index) if isinstance(index, int) else index
    return F.pmod(h1 + idx.cast("bigint") * h2, F.lit(modulus))


def wide_pair(item: Column, seed: int | str) -> tuple[Column, Column]:
    """Two independent values in [0, 2^60) of ``seed:item`` (15 hex digits each), for filters of any size."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), item.cast("string")))
    return tuple(F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") for at in (1, 17))


def sql_wide(item_sql: str, seed: int | str, half: int) -> str:
    """The DuckDB expression for one of the wide pair (half 0 or 1)."""
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({item_sql} AS VARCHAR)), {1 + 16 * half}, 15)) AS BIGINT)"


def hash_bucket(item: Column, seed: int | str, modulus: int) -> Column:
    """A single portable bucket in [0, modulus) (h1 mod m), e.g. a Kafka-style partition."""
    h1, _ = hash_pair(item, seed)
    return F.pmod(h1, F.lit(modulus))


def sql_hash_positions(item_sql: str, seed: int | str, index_sql: str, modulus: int) -> str:
    """The DuckDB expression for position ``index_sql`` (same bits as above)."""
    digest = f"md5('{seed}:' || CAST({item_sql} AS VARCHAR))"
    h1 = f"CAST(('0x' || substr({digest}, 1, 8)) AS BIGINT)"
    h2 = f"CAST(('0x' || substr({digest}, 9, 8)) AS BIGINT)"
    return f"(({h1} + CAST({index_sql} AS BIGINT) * {h2}) % {modulus})"


def sql_hash_bucket(item_sql: str, seed: int | str, modulus: int) -> str:
    digest = f"md5('{seed}:' || CAST({item_sql} AS VARCHAR))"
    return f"(CAST(('0x' || substr({digest}, 1, 8)) AS BIGINT) % {modulus})"
