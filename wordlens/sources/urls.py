"""URL sources: line files, URL records, URLs by wave of arrival, landed stream files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlens.functions.hashing import hash_bucket
from wordlens.params import DEFAULT_TOPIC, RECORD_VALUE

# Seed of the hash that assigns a key to a log partition.
PARTITION_HASH_SEED = "partition"
# Seed of the hash that assigns a URL its first wave.
ARRIVAL_HASH_SEED = "arrival"


def url_file(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line of a text file (or directory of files)."""
    return spark.read.text(path).select(F.col("value").alias("url"))


def url_records(urls: DataFrame, url_col: str = "url", topic: str = DEFAULT_TOPIC) -> DataFrame:
    """URLs as producer records: (topic, key = URL, value = dummy 0)."""
    return urls.select(F.lit(topic).alias("topic"), F.col(url_col).alias("key"),
                       F.lit(RECORD_VALUE).cast("int").alias("value"))


def line_count(df: DataFrame) -> DataFrame:
    """Number of lines / records, as a one-row DataFrame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def log_partition(key: Column, partitions: int) -> Column:
    """Kafka-style key partitioning: a stable hash of the key modulo the partition count."""
    return hash_bucket(key, PARTITION_HASH_SEED, partitions).cast("int")


def arrivals(urls: DataFrame, waves: int = 3, url: str = "url") -> DataFrame:
    """(key, wave): each URL arrives in a wave of its own, by hash, and again in every later one, as a
    producer that re-sends its file would have it."""
    first = hash_bucket(F.col(url), ARRIVAL_HASH_SEED, waves).cast("int")
    return urls.select(F.col(url).alias("key"), F.explode(F.sequence(first, F.lit(waves - 1))).alias("wave"))


def land(df: DataFrame, path: str, waves: int = 3, key: str | None = None, mode: str = "append") -> str:
    """Write ``df`` under ``path`` as a file stream's source, in one job with the tasks that it has.

    With ``key``, rows are told apart into ``waves`` file sets by its hash (``_wave=...`` folders), so that even a
    table of one split gives several files, which a rate cap can deal out.
    """
    if key is None:
        df.write.mode(mode).parquet(path)
    else:
        wave = hash_bucket(F.col(key), ARRIVAL_HASH_SEED, waves)
        df.withColumn("_wave", wave).write.mode(mode).partitionBy("_wave").parquet(path)
    return path


def landed_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under ``path`` (the listing alone is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
