"""Kafka source and sink builders.

The Kafka connector is not part of a plain PySpark install; these functions only build
readers and writers with the right options and decoding, so they run unchanged where
the ``spark-sql-kafka`` package is on the classpath. Tests use file streams instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlens.functions.text import comma_list
from wordlens.params import DEFAULT_TOPIC


def decode_url_records(raw: DataFrame) -> DataFrame:
    """Kafka rows -> (topic, partition, offset, key = URL string, value = int).

    Keys are UTF-8 strings; values are 4-byte big-endian integers in two's complement.
    """
    unsigned = F.conv(F.hex(F.col("value")), 16, 10).cast("bigint")
    signed = F.pmod(unsigned + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31)
    return raw.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"),
        signed.cast("int").alias("value"),
    )


def kafka_url_stream(spark: SparkSession, bootstrap_servers: str,
                     topics: str = DEFAULT_TOPIC, starting_offsets: str = "latest",
                     max_offsets_per_trigger: int | None = None,
                     options: dict[str, str] | None = None) -> DataFrame:
    """Streaming DataFrame of URL records from a comma-separated topic list (e.g. ``TermConfig.topics``).

    ``max_offsets_per_trigger`` is the rate cap (records per micro-batch over all
    partitions). Offsets are tracked by the query checkpoint, not committed to Kafka.
    """
    chosen = subscribe_options(bootstrap_servers, topics, starting_offsets, max_offsets_per_trigger) | (options or {})
    return decode_url_records(spark.readStream.format("kafka").options(**chosen).load())


def subscribe_options(bootstrap_servers: str, topics: str = DEFAULT_TOPIC, starting_offsets: str = "latest",
                      max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the Kafka reader; spaces and empty names in the topic list are dropped."""
    out = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": ",".join(comma_list(topics)),
           "startingOffsets": starting_offsets}
    return out | ({"maxOffsetsPerTrigger": str(max_offsets_per_trigger)} if max_offsets_per_trigger else {})


def encode_url_records(records: DataFrame) -> DataFrame:
    """(key, value int) -> Kafka (key string, value 4-byte big-endian binary)."""
    unsigned = F.pmod(F.col("value").cast("bigint"), F.lit(1 << 32))
    return records.select(F.col("key").cast("string").alias("key"),
                          F.unhex(F.lpad(F.hex(unsigned), 8, "0")).alias("value"))


def publish_options(bootstrap_servers: str, topic: str = DEFAULT_TOPIC, acks: str = "all",
                    compression: str = "snappy", linger_ms: int = 5, batch_size: int = 16384) -> dict[str, str]:
    """Options of the Kafka writer."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, "kafka.acks": acks,
            "kafka.compression.type": compression, "kafka.linger.ms": str(linger_ms),
            "kafka.batch.size": str(batch_size)}


def publish_urls_writer(records: DataFrame, bootstrap_servers: str, **how):
    """A batch writer that publishes URL records to a topic in one distributed write.

    Call ``.save()`` on the result where the Kafka connector is available.
    """
    return encode_url_records(records).write.format("kafka").options(**publish_options(bootstrap_servers, **how))
