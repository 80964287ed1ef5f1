"""URL-log operators: offsets, compaction, dedup, validity before membership."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wordlens.operators import urls
from wordlens.sources import tables
from wordlens.sources.urls import arrivals, line_count, url_records


def test_url_records_and_count(spark):
    pages = tables.pages(spark, SF_SMALL, ("url",))
    recs = url_records(pages)
    assert recs.columns == ["topic", "key", "value"]
    assert recs.where("value != 0").count() == 0
    assert line_count(pages).first().n == pq.read_metadata(f"{SF_SMALL}/pages.parquet").num_rows


def test_url_file_source(spark, tmp_path):
    from wordlens.sources.urls import url_file
    path = tmp_path / "urls.txt"
    path.write_text("http://a.com/x\nhttp://b.com/y\nhttp://a.com/x\n")
    df = url_file(spark, str(path))
    assert df.count() == 3
    assert urls.distinct_urls(df).count() == 2


def test_arrivals_come_again_in_every_later_wave(spark):
    log = arrivals(tables.pages(spark, SF_SMALL, ("url",)), 3)
    waves = log.groupBy("key").agg(F.min("wave").alias("a"), F.max("wave").alias("b"), F.count("*").alias("n")).collect()
    assert len(waves) == tables.pages(spark, SF_SMALL, ("url",)).count()
    assert all(r.b == 2 and r.n == 3 - r.a for r in waves) and {r.a for r in waves} == {0, 1, 2}


def test_offset_ranges(spark):
    log = spark.createDataFrame([("t", 0, 5), ("t", 0, 9), ("t", 1, 2)], "topic string, partition int, offset bigint")
    got = {r.partition: (r.from_offset, r.until_offset, r.n) for r in urls.offset_ranges(log).collect()}
    assert got == {0: (5, 10, 2), 1: (2, 3, 1)}


def test_latest_per_key_matches_pandas(spark):
    ev = tables.events(spark, SF_SMALL)
    got = {r.user_id: (r.event_id, r.event_type)
           for r in urls.latest_per_key(ev, "user_id", "event_id", ["event_type"]).collect()}
    pdf = pq.read_table(f"{SF_SMALL}/events.parquet").to_pandas()
    last = pdf.sort_values("event_id").groupby("user_id").tail(1)
    want = {int(r.user_id): (int(r.event_id), r.event_type) for r in last.itertuples()}
    assert got == want


def test_new_urls_exact_is_anti_join(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "url string")
    processed = spark.createDataFrame([("b",), ("x",)], "url string")
    assert sorted(r.url for r in urls.new_urls_exact(batch, processed).collect()) == ["a", "c"]


def test_invalid_urls_are_never_remembered(spark):
    # wave 0: a (valid), z (invalid); wave 1: a, z again; only a's first arrival counts
    log = spark.createDataFrame([("a", 0), ("z", 0), ("a", 1), ("z", 1)], "key string, wave int")
    valid = spark.createDataFrame([("a",)], "url string")
    firsts = {(r.url, r.wave) for r in urls.first_valid_wave(log, valid).collect()}
    assert firsts == {("a", 0)}
    counts = {r.batch: (r.n_urls, r.n_distinct, r.n_valid)
              for r in urls.batch_url_counts(log, valid).collect()}
    assert counts == {0: (2, 2, 1), 1: (2, 2, 0)}


def test_valid_pages_have_text(spark):
    vp = urls.valid_pages(tables.pages(spark, SF_SMALL, ("url", "html")))
    assert vp.where(F.col("text").isNull()).count() == 0
    assert vp.count() > 0


def test_kafka_record_encoding_round_trip(spark):
    from wordlens.sources.kafka import decode_url_records, encode_url_records
    rows = [("http://a.com/x", 0), ("http://b.com/y", 258), ("n", -1), ("low", -(1 << 31)), ("high", (1 << 31) - 1)]
    enc = encode_url_records(spark.createDataFrame(rows, "key string, value int"))
    assert [bytes(r.value) for r in enc.collect()] == [(v % (1 << 32)).to_bytes(4, "big") for _, v in rows]
    raw = enc.select(F.lit("urls").alias("topic"), F.lit(0).alias("partition"),
                     F.monotonically_increasing_id().alias("offset"),
                     F.col("key").cast("binary").alias("key"), "value")
    assert {(r.key, r.value) for r in decode_url_records(raw).collect()} == set(rows)


def test_kafka_options():
    from wordlens.params import TermConfig
    from wordlens.sources.kafka import publish_options, subscribe_options
    read = subscribe_options("broker:9092", TermConfig(topics="urls, more,").topics, "earliest", 40)
    assert read == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "urls,more", "startingOffsets": "earliest",
                    "maxOffsetsPerTrigger": "40"}
    assert "maxOffsetsPerTrigger" not in subscribe_options("b")
    write = publish_options("broker:9092", "urls", acks="1", linger_ms=7)
    assert write["topic"] == "urls" and write["kafka.acks"] == "1" and write["kafka.linger.ms"] == "7"
