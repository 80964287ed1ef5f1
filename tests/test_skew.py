"""A hot key holding a third of all rows: results stay exact, aggregation stays partial."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wordlens.operators import counts, urls
from wordlens.params import TermConfig
from wordlens.session import scratch_path
from wordlens.sources import tables
from wordlens.sources.urls import land
from wordlens.streaming import jobs


def _hot_events(spark):
    """Every third event is re-keyed to user 0."""
    ev = tables.events(spark, SF_SMALL)
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                         .otherwise(F.col("user_id")))


def test_latest_per_key_with_hot_key(spark):
    ev = _hot_events(spark)
    got = {r.user_id: (r.event_id, r.event_type)
           for r in urls.latest_per_key(ev, "user_id", "event_id", ["event_type"]).collect()}
    pdf = pq.read_table(f"{SF_SMALL}/events.parquet").to_pandas()
    pdf.loc[pdf.event_id % 3 == 0, "user_id"] = 0
    last = pdf.sort_values("event_id").groupby("user_id").tail(1)
    assert got == {int(r.user_id): (int(r.event_id), r.event_type) for r in last.itertuples()}
    plan = urls.latest_per_key(ev, "user_id", "event_id", ["event_type"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_hot_word_count_is_exact(spark):
    docs = tables.documents(spark, SF_SMALL)
    hot = docs.select(F.lit("hot " * 50).alias("text"))  # one word, many occurrences
    both = docs.select("text").unionByName(hot)
    got = {r.word: r["count"] for r in counts.word_count(both).collect()}
    base = {r.word: r["count"] for r in counts.word_count(docs).collect()}
    assert got["hot"] == base.get("hot", 0) + 50 * docs.count()


def test_url_job_with_hot_url(spark):
    """One URL is a third of every batch or more: counted once, its arrivals all recorded."""
    texts = spark.createDataFrame([("a", "red apple"), ("b", "blue berry"), ("c", "green")], "url string, description string")
    src, root = scratch_path(spark, "test-hot-url"), scratch_path(spark, "test-root")
    for batch in (["a"] * 30 + ["b"] * 30 + ["z"] * 30, ["a"] * 30 + ["c"] * 60):
        land(spark.createDataFrame([(u,) for u in batch], "key string"), src)
        job = jobs.TermJob(spark, TermConfig(mode="count"), root, pages=texts).run(jobs.file_stream(spark, src, "key string"))
    words = {r.words: r["count"] for r in job.term_counts().collect()}
    assert words == {"red": 1, "apple": 1, "blue": 1, "berry": 1, "green": 1}
    metrics = [(r.n_urls, r.n_distinct, r.n_valid) for r in job.metrics().orderBy("batch").collect()]
    assert metrics == [(90, 3, 2), (90, 2, 1)]


def test_a_hot_url_is_one_row_a_batch_before_the_shuffle(spark):
    rows = spark.range(0, 40_000, 1, 4).selectExpr("if(id % 3 = 0, 'hot', if(id % 3 = 1, null, concat('u', id % 50))) AS url", "id")
    left = urls.fewer_repeats(rows, "url")
    found = left.groupBy("url").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.url for r in found} == {r.url for r in rows.select("url").distinct().collect()}
    assert max(r.n for r in found) <= 4 and left.schema == rows.schema


def test_a_hot_url_is_one_row_before_any_join(spark):
    log = spark.createDataFrame([("a", i % 2) for i in range(100)] + [("b", 1)], "key string, wave int")
    valid = spark.createDataFrame([("a",), ("b",)], "url string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = urls.first_valid_wave(log, valid)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.index("SortMergeJoin") < plan.index("partial_min")  # the tree prints from the top


def test_a_hot_word_is_not_sorted_against_a_stop_table(spark):
    """Nothing sorts the words of a list too long to broadcast, and a word with most of the rows is split over tasks."""
    words = spark.range(400_000, numPartitions=8).select(F.col("id").alias("pos"), F.when(F.col("id") % 10 < 7, F.lit("hot")).when(
        F.col("id") % 10 == 7, F.lit("stopped")).when(F.col("id") % 10 == 8, F.concat(F.lit("w"), "id")).alias("word"))
    stops = spark.createDataFrame([("Stopped",), ("STOPPED",), (None,), ("other",)], "word string")
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        left = counts.without_stop_table(words, stops)
        got = left.collect()
        plan = left._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.pos for r in got) == [i for i in range(400_000) if i % 10 != 7]
    assert sum(r.word is None for r in got) == 40_000
    assert "Sort" not in plan and "ShuffledHashJoin" in plan and "skewed" in plan
