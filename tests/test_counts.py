"""Exact counts against a brute-force Python count over the whole small table."""

from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from reference_impl import clean
from wordlens.operators import counts
from wordlens.sources import tables


def _texts(name="documents"):
    return pq.read_table(f"{SF_SMALL}/{name}.parquet", columns=["text"]).column("text").to_pylist()


def _counter(texts, drop_empty=True):
    c = Counter()
    for t in texts:
        c.update(clean(t, drop_empty=drop_empty))
    return c


def test_word_count_equals_brute_force(spark):
    got = {r.word: r["count"] for r in counts.word_count(tables.documents(spark, SF_SMALL)).collect()}
    assert got == dict(_counter(_texts()))


def test_word_count_compat_counts_empty_word(spark):
    df = counts.word_count(tables.documents(spark, SF_SMALL), drop_empty=False)
    got = {r.word: r["count"] for r in df.collect()}
    assert got == dict(_counter(_texts(), drop_empty=False))


def test_seeded_count_adds_seed(spark):
    seed = counts.seed_state(spark, [("amazon", 1), ("the", 5)])
    got = {r.word: r["count"] for r in
           counts.word_count_seeded(tables.documents(spark, SF_SMALL), seed).collect()}
    want = _counter(_texts())
    want["amazon"] += 1
    want["the"] += 5
    assert got == dict(want)


def test_merge_is_sum_and_order_free(spark):
    docs = counts.word_count(tables.documents(spark, SF_SMALL))
    conv = counts.word_count(tables.conversations(spark, SF_SMALL, ("text",)))
    ab = {r.word: r["count"] for r in counts.merge_counts(docs, conv).collect()}
    ba = {r.word: r["count"] for r in counts.merge_counts(conv, docs).collect()}
    want = _counter(_texts()) + _counter(_texts("conversations"))
    assert ab == ba == dict(want)


def test_ordered_and_topk(spark):
    wc = counts.word_count(tables.documents(spark, SF_SMALL))
    ordered = [(r.word, r["count"]) for r in counts.ordered_words(wc).collect()]
    want = sorted(_counter(_texts()).items(), key=lambda kv: (-kv[1], kv[0]))
    assert ordered == want
    top = [(r.word, r["count"]) for r in counts.top_words(wc, 10).collect()]
    assert top == want[:10]


def test_token_positions_are_one_based_and_complete(spark):
    docs = tables.documents(spark, SF_SMALL)
    pos = counts.token_positions(docs)
    per_doc = pos.groupBy("doc_id").agg(F.max("pos").alias("m"), F.count("*").alias("n"))
    assert per_doc.where("m != n").count() == 0
    assert pos.agg(F.min("pos")).first()[0] == 1


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_long_stop_tables_keep_positions(spark, threshold):
    """A list of 100,000 words, broadcast or not: no word of it is in the plan."""
    stops = spark.range(100_000).select(F.concat(F.lit("Stop"), "id").alias("word")).unionByName(
        spark.createDataFrame([(None,), ("THE",)], "word string"))
    docs = spark.createDataFrame([(1, "the stop7 cat stop99999 sat stop100000 the"), (2, ""), (3, None)], "doc_id int, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        left = counts.without_stop_table(counts.token_positions(docs), stops)
        assert sorted(tuple(r) for r in left.collect()) == [(1, 3, "cat"), (1, 5, "sat"), (1, 6, "stop100000")]
        assert "stop99" not in left._jdf.queryExecution().toString().lower().replace("concat(stop", "")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
