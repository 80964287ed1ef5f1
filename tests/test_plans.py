"""Physical-plan checks: pruning, pushdown, no Cartesian products, bounded broadcasts."""

import re

import pytest

from conftest import SF_SMALL
from wordlens.plans import catalog

BATCH_QUERIES = [n for n in catalog.queries() if not n.startswith("stream")]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan(spark, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_cartesian_or_python_rows(spark, name):
    plan = _plan(spark, name)
    assert not [k for k in FORBIDDEN if k in plan], plan


def test_scans_read_only_needed_columns(spark):
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", _plan(spark, "word_count")))
    assert schemas == {"struct<text:string>"}
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", _plan(spark, "latest_per_key")))
    assert schemas == {"struct<event_id:bigint,user_id:bigint,event_type:string>"}


def test_filters_reach_the_scan(spark):
    plan = _plan(spark, "new_urls_exact")
    assert "StringStartsWith(url,https:)" in plan


def test_word_count_is_partial_aggregate(spark):
    plan = _plan(spark, "word_count")
    assert "partial_count" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_url_stream_plan(spark, tmp_path):
    """The streaming part of the URL job, with broadcasts off: equi-joins and Spark's own de-duplication, no nested loops."""
    from wordlens.streaming import jobs
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    path = str(tmp_path)
    try:
        spark.createDataFrame([("a",), ("b",)], "url string").write.mode("overwrite").parquet(f"{path}/urls")
        pages = spark.createDataFrame([("a", "text")], "url string, description string")
        known = spark.createDataFrame([("b",)], "url string")
        from wordlens.operators import bloom
        stream = jobs.new_pages(jobs.file_stream(spark, f"{path}/urls", "url string"), pages, known, bloom.bloom_bits(known), 1000)
        query = stream.writeStream.format("parquet").trigger(availableNow=True).option("checkpointLocation", f"{path}/ck").start(f"{path}/out")
        query.awaitTermination()
        plan = query._jsq.explainInternal(False)
        assert plan.count("StreamingDeduplicate") == 2 and "SortMergeJoin" in plan
        assert not [k for k in FORBIDDEN if k in plan], plan
        assert [tuple(r) for r in spark.read.parquet(f"{path}/out").collect()] == [("a", "text")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_page_text_is_extracted_once(spark):
    # the regex chain must not be inlined into a pushed-down filter as well
    plan = _plan(spark, "valid_pages")
    assert plan.count("<article") == 1
