"""Streams equal their batch twins; restarts, crashes and replays neither lose nor repeat anything."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wordlens.operators import cms, counts
from wordlens.params import TermConfig, cms_shape
from wordlens.session import scratch_path
from wordlens.sinks.tables import open_table, view_name
from wordlens.sources import tables
from wordlens.sources.urls import land, landed_bytes
from wordlens.streaming import jobs
from wordlens.streaming.state import read_state


def _as_dict(df, key="words", value="count"):
    return {r[key]: r[value] for r in df.collect()}


@pytest.fixture(scope="module")
def landed(spark):
    docs = tables.documents(spark, SF_SMALL)
    path = land(docs, scratch_path(spark, "test-landing"), 3, key="doc_id")
    return path, docs.schema, _as_dict(counts.word_count(docs), "word")


def _docs_stream(spark, landed, parts=3):
    path, schema, _ = landed
    return jobs.file_stream(spark, path, schema, max_bytes_per_trigger=landed_bytes(spark, path) // parts)


def _texts(spark, rows):
    return spark.createDataFrame(rows, "url string, description string")


def _send(spark, src, urls):
    land(spark.createDataFrame([(u,) for u in urls], "key string"), src)


def _run(spark, src, config=TermConfig(mode="count"), **how):
    return jobs.TermJob(spark, config, **how).run(jobs.file_stream(spark, src, "key string"))


@pytest.mark.parametrize("parts", [1, 3])
def test_word_count_equals_batch(spark, landed, parts):
    query, sink = jobs.start_word_count(_docs_stream(spark, landed, parts))
    jobs.await_done(query)
    assert _as_dict(sink.read(spark), "word") == landed[2]
    assert len([p for p in query.recentProgress if p.numInputRows]) >= parts


def test_word_count_restarts_from_its_checkpoint(spark, landed):
    docs = tables.documents(spark, SF_SMALL)
    src, checkpoint = scratch_path(spark, "test-src"), scratch_path(spark, "test-ck")
    for part in (0, 1):
        land(docs.where(F.col("doc_id") % 2 == part), src)
        query, sink = jobs.start_word_count(jobs.file_stream(spark, src, docs.schema), checkpoint=checkpoint)
        jobs.await_done(query)
    assert _as_dict(sink.read(spark), "word") == landed[2]


def test_seeded_word_count(spark, landed):
    seed = counts.seed_state(spark, [("amazon", 1)])
    path = scratch_path(spark, "test-seed")
    seed.write.parquet(path)
    query, sink = jobs.start_word_count(_docs_stream(spark, landed), seed_stream=jobs.file_stream(spark, path, seed.schema))
    jobs.await_done(query)
    want = dict(landed[2])
    want["amazon"] = want.get("amazon", 0) + 1
    assert _as_dict(sink.read(spark), "word") == want


@pytest.mark.parametrize("mode", ["both", "topk", "count"])
def test_job_equals_batch_in_all_outputs(spark, landed, mode):
    job = jobs.TermJob(spark, TermConfig(mode=mode), namespace=f"t_{mode}", fold_every=2).run(_docs_stream(spark, landed))
    docs = tables.documents(spark, SF_SMALL)
    if mode != "topk":
        assert _as_dict(job.term_counts()) == landed[2] == _as_dict(open_table(spark, "term_counts", f"t_{mode}"))
    if mode != "count":
        cells = {(r.row, r.bucket): r.cnt for r in cms.sketch_cells(counts.word_occurrences(docs)).collect()}
        assert {(r.row, r.bucket): r.cnt for r in job.cells().collect()} == cells
        wc = counts.word_count(docs)
        want = [r.word for r in cms.sketch_topk(wc, 10, cms.sketch_from_counts(wc)).collect()]
        assert [r.word for r in job.top_words().collect()] == want
        assert [r.word for r in spark.newSession().table(view_name("top_words", f"t_{mode}")).collect()] == want


def test_mode_may_change_between_runs(spark, landed):
    """The sketch is switched on later: it reads the sink from its start."""
    src, root = scratch_path(spark, "test-src"), scratch_path(spark, "test-root")
    texts = _texts(spark, [("a", "red apple"), ("b", "blue apple")])
    _send(spark, src, ["a"])
    _run(spark, src, TermConfig(mode="count"), root=root, pages=texts)
    _send(spark, src, ["b"])
    job = _run(spark, src, TermConfig(mode="both"), root=root, pages=texts)
    assert _as_dict(job.term_counts()) == {"red": 1, "apple": 2, "blue": 1}
    assert job.cells().where("row = 0").agg(F.sum("cnt")).first()[0] == 4


def test_seeds_of_counts_sketch_and_urls(spark):
    src, root = scratch_path(spark, "test-src"), scratch_path(spark, "test-root")
    config = TermConfig(mode="both", seed_counts=(("seeded", 2),), seed_urls=("b",))
    texts = _texts(spark, [("a", "red"), ("b", "blue"), ("c", "red")])
    for urls in (["a", "b"], ["b", "c"]):
        _send(spark, src, urls)
        job = _run(spark, src, config, root=root, pages=texts, membership="bloom")
    assert _as_dict(job.term_counts()) == {"seeded": 2, "red": 2}
    assert job.cells().where("row = 0").agg(F.sum("cnt")).first()[0] == 4


@pytest.mark.parametrize("membership", ["exact", "bloom"])
def test_only_valid_urls_are_remembered(spark, membership):
    """z has no page at first, then it has: it is tried again and counted once."""
    src, root = scratch_path(spark, "test-src"), scratch_path(spark, "test-root")
    rows = [("a", "red apple"), ("b", "blue berry apple"), ("e", "")]
    for n, urls in enumerate((["a", "z", "a"], ["a", "b", "z", "e"], ["z", "z", "e", "a"])):
        _send(spark, src, urls)
        texts = _texts(spark, rows + ([("z", "zebra apple")] if n == 2 else []))
        job = _run(spark, src, root=root, pages=texts, membership=membership)
    assert _as_dict(job.term_counts()) == {"red": 1, "apple": 3, "blue": 1, "berry": 1, "zebra": 1}
    assert sorted(r.url for r in job.processed().collect()) == ["a", "b", "e", "z"]
    metrics = [(r.n_urls, r.n_distinct, r.n_valid) for r in job.metrics().orderBy("batch").collect()]
    assert metrics == [(3, 2, 1), (4, 4, 2), (4, 3, 1)]
    offsets = [(r.from_offset, r.until_offset, r.n_rows) for r in job.offsets().orderBy("batch").collect()]
    assert offsets == [(0, 1, 3), (1, 2, 4), (2, 3, 4)]


def test_filter_far_beyond_its_design_point_loses_nothing(spark):
    """40 expected items, 600 arrive: the filter is sized for what was processed, every URL is counted once."""
    src, root = scratch_path(spark, "test-src"), scratch_path(spark, "test-root")
    urls = [f"http://x/{i}" for i in range(600)]
    texts = _texts(spark, [(u, f"w{i}") for i, u in enumerate(urls)])
    config = TermConfig(mode="count", bloom_expected_items=40)
    for batch in (urls[:200], urls[:500], urls, urls[100:]):
        _send(spark, src, batch)
        job = _run(spark, src, config, root=root, pages=texts, membership="bloom")
    assert _as_dict(job.term_counts()) == {f"w{i}": 1 for i in range(600)}


@pytest.mark.parametrize("kind", ["stage", "outputs"])
def test_a_crash_after_a_batch_is_replayed(spark, kind):
    """A batch whose commit is lost runs again on restart: the sink's log and absolute totals make that no difference."""
    import os

    src, root = scratch_path(spark, "test-src"), scratch_path(spark, "test-root")
    texts = _texts(spark, [("a", "red apple"), ("b", "blue apple")])
    _send(spark, src, ["a", "a"])
    _run(spark, src, TermConfig(mode="both"), root=root, pages=texts)
    local = root.removeprefix("file://").removeprefix("file:")
    for name in ["pages"] if kind == "stage" else ["counts", "cells"]:
        commits = f"{local}/checkpoints/{name}/commits"
        newest = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
        os.rename(f"{commits}/{newest}", f"{local}/lost-{name}")
        crc = f"{commits}/.{newest}.crc"
        if os.path.exists(crc):
            os.rename(crc, f"{local}/lost-{name}.crc")
    _send(spark, src, ["b", "a"])
    job = _run(spark, src, TermConfig(mode="both"), root=root, pages=texts)
    assert _as_dict(job.term_counts()) == {"red": 1, "apple": 2, "blue": 1}
    assert job.cells().where("row = 0").agg(F.sum("cnt")).first()[0] == 4


def test_a_batch_writes_changed_cells_only(spark):
    src, checkpoint = scratch_path(spark, "test-src"), scratch_path(spark, "test-ck")
    for words in (["a", "b", "c", "a"], ["a", "a"], ["d"]):
        land(spark.createDataFrame([(w, 1) for w in words], "word string, n bigint"), src)
        query, sink = jobs.start_cells(jobs.file_stream(spark, src, "word string, n bigint"), checkpoint)
        jobs.await_done(query)
    depth = cms_shape(TermConfig().cms_eps, TermConfig().cms_delta)[0]
    written = [spark.table(t).count() for t in sink.changes(spark)]
    assert [n for n in written if n] == [3 * depth, depth, depth]
    assert sink.read(spark).where("row = 0").agg(F.sum("cnt")).first()[0] == 7


def test_state_is_read_from_a_finished_checkpoint(spark, landed):
    checkpoint = scratch_path(spark, "test-ck")
    words = counts.word_occurrences(_docs_stream(spark, landed)).withColumn("n", F.lit(1).cast("bigint"))
    query, _ = jobs.start_counts(words, checkpoint)
    jobs.await_done(query)
    assert {r[0]: r[1] for r in read_state(spark, checkpoint).collect()} == landed[2]


def test_processing_time_trigger(spark):
    src = scratch_path(spark, "test-src")
    _send(spark, src, ["a"])
    job = jobs.TermJob(spark, TermConfig(mode="count", batch_seconds=1), pages=_texts(spark, [("a", "red"), ("b", "blue")]), namespace="t_started")
    job.start(jobs.file_stream(spark, src, "key string"))
    try:
        job.process_all_available()
        _send(spark, src, ["b", "a"])
        job.process_all_available()
        assert _as_dict(job.term_counts()) == {"red": 1, "blue": 1}
    finally:
        job.stop()
    assert [(r.n_urls, r.n_valid) for r in job.metrics().orderBy("batch").collect()] == [(1, 1), (2, 1)]
    assert _as_dict(open_table(spark, "term_counts", "t_started")) == {"red": 1, "blue": 1}


def test_a_job_goes_on_in_another_application(spark, tmp_path):
    """Two applications, one after another, that share nothing but the folder: totals are those of both."""
    import json
    import subprocess
    import sys

    code = """
import json, sys
from pyspark.sql import functions as F
from wordlens import TermConfig, build_session
from wordlens.sinks import open_table
from wordlens.streaming import jobs
folder, urls = sys.argv[1], sys.argv[2].split(",")
spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.checkpoint.dir": f"file://{folder}/shared"})
texts = spark.createDataFrame([("a", "red apple"), ("b", "blue apple"), ("c", "red")], "url string, description string")
spark.createDataFrame([(u,) for u in urls], "key string").write.mode("append").parquet(f"{folder}/urls")
job = jobs.TermJob(spark, TermConfig(mode="both"), f"file://{folder}/root", pages=texts, namespace="apps")
try:
    before = open_table(spark, "term_counts", "apps").count()
except LookupError:
    before = 0
job.run(jobs.file_stream(spark, f"{folder}/urls", "key string"))
print(json.dumps([before, {r.words: r["count"] for r in job.term_counts().collect()}, job.metrics().count(),
                  job.cells().where("row = 0").agg(F.sum("cnt")).first()[0]]))
spark.stop()
"""
    said = [json.loads(subprocess.run([sys.executable, "-c", code, str(tmp_path), urls], capture_output=True, text=True).stdout)
            for urls in ("a", "b,a,z")]
    assert said == [[0, {"red": 1, "apple": 1}, 1, 2], [2, {"red": 1, "apple": 2, "blue": 1}, 2, 4]]
