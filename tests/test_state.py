"""Keyed state with a function of the user's own, progress reports, and start positions."""

import json
import uuid

from pyspark.sql import functions as F

from wordlens.session import scratch_path
from wordlens.sinks.tables import GrowingTable
from wordlens.sources.urls import land
from wordlens.streaming import jobs, progress
from wordlens.streaming.state import idle_counts

SCHEMA = "word string, n bigint, at timestamp"


def _land(spark, path, rows):
    land(spark.createDataFrame(rows, "word string, n bigint, s bigint").select("word", "n", F.timestamp_seconds("s").alias("at")), path)


def test_seeded_totals_and_idle_words(spark):
    """a and b are seeded; b is idle for more than 10 seconds and leaves, then starts anew; a stays."""
    src, seed, checkpoint = (scratch_path(spark, f"test-{x}") for x in ("src", "seed", "ck"))
    _land(spark, seed, [("a", 5, 1000), ("b", 7, 1000)])
    seen = []
    for rows in ([("a", 1, 1001), ("a", 1, 1002)], [("a", 2, 1006), (None, 1, 1006), ("c", None, 1006)], [("a", 1, 1013)],
                 [("b", 1, 1015)], [("z", 1, 1040)]):
        _land(spark, src, rows)
        state = idle_counts(jobs.file_stream(spark, src, SCHEMA), 10, jobs.file_stream(spark, seed, SCHEMA))
        query = (state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
                 .foreachBatch(lambda batch, _: seen.extend(tuple(r) for r in batch.collect())).start())
        jobs.await_done(query)
    assert sorted(seen[:2]) == [("a", 7, False), ("b", 7, False)]
    assert seen[2:6] == [("a", 9, False), ("a", 10, False), ("b", 7, True), ("b", 1, False)]
    assert seen[6] == ("z", 1, False) and sorted(seen[7:]) == [("a", 10, True), ("b", 1, True)]


REPORTS = [
    {"batchId": 4, "sources": [{"description": "kafka", "startOffset": None, "endOffset": {"urls": {"0": 5, "1": 3}}, "numInputRows": 8},
                               {"description": "files", "startOffset": None, "endOffset": {"logOffset": 2}, "numInputRows": 1}]},
    {"batchId": 5, "sources": [{"description": "kafka", "startOffset": {"urls": {"0": 5, "1": 3}},
                                "endOffset": {"urls": {"0": 9, "1": 3, "2": 1}}, "numInputRows": 5},
                               {"description": "files", "startOffset": {"logOffset": 2}, "endOffset": {"logOffset": 2}, "numInputRows": 0}]},
]


def test_offset_rows_of_topics_and_files():
    rows = progress.offset_rows(REPORTS)
    assert [r[:5] for r in rows if r[1] == "urls"] == [(4, "urls", 0, None, 5), (4, "urls", 1, None, 3), (5, "urls", 0, 5, 9),
                                                      (5, "urls", 1, 3, 3), (5, "urls", 2, None, 1)]
    assert [r for r in rows if r[1] == "files"] == [(4, "files", 0, 0, 3, 1), (5, "files", 0, 3, 3, 0)]


def test_a_start_position_goes_on_where_the_ranges_end(spark):
    ranges = progress.offset_table(spark, REPORTS).where("source = 'urls'")
    assert json.loads(progress.starting_offsets(ranges)) == {"urls": {"0": 9, "1": 3, "2": 1}}


def test_a_growing_table_folds_and_starts_anew(spark):
    """Changed rows of batches, two of them written twice; folds drop what was folded before; batch 0 begins again."""
    sink = GrowingTable("growing", ["k"], ["n"], f"test_{uuid.uuid4().hex[:8]}", fold_every=2)
    df = lambda rows: spark.createDataFrame(rows, "k string, n bigint")
    total = {}
    for number in range(7):
        rows = [(f"k{j}", 10 * number + j) for j in range(number % 3 + 1)]
        total |= dict(rows)
        for _ in range(1 + number % 2):
            sink(df(rows), number)
        assert {r.k: r.n for r in sink.read(spark).collect()} == total
        assert len(sink.changes(spark)) <= 4
    sink(df([("x", 1)]), 0)
    assert {r.k: r.n for r in sink.read(spark).collect()} == {"x": 1}
    sink(df([]), 1)
    assert {r.k: r.n for r in sink.read(spark).collect()} == {"x": 1}
