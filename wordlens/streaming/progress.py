"""What Spark reports of each micro-batch: observed metrics and offset ranges, without a job of their own."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

OFFSETS = "batch bigint, source string, partition int, from_offset bigint, until_offset bigint, n_rows bigint"


class ProgressListener(StreamingQueryListener):
    """Progress of one query's batches that read rows, as dictionaries (the reports' JSON); batches without input are left out.

    ``with ProgressListener(spark) as heard: ...`` hears the queries that start within, by name.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.batches: dict[int, dict] = {}
        self.ended = threading.Event()
        self._ids: set[str] = set()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self._ids.add(str(event.runId))

    def onQueryProgress(self, event):
        if event.progress.name == self.name and event.progress.numInputRows:
            report = json.loads(event.progress.json)
            report["observed"] = {k: row.asDict() for k, row in (event.progress.observedMetrics or {}).items()}
            self.batches[report["batchId"]] = report

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if str(event.runId) in self._ids:
            self.ended.set()

    def __enter__(self) -> ProgressListener:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def drained(self, query: StreamingQuery, seconds: float = 60) -> list[dict]:
        """Reports of a query that has ended, in turn. Events come after the fact, so its last one is waited for."""
        query.awaitTermination()
        if query.exception() is None and not self.ended.wait(seconds):
            raise TimeoutError(f"no report of the end of {self.name}")
        return [self.batches[b] for b in sorted(self.batches)]


def _ranges(source: dict) -> Iterable[tuple[str, int, int | None, int]]:
    """(source, partition, from, until) of one source's offsets: topics and partitions, or a file log's entries."""
    start, end = source["startOffset"] or {}, source["endOffset"] or {}
    if "logOffset" in end:
        yield source["description"], 0, start.get("logOffset", -1) + 1, end["logOffset"] + 1
        return
    for topic, partitions in end.items():
        for partition, until in partitions.items():
            yield topic, int(partition), start.get(topic, {}).get(partition), until


def offset_rows(reports: Iterable[dict]) -> list[tuple]:
    """(batch, source, partition, from_offset, until_offset, n_rows) per batch, source and partition; from_offset is null
    where the report doesn't say where a partition began. n_rows counts the source's rows in the batch."""
    return [(r["batchId"], *one, s["numInputRows"]) for r in reports for s in r["sources"] for one in _ranges(s)]


def offset_table(spark: SparkSession, reports: Iterable[dict]) -> DataFrame:
    return spark.createDataFrame(offset_rows(reports), OFFSETS)


def starting_offsets(ranges: DataFrame) -> str:
    """A start position for the Kafka source (``startingOffsets``) that goes on where the ranges end."""
    last: dict[str, dict[str, int]] = {}
    for r in ranges.groupBy("source", "partition").agg({"until_offset": "max"}).collect():
        last.setdefault(r.source, {})[str(r.partition)] = r[2]
    return json.dumps({t: dict(sorted(p.items(), key=lambda x: int(x[0]))) for t, p in sorted(last.items())})
