"""Structured Streaming jobs over texts or URLs. All state is in Spark's own state stores (RocksDB, see ``session``).

A job (``TermJob``) is a few plain queries, each with a checkpoint of its own under one root:

* ``pages`` (URL streams): in-batch distinct, the look-up in the crawled pages, and only then, so that pages without a description are
  tried again, de-duplication over all batches by ``dropDuplicates``. New valid pages go, as words, to a file sink.
* ``counts``: a streaming aggregation by word in update mode; a batch gives the changed totals.
* ``cells``: the same by cell of the count-min sketch; a batch gives the changed cells.
* ``names`` (sketch alone): a frequent-items sketch as one state row, which names the words that may be heavy hitters.

The file sink is read as a stream by the others, so a batch's pages are looked up, cleaned and tokenized once. Spark makes each
step exactly-once: the file sink by its log, the aggregations by their checkpoints, and the tables of totals because a
batch writes absolute values (``GrowingTable``), which may be written again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordlens.functions.hashing import position, with_hash_pair
from wordlens.functions.text import clean_words, explode_clean_words
from wordlens.operators import bloom, cms, counts
from wordlens.operators.urls import fewer_repeats
from wordlens.params import BLOOM_EXPECTED_ITEMS, BLOOM_FPP, SHIPPED_STOP_WORDS, TermConfig, cms_shape
from wordlens.session import materialize, scratch_path
from wordlens.sinks.tables import GrowingTable, TableSink, open_table, save_table
from wordlens.streaming.progress import OFFSETS, ProgressListener, offset_rows

#: How long after a batch its distinct URLs are remembered as such; more than clocks are ever set back.
CLOCK_DRIFT = "10 minutes"
FOLD_EVERY = 16
PAGE_WORDS = "url string, words array<string>"


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int | str | None = None, fmt: str = "parquet") -> DataFrame:
    """A file-stream source (offline twin of a topic), with a rate cap in files or bytes for each
    micro-batch, as ``maxOffsetsPerTrigger`` is for Kafka."""
    reader = spark.readStream.format(fmt).schema(schema)
    for name, value in (("maxFilesPerTrigger", max_files_per_trigger), ("maxBytesPerTrigger", max_bytes_per_trigger)):
        if value:
            reader = reader.option(name, str(value))
    return reader.load(path)


def _trigger(writer, seconds: int | None):
    return writer.trigger(processingTime=f"{int(seconds)} seconds") if seconds else writer.trigger(availableNow=True)


def _namespace(checkpoint: str) -> str:
    """Tables of a query go by its checkpoint, so that a restart goes on with them."""
    return "q" + hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def await_done(query: StreamingQuery) -> None:
    """Block until an availableNow query has drained its source; re-raise failures."""
    query.awaitTermination()
    error = query.exception()
    if error is not None:
        raise RuntimeError(f"streaming query {query.name} failed: {error}")


# --------------------------------------------------------------------------- single queries

def start_word_count(stream: DataFrame, text: str = "text", stop_words: Iterable[str] = SHIPPED_STOP_WORDS,
                     drop_empty: bool = True, seed_stream: DataFrame | None = None, checkpoint: str | None = None,
                     trigger_seconds: int | None = None) -> tuple[StreamingQuery, TableSink]:
    """Running exact word count over a text stream in complete mode: a version of table ``word_count`` for each batch.

    ``seed_stream`` (word, count) starts the state from initial counts: a second stream in the same aggregation.
    """
    words = (explode_clean_words(stream, text, stop_words, drop_empty)
             .withColumn("count", F.lit(1).cast("bigint")))
    if seed_stream is not None:
        words = words.unionByName(seed_stream.select("word", F.col("count").cast("bigint")))
    state = words.groupBy("word").agg(F.sum("count").cast("bigint").alias("count"))
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "checkpoints", "word_count")
    sink = TableSink("word_count", _namespace(checkpoint))
    writer = state.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger_seconds).foreachBatch(sink).queryName(f"word_count_{id(sink)}").start(), sink


def _update(state: DataFrame, sink, checkpoint: str, name: str, seconds: int | None) -> StreamingQuery:
    writer = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return _trigger(writer, seconds).foreachBatch(sink).queryName(name).start()


def start_counts(words: DataFrame, checkpoint: str, fold_every: int = FOLD_EVERY,
                 seconds: int | None = None) -> tuple[StreamingQuery, GrowingTable]:
    """Running totals (words, count) of a stream (word, n), changed words only."""
    state = words.groupBy(F.col("word").alias("words")).agg(F.sum("n").cast("bigint").alias("count"))
    sink = GrowingTable("term_counts", ["words"], ["count"], _namespace(checkpoint), fold_every)
    return _update(state, sink, checkpoint, f"counts_{id(sink)}", seconds), sink


def start_cells(words: DataFrame, checkpoint: str, config: TermConfig = TermConfig(), fold_every: int = FOLD_EVERY,
                seconds: int | None = None) -> tuple[StreamingQuery, GrowingTable]:
    """The running count-min sketch (row, bucket, cnt) of a stream (word, n), changed cells only.

    Each map task sums its words' cells before the shuffle, so a batch sends depth x width rows a task at most.
    """
    depth, width = cms_shape(config.cms_eps, config.cms_delta)
    hashed = with_hash_pair(words, "word", config.cms_seed)
    places = F.array(*[position(F.col("_h1"), F.col("_h2"), i, width) for i in range(depth)])
    cells = hashed.select(F.posexplode(places).alias("row", "bucket"), "n")
    state = cells.groupBy("row", "bucket").agg(F.sum("n").cast("bigint").alias("cnt"))
    sink = GrowingTable("cells", ["row", "bucket"], ["cnt"], _namespace(checkpoint), fold_every)
    return _update(state, sink, checkpoint, f"cells_{id(sink)}", seconds), sink


def start_names(words: DataFrame, checkpoint: str, seconds: int | None = None) -> tuple[StreamingQuery, TableSink]:
    """The running frequent-items sketch (sketch) of a stream (word, n): one row of state, whatever the vocabulary. It tracks
    every word that is more than 3.5 / its map's size of all occurrences, well below a heavy hitter's share."""
    each = words.select(F.explode(F.expr("array_repeat(word, int(n))")).alias("word"))
    state = each.groupBy().agg(F.expr(f"approx_top_k_accumulate(word, {cms.TRACKED})").alias("sketch"))
    sink = TableSink("names", _namespace(checkpoint))
    return _update(state, sink, checkpoint, f"names_{id(sink)}", seconds), sink


def new_pages(urls: DataFrame, pages: DataFrame, known: DataFrame | None = None, bits: DataFrame | None = None,
              items: int = BLOOM_EXPECTED_ITEMS, fpp: float = BLOOM_FPP) -> DataFrame:
    """(url, description) of a stream of URLs: distinct within a batch, with a crawled page (pages: url, description), and
    not given out before. Metrics ``urls`` and ``pages`` are observed on the way: n_urls, n_distinct and n_valid.

    ``known`` are URLs that count as processed. With ``bits``, their Bloom filter for so many ``items``, a URL that the
    filter lacks is new at once, and only others are compared with ``known``; the answer is the same.
    """
    timed = urls.select("url", F.current_timestamp().alias("at")).observe("urls", F.count(F.lit(1)).alias("n_urls"))
    # a batch has one timestamp, which its replay has too; the state of this is the batch's
    distinct = (fewer_repeats(timed, "url").withWatermark("at", CLOCK_DRIFT).dropDuplicates(["url", "at"])
                .observe("distinct", F.count(F.lit(1)).alias("n_distinct")))
    if bits is not None:
        asked = bloom.might_contain(distinct, bits, "url", items, fpp)
        listed = known.select(F.col("url").alias("_known"))
        distinct = asked.join(listed, F.col("might_contain") & (F.col("url") == F.col("_known")), "left_anti").drop("might_contain")
    elif known is not None:
        distinct = distinct.join(known, "url", "left_anti")
    valid = distinct.join(pages.select("url", "description"), "url").select("url", "description")
    return valid.dropDuplicates(["url"]).observe("pages", F.count(F.lit(1)).alias("n_valid"))


# --------------------------------------------------------------------------- the whole job

class TermJob:
    """Word totals and/or the sketch's top words of a stream of texts (column ``text``) or, with ``pages`` (url, description),
    of URLs (``url_col``), for ``config.mode``.

    ``run`` drains a stream and ends; another run, or another job with the same root, goes on from there. The mode may
    change between runs: an output that is new reads the stream, or the sink, from its start. ``start`` runs on, with a
    batch every ``config.batch_seconds``, until ``stop``.

    ``membership`` "bloom" asks a Bloom filter of the URLs that earlier runs processed before these are compared. Results are
    the same as with "exact". Seeds: ``seed_counts`` are further occurrences, ``seed_urls`` count as processed.

    Skew: a word that is a third of the stream is one row a task after the partial aggregations, a URL one an Arrow batch.
    """

    def __init__(self, spark: SparkSession, config: TermConfig, root: str | None = None, text: str = "text",
                 pages: DataFrame | None = None, url_col: str = "key", membership: str = "exact", namespace: str = "",
                 fold_every: int = FOLD_EVERY):
        if membership not in ("exact", "bloom"):
            raise ValueError("membership must be exact or bloom")
        self.spark, self.config, self.text = spark, config, text
        self.root = (root or scratch_path(spark, "terms")).rstrip("/")
        self.pages, self.url_col, self.membership = pages, url_col, membership
        self.namespace, self.fold_every = namespace, fold_every
        self.queries: list[StreamingQuery] = []
        self._heard: ProgressListener | None = None

    @property
    def staged(self) -> bool:
        """Whether a file sink stands between the stream and the outputs: for URLs, and if two outputs read the words."""
        return self.pages is not None or self.config.mode == "both"

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def _namespace(self, name: str) -> str:
        return _namespace(self._checkpoint(name))

    # -- queries --------------------------------------------------------------
    def processed(self) -> DataFrame:
        """(url): URLs processed up to now."""
        try:
            return self.spark.read.schema(PAGE_WORDS).parquet(f"{self.root}/pages").select("url")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "url string")

    def _known(self) -> dict:
        """URLs that count as processed beforehand: the seeds and, to build a filter of, those of earlier runs."""
        c = self.config
        seeds = self.spark.createDataFrame([(u,) for u in c.seed_urls], "url string")
        if self.membership == "exact":
            return {"known": seeds} if c.seed_urls else {}
        known = materialize(seeds.unionByName(self.processed()).distinct(), "known_urls")
        items = bloom.sized_for(known, c.bloom_expected_items)
        bits = materialize(bloom.bloom_bits(known, "url", items, c.bloom_fpp), "known_bits")
        return {"known": known, "bits": bits, "items": items, "fpp": c.bloom_fpp}

    def _stage(self, stream: DataFrame, name: str, seconds: int | None) -> StreamingQuery:
        c = self.config
        if self.pages is not None:
            found = new_pages(stream.select(F.col(self.url_col).alias("url")), self.pages, **self._known())
            column = "description"
        else:
            found, column = stream.withColumn("url", F.lit(None).cast("string")), self.text
        words = found.select("url", clean_words(column, c.stop_words, c.drop_empty).alias("words"))
        writer = (words.writeStream.format("parquet").outputMode("append").queryName(name)
                  .option("checkpointLocation", self._checkpoint("pages")).option("path", f"{self.root}/pages"))
        return _trigger(writer, seconds).start()

    def _words(self, stream: DataFrame) -> DataFrame:
        """The stream (word, n) that the outputs count: occurrences, and the seeds once."""
        c = self.config
        if self.staged:
            each = file_stream(self.spark, f"{self.root}/pages", PAGE_WORDS).select(F.explode("words").alias("word"))
        else:
            each = explode_clean_words(stream, self.text, c.stop_words, c.drop_empty)
        words = each.withColumn("n", F.lit(1).cast("bigint"))
        if not c.seed_counts:
            return words
        seeds = counts.seed_state(self.spark, c.seed_counts).withColumnRenamed("count", "n")
        seeds.write.mode("ignore").parquet(f"{self.root}/seeds")
        return words.unionByName(file_stream(self.spark, f"{self.root}/seeds", "word string, n bigint"))

    def _outputs(self, stream: DataFrame, seconds: int | None) -> list[StreamingQuery]:
        c, out = self.config, []
        if c.counts_enabled:
            out.append(start_counts(self._words(stream), self._checkpoint("counts"), self.fold_every, seconds)[0])
        if c.sketch_enabled:
            out.append(start_cells(self._words(stream), self._checkpoint("cells"), c, self.fold_every, seconds)[0])
            if not c.counts_enabled:  # else the totals name the words
                out.append(start_names(self._words(stream), self._checkpoint("names"), seconds)[0])
        return out

    # -- runs -----------------------------------------------------------------
    def collect(self, stream: DataFrame) -> None:
        """Drain the stream into the file sink, and note what Spark reports of the batches. Nothing to do without a sink."""
        if not self.staged:
            return
        name = f"pages_{id(self)}"
        with ProgressListener(self.spark, name) as heard:
            query = self._stage(stream, name, None)
            reports = heard.drained(query)
        await_done(query)
        self._note(reports)

    def run(self, stream: DataFrame, outputs: bool = True) -> TermJob:
        """Drain the stream, then (``outputs``) bring the outputs up to it and publish them."""
        self.collect(stream)
        if outputs:
            for query in self._outputs(stream, None):
                await_done(query)
            self.publish()
        return self

    def start(self, stream: DataFrame) -> TermJob:
        """Run on, in the background."""
        seconds = self.config.batch_seconds
        if self.staged:
            name = f"pages_{id(self)}"
            self._heard = ProgressListener(self.spark, name)
            self.spark.streams.addListener(self._heard)
            self.queries.append(self._stage(stream, name, seconds))
        self.queries += self._outputs(stream, seconds)
        return self

    def process_all_available(self) -> None:
        """Block until what has arrived is in the outputs (of a started job)."""
        for query in self.queries:
            query.processAllAvailable()

    def stop(self) -> None:
        """End a started job and publish its outputs."""
        for query in self.queries:
            query.stop()
        if self._heard is not None:
            self._note(self._heard.drained(self.queries[0]))
            self.spark.streams.removeListener(self._heard)
        self.queries, self._heard = [], None
        self.publish()

    # -- results --------------------------------------------------------------
    def _table(self, name: str, keys: list[str], values: list[str], of: str) -> GrowingTable:
        return GrowingTable(name, keys, values, self._namespace(of), self.fold_every)

    @property
    def _metrics(self) -> GrowingTable:
        return self._table("metrics", ["batch"], ["n_urls", "n_distinct", "n_valid"], "pages")

    @property
    def _offsets(self) -> GrowingTable:
        return self._table("offsets", ["batch", "source", "partition"], ["from_offset", "until_offset", "n_rows"], "pages")

    def _note(self, reports: list[dict]) -> None:
        """Keep the batches' offsets and, of URLs, metrics."""
        if not reports:
            return
        first = reports[0]["batchId"]
        self._offsets(self.spark.createDataFrame(offset_rows(reports), OFFSETS), first)
        self._offsets.fold(self.spark)  # once a run, so the tables of changes may be used again
        if self.pages is not None:
            rows = []
            for r in reports:
                seen = {k: v for row in r["observed"].values() for k, v in row.items()}
                rows.append((r["batchId"], *[seen.get(k, 0) for k in self._metrics.values]))
            self._metrics(self.spark.createDataFrame(rows, "batch bigint, n_urls bigint, n_distinct bigint, n_valid bigint"), first)
            self._metrics.fold(self.spark)

    def metrics(self) -> DataFrame:
        """(batch, n_urls, n_distinct, n_valid): URLs received, distinct, and new valid ones, of each batch that had any."""
        return self._metrics.read(self.spark)

    def offsets(self) -> DataFrame:
        """(batch, source, partition, from_offset, until_offset, n_rows) of the staged stream's batches."""
        return self._offsets.read(self.spark)

    def term_counts(self) -> DataFrame:
        """(words, count) up to the last batch, unsorted."""
        return self._table("term_counts", ["words"], ["count"], "counts").read(self.spark)

    def cells(self) -> DataFrame:
        """(row, bucket, cnt): the sketch up to the last batch."""
        return self._table("cells", ["row", "bucket"], ["cnt"], "cells").read(self.spark)

    def top_words(self) -> DataFrame:
        """(word): the top k heavy hitters by estimate, among the counted words or those that the frequent-items sketch tracks."""
        c = self.config
        if c.counts_enabled:
            named = self.term_counts().select(F.col("words").alias("word"))
        else:
            tracked = F.expr(f"approx_top_k_estimate(sketch, {cms.TRACKED})")
            named = open_table(self.spark, "names", self._namespace("names")).select(F.explode(tracked).alias("x")).select("x.item")
            named = named.withColumnRenamed("item", "word")
        return cms.sketch_topk(named, c.topk, self.cells(), c.cms_eps, c.cms_delta, c.cms_seed, c.heavy_hitter_pct).select("word")

    def publish(self) -> None:
        """Save the outputs as new versions of the named tables ``term_counts`` and ``top_words``."""
        if self.config.counts_enabled:
            save_table(self.term_counts(), "term_counts", self.namespace)
        if self.config.sketch_enabled:
            save_table(self.top_words(), "top_words", self.namespace)
