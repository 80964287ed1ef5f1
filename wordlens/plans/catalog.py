"""The query catalogue: one Spark builder and one DuckDB oracle per operator.

Every query reads the driver tables in ``sf_dir`` (or data Spark derives from them),
over whole tables and whole texts. Stand-ins for the original job's inputs:

* product descriptions -> ``documents.text`` (and ``conversations.text`` as a later
  batch for merges);
* the URL topic -> ``arrivals(pages)``: page URLs by wave of arrival, re-sent in later waves; crawled
  pages -> ``pages.html``;
* "already processed" URLs -> valid pages served over https (an earlier crawl); the
  incoming batch is all arrivals;
* a generic keyed log for offsets and compaction -> ``events`` (key user_id, offset
  event_id, partition = hash of the key).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordlens.functions import text as TX
from wordlens.operators import bloom, cms, counts, urls
from wordlens.params import (
    CMS_DELTA,
    CMS_HEAVY_HITTER_PCT,
    CMS_SEED,
    CMS_TOPK,
    DEFAULT_TOPIC,
    SEED_URL,
    SEED_WORD,
    TermConfig,
    cms_shape,
)
from wordlens.plans import sql as S
from wordlens.session import materialize, scratch_path
from wordlens.sinks.tables import GrowingTable, open_table, read_saved, save_table, view_name
from wordlens.sources import tables
from wordlens.sources.urls import (
    ARRIVAL_HASH_SEED,
    arrivals,
    land,
    landed_bytes,
    line_count,
    log_partition,
    url_records,
)
from wordlens.streaming import jobs
from wordlens.streaming.state import idle_counts, read_state

EPS = cms.DEFAULT_EPS
DEPTH, WIDTH = cms_shape(EPS, CMS_DELTA)
HASHES = bloom.items_per_block()[1]
WAVES = 3
LOG_PARTITIONS = 4

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return wrap


# --------------------------------------------------------------------------- helpers

def _docs(spark, sf):
    return tables.documents(spark, sf)


def _occurrences(spark, sf):
    return counts.word_occurrences(_docs(spark, sf))


def _log(spark, sf):
    return arrivals(tables.pages(spark, sf, ("url",)), WAVES)


def _processed(spark, sf):
    """Valid pages served over https: the URLs an earlier run already processed."""
    pages = tables.pages(spark, sf, ("url", "html")).where(F.col("url").startswith("https:"))
    return urls.valid_pages(pages).select("url")


def _word_counts(spark, sf):
    """Exact (word, count) of the documents, computed once and checkpointed: it is
    the vocabulary for sketch probes and the weights of the sketch build."""
    return materialize(counts.count_words(_occurrences(spark, sf)))


def _cells(spark, sf, word_counts=None):
    """The documents' sketch, built from the word aggregate and checkpointed."""
    wc = word_counts if word_counts is not None else _word_counts(spark, sf)
    return materialize(cms.sketch_from_counts(wc))


def _hierarchy(spark, sf):
    """The documents' sketch with the levels of its hash prefixes."""
    return materialize(cms.hierarchy_cells(_occurrences(spark, sf)))


# SQL building blocks
_W = S.word_rows("documents")
_W_CONV = S.word_rows("conversations")
_CELLS = S.sketch_cells(_W, DEPTH, WIDTH, CMS_SEED)
_VOCAB = f"SELECT DISTINCT word FROM ({_W})"
_EST = S.estimates(_VOCAB, _CELLS, DEPTH, WIDTH, CMS_SEED)
_TOTAL = f"(SELECT sum(cnt) FROM ({_CELLS}) WHERE row = 0)"
_HH = f"SELECT word, est FROM ({_EST}) WHERE est >= {CMS_HEAVY_HITTER_PCT!r} * {_TOTAL}"
_FOUND = S.found_in_hierarchy(_HH, S.hierarchy_cells(_W, DEPTH, WIDTH, CMS_SEED), WIDTH, CMS_SEED, CMS_HEAVY_HITTER_PCT - EPS)
_WC = f"SELECT word, CAST(count(*) AS BIGINT) AS count FROM ({_W}) GROUP BY word"
_LOG = (f"SELECT url AS key, CAST(unnest(range({S.sql_hash_bucket('url', ARRIVAL_HASH_SEED, WAVES)}, {WAVES})) AS INTEGER) "
        "AS wave FROM pages")
_DESC = f"SELECT url, {S.page_description('html')} AS description FROM pages"
_VALID = f"SELECT url, description FROM ({_DESC}) WHERE description IS NOT NULL"
_PROCESSED = f"SELECT url FROM ({_VALID}) WHERE starts_with(url, 'https:')"


# --------------------------------------------------------------------------- sources

@register("url_records", f"SELECT '{DEFAULT_TOPIC}' AS topic, url AS key, CAST(0 AS INTEGER) AS value FROM pages")
def q_url_records(spark, sf):
    """The URL file as producer records (topic, key = URL, value = 0)."""
    return url_records(tables.pages(spark, sf, ("url",)))


@register("url_count", "SELECT CAST(count(*) AS BIGINT) AS n FROM pages")
def q_url_count(spark, sf):
    """Number of URL lines."""
    return line_count(tables.pages(spark, sf, ("url",)))


@register("offset_ranges", f"""
SELECT 'events' AS topic, CAST({S.sql_hash_bucket('user_id', 'partition', LOG_PARTITIONS)} AS INTEGER)
       AS partition, min(event_id) AS from_offset, max(event_id) + 1 AS until_offset,
       CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY ALL""")
def q_offset_ranges(spark, sf):
    """Per (topic, partition) offset range of a keyed log."""
    log = tables.events(spark, sf, ("event_id", "user_id")).select(
        F.lit("events").alias("topic"),
        log_partition(F.col("user_id"), LOG_PARTITIONS).alias("partition"),
        F.col("event_id").alias("offset"))
    return urls.offset_ranges(log)


@register("latest_per_key", """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
FROM events GROUP BY user_id""")
def q_latest_per_key(spark, sf):
    """Compacted view of a keyed log (latest record per key)."""
    return urls.latest_per_key(tables.events(spark, sf), "user_id", "event_id", ["event_type"])


# --------------------------------------------------------------------------- URL filters

@register("distinct_urls", f"SELECT DISTINCT key AS url FROM ({_LOG})")
def q_distinct_urls(spark, sf):
    """In-batch distinct over all arrivals (a URL comes again in later waves)."""
    return urls.distinct_urls(_log(spark, sf).select(F.col("key").alias("url")))


@register("new_urls_exact", f"""
SELECT DISTINCT key AS url FROM ({_LOG}) WHERE key NOT IN (SELECT url FROM ({_PROCESSED}))""")
def q_new_urls_exact(spark, sf):
    """P3 (exact): URLs of the log not yet processed (anti-join on the processed table)."""
    incoming = _log(spark, sf).select(F.col("key").alias("url"))
    return urls.new_urls_exact(incoming, _processed(spark, sf))


@register("url_short_name", f"SELECT url, {S.url_short_name('url')} AS short FROM pages")
def q_url_short_name(spark, sf):
    """Last path segment of each URL."""
    return tables.pages(spark, sf, ("url",)).select("url", TX.url_short_name("url").alias("short"))


@register("page_description", f"SELECT url, {S.page_description('html')} AS description FROM pages")
def q_page_description(spark, sf):
    """First paragraph of the description container, as visible text."""
    pages = tables.pages(spark, sf, ("url", "html"))
    return pages.select("url", TX.page_description("html").alias("description"))


@register("valid_pages", f"""
SELECT url, array_to_string({S.clean_words('description')}, ' ') AS text FROM ({_VALID})""")
def q_valid_pages(spark, sf):
    """Pages with a description, and their cleaned text."""
    return urls.valid_pages(tables.pages(spark, sf, ("url", "html")))


@register("valid_documents", f"""
SELECT doc_id, array_to_string({S.clean_words('text')}, ' ') AS text FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def q_valid_documents(spark, sf):
    """P4 T6 over documents: texts whose quality label marks them valid, cleaned."""
    good = tables.read_table(spark, sf, "labels", ("doc_id", "quality")).where("quality = 1")
    valid = urls.keep_valid(_docs(spark, sf), good, "doc_id")
    return valid.select("doc_id", TX.cleaned_text("text").alias("text"))


@register("url_page_lookup", f"""
SELECT l.key AS url, CAST(l.wave AS INTEGER) AS wave, d.description
FROM ({_LOG}) l JOIN ({_DESC}) d ON l.key = d.url""")
def q_url_page_lookup(spark, sf):
    """URL -> fetched page (stream-static equi-join of the log with the crawl)."""
    log = _log(spark, sf).select(F.col("key").alias("url"), "wave")
    pages = tables.pages(spark, sf, ("url", "html")).select(
        "url", TX.page_description("html").alias("description"))
    return urls.url_pages(log, pages).select("url", "wave", "description")


@register("batch_url_counts", f"""
WITH log AS ({_LOG}),
firsts AS (SELECT key, min(wave) AS wave FROM log WHERE key IN (SELECT url FROM ({_VALID}))
           GROUP BY key),
nv AS (SELECT wave, CAST(count(*) AS BIGINT) AS n_valid FROM firsts GROUP BY wave)
SELECT CAST(l.wave AS INTEGER) AS batch, CAST(count(*) AS BIGINT) AS n_urls,
       CAST(count(DISTINCT l.key) AS BIGINT) AS n_distinct,
       CAST(coalesce(any_value(nv.n_valid), 0) AS BIGINT) AS n_valid
FROM log l LEFT JOIN nv ON nv.wave = l.wave GROUP BY l.wave""")
def q_batch_url_counts(spark, sf):
    """Per batch (wave) URLs received, distinct, and new valid URLs."""
    valid = urls.valid_pages(tables.pages(spark, sf, ("url", "html"))).select("url")
    return urls.batch_url_counts(_log(spark, sf), valid)


# --------------------------------------------------------------------------- text

@register("tokens", f"""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, word FROM (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, {S.tokens('text')} AS w FROM documents))""")
def q_tokens(spark, sf):
    """Lower-cased tokens with positions."""
    return counts.token_positions(_docs(spark, sf))


@register("stopword_filtered", f"""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, word FROM (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, {S.clean_words('text')} AS w FROM documents))""")
def q_stopword_filtered(spark, sf):
    """T5: tokens after stop-word removal (order and duplicates kept)."""
    return counts.clean_word_positions(_docs(spark, sf))


@register("stop_table_filtered", f"""
WITH t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
           FROM (SELECT doc_id, {S.tokens('text')} AS w FROM documents))
SELECT doc_id, CAST(pos AS BIGINT) AS pos, word FROM t
WHERE word NOT IN (SELECT unnest({S.tokens('text')}) FROM conversations WHERE text IS NOT NULL)""")
def q_stop_table_filtered(spark, sf):
    """T5 with a long stop list, given as a table: every word that the conversations use. Positions are kept."""
    stops = tables.conversations(spark, sf, ("text",)).select(F.explode(TX.tokenize("text")).alias("word"))
    return counts.without_stop_table(counts.token_positions(_docs(spark, sf)), stops)


@register("cleaned_text", f"""
SELECT doc_id, array_to_string({S.clean_words('text')}, ' ') AS text FROM documents""")
def q_cleaned_text(spark, sf):
    """Cleaned words joined by single spaces."""
    return _docs(spark, sf).select("doc_id", TX.cleaned_text("text").alias("text"))


# --------------------------------------------------------------------------- counts

@register("word_count", _WC)
def q_word_count(spark, sf):
    """Exact word count."""
    return counts.count_words(_occurrences(spark, sf))


@register("word_count_compat", f"""
SELECT word, CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest({S.clean_words('text', drop_empty=False)}) AS word FROM documents)
GROUP BY word""")
def q_word_count_compat(spark, sf):
    """A1 with the original empty-word behaviour (drop_empty=False)."""
    return counts.word_count(_docs(spark, sf), drop_empty=False)


@register("word_count_seeded", f"""
SELECT word, CAST(sum(c) AS BIGINT) AS count FROM (
  SELECT word, 1 AS c FROM ({_W}) UNION ALL SELECT '{SEED_WORD}' AS word, 1 AS c)
GROUP BY word""")
def q_word_count_seeded(spark, sf):
    """Counts whose state starts from the seed ("amazon", 1)."""
    seed = counts.seed_state(spark, [(SEED_WORD, 1)])
    return counts.word_count_seeded(_docs(spark, sf), seed)


@register("word_count_merge", f"""
SELECT word, CAST(sum(count) AS BIGINT) AS count FROM (
  SELECT word, count(*) AS count FROM ({_W}) GROUP BY word
  UNION ALL SELECT word, count(*) AS count FROM ({_W_CONV}) GROUP BY word)
GROUP BY word""")
def q_word_count_merge(spark, sf):
    """A3: running totals (documents) + a new batch (conversations)."""
    state = counts.word_count(_docs(spark, sf))
    delta = counts.word_count(tables.conversations(spark, sf, ("text",)))
    return counts.merge_counts(state, delta)


@register("ordered_words", _WC)
def q_ordered_words(spark, sf):
    """O1: every word by count descending (total order: ties by word)."""
    return counts.ordered_words(counts.count_words(_occurrences(spark, sf)))


@register("exact_topk", f"{_WC} ORDER BY count DESC, word LIMIT {CMS_TOPK}")
def q_exact_topk(spark, sf):
    """O2 K3: the k most frequent words."""
    return counts.top_words(counts.count_words(_occurrences(spark, sf)), CMS_TOPK)


# --------------------------------------------------------------------------- Bloom filter

@register("bloom_bits", S.bloom_bits(_PROCESSED, HASHES, bloom.BLOOM_SEED))
def q_bloom_bits(spark, sf):
    """A5: words of the processed URLs' filter, in the shape for their number (1000 at least) at 3%."""
    processed = materialize(_processed(spark, sf))
    return bloom.bloom_bits(processed, expected_items=bloom.sized_for(processed))


@register("bloom_merge", S.bloom_bits(f"SELECT url FROM ({_VALID})", HASHES, bloom.BLOOM_SEED))
def q_bloom_merge(spark, sf):
    """OR of the https filter and the http filter = filter of all valid URLs."""
    valid = materialize(urls.valid_pages(tables.pages(spark, sf, ("url", "html"))).select("url"))
    n = bloom.sized_for(valid)
    https = bloom.bloom_bits(valid.where(F.col("url").startswith("https:")), expected_items=n)
    http = bloom.bloom_bits(valid.where(~F.col("url").startswith("https:")), expected_items=n)
    return bloom.bloom_merge(https, http)


@register("new_urls_bloom", ORACLE_SQL["new_urls_exact"])
def q_new_urls_bloom(spark, sf):
    """A6 P3 (Bloom): URLs not yet processed; the filter spares the look-up of those it lacks."""
    processed = materialize(_processed(spark, sf))
    n = bloom.sized_for(processed)
    bits = materialize(bloom.bloom_bits(processed, expected_items=n))
    incoming = _log(spark, sf).select(F.col("key").alias("url"))
    return bloom.new_urls_bloom(incoming, bits, processed, expected_items=n)


# --------------------------------------------------------------------------- count-min

@register("cms_build", _CELLS)
def q_cms_build(spark, sf):
    """Sketch cells (row, bucket, cnt) of all kept words."""
    return cms.sketch_cells(_occurrences(spark, sf))


@register("cms_merge", f"""
SELECT row, bucket, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
  {_CELLS} UNION ALL {S.sketch_cells(_W_CONV, DEPTH, WIDTH, CMS_SEED)})
GROUP BY row, bucket""")
def q_cms_merge(spark, sf):
    """documents' sketch + conversations' sketch (cell-wise sum)."""
    conv = counts.word_occurrences(tables.conversations(spark, sf, ("text",)))
    return cms.merge_sketches(cms.sketch_cells(_occurrences(spark, sf)), cms.sketch_cells(conv))


@register("cms_estimate", _EST)
def q_cms_estimate(spark, sf):
    """A10: point estimate of every word in the vocabulary."""
    wc = _word_counts(spark, sf)
    return cms.estimate(wc.select("word"), _cells(spark, sf, wc))


@register("cms_heavy_hitters", _HH)
def q_cms_heavy_hitters(spark, sf):
    """Words of a vocabulary whose estimate is at least 0.1% of all words."""
    wc = _word_counts(spark, sf)
    return cms.heavy_hitter_estimates(wc, _cells(spark, sf, wc))


@register("cms_hierarchy", S.hierarchy_cells(_W, DEPTH, WIDTH, CMS_SEED))
def q_cms_hierarchy(spark, sf):
    """A8 for heavy hitters: the words' sketch and those of their hashes' prefixes."""
    return cms.hierarchy_cells(_occurrences(spark, sf))


@register("cms_hierarchy_heavy_hitters", _FOUND)
def q_cms_hierarchy_heavy_hitters(spark, sf):
    """A11 P8 from the sketch alone: hash prefixes are followed from the shortest on, and only found hashes meet words."""
    return cms.sketch_heavy_hitters(_occurrences(spark, sf), _hierarchy(spark, sf))


@register("cms_topk", f"{_HH} ORDER BY est DESC, word LIMIT {CMS_TOPK}")
def q_cms_topk(spark, sf):
    """O3: top k heavy hitters by estimate, from a sketch whose cells name their most frequent word."""
    return cms.named_topk(materialize(cms.named_cells(_occurrences(spark, sf))), CMS_TOPK)


@register("cms_audit", f"""
SELECT c.word, c.count, e.est, e.est - c.count AS err
FROM ({_WC}) c JOIN ({_EST}) e ON c.word = e.word""")
def q_cms_audit(spark, sf):
    """Exact count next to the estimate (err >= 0 always)."""
    wc = _word_counts(spark, sf)
    return cms.audit(wc, _cells(spark, sf, wc))


@register("topk_frequent_items", f"{_WC} ORDER BY count DESC, word LIMIT {CMS_TOPK}")
def q_topk_frequent_items(spark, sf):
    """The k most frequent words, proposed by Spark's frequent-items sketch and counted exactly."""
    return cms.frequent_items(_occurrences(spark, sf), CMS_TOPK)


@register("frequent_items_merged", f"""
SELECT word, CAST(count(*) AS BIGINT) AS count FROM ({_W} UNION ALL {_W_CONV}) GROUP BY word
ORDER BY count DESC, word LIMIT {CMS_TOPK}""")
def q_frequent_items_merged(spark, sf):
    """A12 over two tables: each one's frequent-items sketch is built and written on its own; the merged sketch proposes."""
    tables_ = [_occurrences(spark, sf), counts.word_occurrences(tables.conversations(spark, sf, ("text",)))]
    sketches = [materialize(cms.frequent_sketch(t)) for t in tables_]
    return cms.top_of_sketch(cms.merge_frequent(*sketches), tables_[0].unionByName(tables_[1]), CMS_TOPK)


# --------------------------------------------------------------------------- sinks

@register("saved_word_table", f"SELECT word AS words, count FROM ({_WC})")
def q_saved_word_table(spark, sf):
    """Save and publish the (words, count) table."""
    table = counts.count_words(_occurrences(spark, sf)).select(F.col("word").alias("words"), "count")
    return read_saved(spark, save_table(table, "term_counts", "saved"))


@register("saved_table_sql", f"SELECT word AS words, count FROM ({_WC}) ORDER BY count DESC, words LIMIT 25")
def q_saved_table_sql(spark, sf):
    """K6: ad-hoc SQL on the published table, from another session."""
    namespace = _namespace()
    table = counts.count_words(_occurrences(spark, sf)).select(F.col("word").alias("words"), "count")
    save_table(table, "term_counts", namespace)
    name = view_name("term_counts", namespace)
    return spark.newSession().sql(f"SELECT words, count FROM {name} ORDER BY count DESC, words LIMIT 25")


@register("topk_words_only", f"SELECT word FROM ({_HH}) ORDER BY est DESC, word LIMIT {CMS_TOPK}")
def q_topk_words_only(spark, sf):
    """K2: save and publish the top-k table (word)."""
    top = cms.named_topk(materialize(cms.named_cells(_occurrences(spark, sf))), CMS_TOPK).select("word")
    return read_saved(spark, save_table(top, "top_words", "saved"))


# --------------------------------------------------------------------------- streams

def _landed_docs(spark, sf):
    """Documents landed by the tasks that read them; (path, schema, bytes of a third)."""
    docs = _docs(spark, sf)
    path = land(docs, scratch_path(spark, "landing", "documents"), WAVES, key="doc_id")
    return path, docs.schema, max(1, landed_bytes(spark, path) // WAVES)


def _doc_stream(spark, sf):
    """Documents as a stream of at least three micro-batches."""
    path, schema, third = _landed_docs(spark, sf)
    return jobs.file_stream(spark, path, schema, max_bytes_per_trigger=third)


def _doc_words(spark, sf):
    return TX.explode_clean_words(_doc_stream(spark, sf), "text").withColumn("n", F.lit(1).cast("bigint"))


def _namespace():
    return f"run_{uuid.uuid4().hex[:8]}"


def _doc_job(spark, sf, mode):
    return jobs.TermJob(spark, TermConfig(mode=mode), namespace=_namespace()).run(_doc_stream(spark, sf))


@register("stream_word_count", _WC)
def q_stream_word_count(spark, sf):
    """Streaming word count in Spark's keyed state (complete mode), in three micro-batches or more."""
    query, sink = jobs.start_word_count(_doc_stream(spark, sf))
    jobs.await_done(query)
    return sink.read(spark)


@register("stream_word_count_seeded", ORACLE_SQL["word_count_seeded"])
def q_stream_word_count_seeded(spark, sf):
    """Streaming count whose state starts from the seed rows (a second stream)."""
    seed = counts.seed_state(spark, [(SEED_WORD, 1)])
    seed_path = scratch_path(spark, "landing", "seed")
    seed.write.parquet(seed_path)
    query, sink = jobs.start_word_count(_doc_stream(spark, sf),
                                        seed_stream=jobs.file_stream(spark, seed_path, seed.schema))
    jobs.await_done(query)
    return sink.read(spark)


@register("stream_batch_cap", f"SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS capped, true AS several FROM documents")
def q_stream_batch_cap(spark, sf):
    """A rate cap in bytes. Over all micro-batches: rows read in all, whether the files of every batch kept to the cap
    (a file that is larger than it comes alone), and whether there were three batches or more."""
    path, schema, third = _landed_docs(spark, sf)
    stream = jobs.file_stream(spark, path, schema, max_bytes_per_trigger=third)
    files = stream.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("bytes"))
    read = scratch_path(spark, "batch_files")
    query = (files.writeStream.outputMode("update").trigger(availableNow=True)
             .option("checkpointLocation", scratch_path(spark, "checkpoints", "batch_cap"))
             .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{read}/batch={number}")).start())
    jobs.await_done(query)
    batches = spark.read.parquet(read).groupBy("batch").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("files"))
    return batches.agg(F.sum("n").alias("n_rows"), F.every((F.col("bytes") <= third) | (F.col("files") == 1)).alias("capped"),
                       (F.count("*") >= 3).alias("several"))


@register("stream_cms", _CELLS)
def q_stream_cms(spark, sf):
    """The running sketch as keyed state of its cells; a batch writes the cells that it changed."""
    query, sink = jobs.start_cells(_doc_words(spark, sf), scratch_path(spark, "checkpoints", "cells"))
    jobs.await_done(query)
    return sink.read(spark)


@register("stream_both", f"SELECT word AS words, count FROM ({_WC})")
def q_stream_both(spark, sf):
    """Both outputs from words that are cut once; the totals."""
    return _doc_job(spark, sf, "both").term_counts()


@register("stream_both_topk", f"SELECT word FROM ({_HH}) ORDER BY est DESC, word LIMIT {CMS_TOPK}")
def q_stream_both_topk(spark, sf):
    """The sketch alone, whose frequent-items state names the words; the top k, from the published table."""
    job = _doc_job(spark, sf, "topk")
    return open_table(spark, "top_words", job.namespace)


@register("stream_state_read", f"SELECT word AS words, count FROM ({_WC})")
def q_stream_state_read(spark, sf):
    """A finished stream's totals, read from its checkpoint's state and nothing else."""
    checkpoint = scratch_path(spark, "checkpoints", "counts")
    query, _ = jobs.start_counts(_doc_words(spark, sf), checkpoint)
    jobs.await_done(query)
    return read_state(spark, checkpoint).toDF("words", "count")


def _page_texts(spark, sf):
    return materialize(TX.described_pages(tables.pages(spark, sf, ("url", "html"))), "page_texts")


def _url_job(spark, sf, membership="exact", config=TermConfig(mode="count"), every_wave=False):
    """The whole job on URLs: a run for each wave, each a job of its own that goes on from the state of the last."""
    log = materialize(_log(spark, sf), "arrivals")
    root, source = scratch_path(spark, "terms"), scratch_path(spark, "landing", "urls")
    texts, namespace = _page_texts(spark, sf), _namespace()
    for wave in range(WAVES):
        land(log.where(F.col("wave") == wave), source)
        job = jobs.TermJob(spark, config, root, pages=texts, membership=membership, namespace=namespace)
        job.run(jobs.file_stream(spark, source, log.schema), outputs=every_wave or wave == WAVES - 1)
    return job


_URL_WORDS = f"""
SELECT word AS words, CAST(count(*) AS BIGINT) AS count FROM (
  SELECT unnest({S.clean_words('description')}) AS word
  FROM ({_VALID}) WHERE url IN (SELECT key FROM ({_LOG})))
GROUP BY word"""


@register("stream_valid_dedup", f"SELECT words AS word, count FROM ({_URL_WORDS})")
def q_stream_valid_dedup(spark, sf):
    """URL stream -> distinct -> crawl -> valid -> not given out before -> words, with outputs after every wave."""
    return _url_job(spark, sf, every_wave=True).term_counts().withColumnRenamed("words", "word")


@register("stream_url_words", _URL_WORDS)
def q_stream_url_words(spark, sf):
    """The whole job (S1 P2 P3 T1 T2 P4 W7 A1 A3 K1): URL stream, exact membership; the published table."""
    return open_table(spark, "term_counts", _url_job(spark, sf).namespace)


@register("stream_url_words_bloom", _URL_WORDS)
def q_stream_url_words_bloom(spark, sf):
    """The same with Bloom membership (A5-A7 in the loop): equal at any size, as the filter's yes is confirmed."""
    return _url_job(spark, sf, "bloom").term_counts()


_URL_WORDS_SEEDED = f"""
SELECT words, CAST(sum(count) AS BIGINT) AS count FROM (
  SELECT words, count FROM ({_URL_WORDS}) UNION ALL SELECT '{SEED_WORD}', 1) GROUP BY words"""


@register("stream_url_words_seeded", _URL_WORDS_SEEDED)
def q_stream_url_words_seeded(spark, sf):
    """The job started from a count seed and a processed URL."""
    config = TermConfig(mode="both", seed_counts=((SEED_WORD, 1),), seed_urls=(SEED_URL,))
    return _url_job(spark, sf, "bloom", config).term_counts()


@register("stream_url_metrics", f"""
WITH log AS ({_LOG}),
firsts AS (SELECT key, min(wave) AS wave FROM log WHERE key IN (SELECT url FROM ({_VALID})) GROUP BY key),
nv AS (SELECT wave, count(*) AS n_valid FROM firsts GROUP BY wave)
SELECT CAST(row_number() OVER (ORDER BY l.wave) - 1 AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n_urls,
       CAST(count(DISTINCT l.key) AS BIGINT) AS n_distinct,
       CAST(coalesce(any_value(nv.n_valid), 0) AS BIGINT) AS n_valid
FROM log l LEFT JOIN nv ON nv.wave = l.wave GROUP BY l.wave""")
def q_stream_url_metrics(spark, sf):
    """Per micro-batch URLs received, distinct, and new valid URLs processed, as Spark observed them on the way."""
    return _ordinal(_collected(spark, sf).metrics())


@register("stream_url_offsets", f"""
SELECT CAST(b - 1 AS BIGINT) AS batch, 0 AS partition, CAST(b - 1 AS BIGINT) AS from_offset, CAST(b AS BIGINT) AS until_offset, n_rows
FROM (SELECT row_number() OVER (ORDER BY wave) AS b, CAST(count(*) AS BIGINT) AS n_rows FROM ({_LOG}) GROUP BY wave)""")
def q_stream_url_offsets(spark, sf):
    """The offset ranges of the live stream's batches, over three runs, from Spark's reports: each begins where the last ended."""
    return _ordinal(_collected(spark, sf).offsets()).drop("source")


def _collected(spark, sf):
    """The URL job's stage alone, a run for each wave."""
    log = materialize(_log(spark, sf), "arrivals")
    root, source, texts = scratch_path(spark, "terms"), scratch_path(spark, "landing", "urls"), _page_texts(spark, sf)
    for wave in range(WAVES):
        land(log.where(F.col("wave") == wave), source)
        job = jobs.TermJob(spark, TermConfig(mode="count"), root, pages=texts)
        job.run(jobs.file_stream(spark, source, log.schema), outputs=False)
    return job


def _ordinal(batches):
    """Batches numbered by turn: Spark also numbers those without input, which only clear state."""
    turn = batches.select("batch").distinct().withColumn("turn", F.row_number().over(Window.orderBy("batch")) - 1)
    return batches.join(turn, "batch").withColumn("batch", F.col("turn").cast("bigint")).drop("turn")


@register("stream_user_state", _URL_WORDS_SEEDED)
def q_stream_user_state(spark, sf):
    """Running counts of the valid pages' words by an update function of keyed state, begun from seed rows; a word without
    input for a day of event time would leave."""
    words = TX.explode_clean_words(_page_texts(spark, sf).join(_log(spark, sf).select(F.col("key").alias("url")).distinct(), "url"),
                                   "description")
    at = F.timestamp_seconds(F.lit(100_000)).alias("at")
    src, seed = scratch_path(spark, "landing", "words"), scratch_path(spark, "landing", "seed")
    land(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).select("word", "n", at), src)
    land(counts.seed_state(spark, [(SEED_WORD, 1)]).select("word", F.col("count").alias("n"), at), seed)
    schema = "word string, n bigint, at timestamp"
    state = idle_counts(jobs.file_stream(spark, src, schema, max_files_per_trigger=4), 86_400,
                        jobs.file_stream(spark, seed, schema), late_seconds=3_600)
    checkpoint = scratch_path(spark, "checkpoints", "user_state")
    sink = GrowingTable("user_state", ["word"], ["count"], _namespace())
    query = (state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .foreachBatch(sink).start())
    jobs.await_done(query)
    return sink.read(spark).withColumnRenamed("word", "words")


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
