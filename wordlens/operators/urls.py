"""URL-log operators: offsets, compaction, in-batch and cross-batch de-duplication.

Exact "already processed" membership is an anti-join against a ``processed_urls``
table; Catalyst picks a broadcast or a shuffled hash/sort-merge anti-join from its size
(and AQE re-plans it at run time), so the filter never passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlens.functions.text import clean_words, described_pages
from wordlens.params import SHIPPED_STOP_WORDS


def offset_ranges(log: DataFrame, topic: str = "topic", partition: str = "partition",
                  offset: str = "offset") -> DataFrame:
    """Per (topic, partition): first offset, one past the last offset, record count."""
    return (log.groupBy(topic, partition)
            .agg(F.min(offset).alias("from_offset"),
                 (F.max(offset) + 1).alias("until_offset"),
                 F.count(F.lit(1)).alias("n")))


def latest_per_key(log: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """The record with the highest ``order`` for each key (a compacted topic's view).

    Expressed as ``max(struct(order, values...))`` so it aggregates partially inside
    each map task: a key holding a third of the log still ships one row per task,
    where a row_number window would sort all its rows in one task.
    """
    best = F.max(F.struct(F.col(order), *[F.col(v) for v in values])).alias("best")
    return (log.groupBy(key).agg(best)
            .select(key, *[F.col(f"best.{c}").alias(c) for c in [order, *values]]))


def distinct_urls(urls: DataFrame, url: str = "url") -> DataFrame:
    """Unique URLs of a batch (hash aggregate, partial de-dup in each map task)."""
    return urls.select(url).distinct()


def fewer_repeats(df: DataFrame, key: str) -> DataFrame:
    """``df`` without the later rows of a key within each Arrow batch (10,000 rows by default): for streams, whose
    ``dropDuplicates`` sends every row to its key's task. A key with a third of the rows is one row a batch by then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = pc.dictionary_encode(batch.column(key), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            first = np.unique(codes, return_index=True)[1]
            yield batch.take(pa.array(np.sort(first)))

    return df.mapInArrow(run, df.schema)


def new_urls_exact(batch: DataFrame, processed: DataFrame, url: str = "url") -> DataFrame:
    """Distinct URLs of ``batch`` that are not in the ``processed`` table."""
    return distinct_urls(batch, url).join(processed.select(url).distinct(), url, "left_anti")


def valid_pages(pages: DataFrame, url: str = "url", html: str = "html",
                stop_words=SHIPPED_STOP_WORDS, drop_empty: bool = True,
                **container) -> DataFrame:
    """(url, text): pages whose description exists, with the cleaned description text.

    Pages without a description are dropped here, so they are never remembered as
    processed and are tried again when their URL comes back.
    """
    return (described_pages(pages, url, html, **container)
            .select("url", F.array_join(clean_words(F.col("description"), stop_words,
                                                    drop_empty), " ").alias("text")))


def keep_valid(items: DataFrame, valid_keys: DataFrame, key: str) -> DataFrame:
    """Items whose key is in ``valid_keys`` (a semi-join: never duplicates an item)."""
    return items.join(valid_keys.select(key), key, "left_semi")


def url_pages(urls: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """URL -> page lookup (equi-join); a URL with no crawled page drops out."""
    return urls.join(pages, url, "inner")


def first_valid_wave(log: DataFrame, valid: DataFrame, key: str = "key",
                     wave: str = "wave") -> DataFrame:
    """Cross-batch dedup of a replayed log, computed in one pass.

    A URL is processed in the first batch it arrives in once it is valid; later
    arrivals are filtered. Returns (url, wave) pairs that are processed: the first
    arrival of each valid URL. Invalid URLs never become members. The log is aggregated before
    the join, so a URL that is a third of it is one row by then.
    """
    firsts = log.groupBy(F.col(key).alias("url")).agg(F.min(F.col(wave)).alias("wave"))
    return firsts.join(valid.select("url"), "url", "left_semi")


def batch_url_counts(log: DataFrame, valid: DataFrame, key: str = "key",
                     batch: Column | None = None) -> DataFrame:
    """Per batch: URLs received, distinct URLs, and URLs new and valid in that batch."""
    batch_col = batch if batch is not None else F.col("wave")
    arrivals = log.select(F.col(key).alias("url"), batch_col.alias("batch"))
    firsts = first_valid_wave(log.withColumn("wave", batch_col), valid, key=key)
    new_valid = firsts.groupBy(F.col("wave").alias("batch")).agg(
        F.count(F.lit(1)).alias("n_valid"))
    received = arrivals.groupBy("batch").agg(F.count(F.lit(1)).alias("n_urls"),
                                             F.countDistinct("url").alias("n_distinct"))
    return (received.join(new_valid, "batch", "left")
            .select("batch", "n_urls", "n_distinct",
                    F.coalesce("n_valid", F.lit(0)).cast("bigint").alias("n_valid")))
