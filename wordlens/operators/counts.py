"""Exact word counts: occurrences, counts, seeded and merged state, ordering, top-k.

Every count is a ``groupBy(word)`` hash aggregate: partial counts are combined inside
each map task, so a word holding a third of all tokens still sends one row per task
through the shuffle, and AQE sizes the final partitions at run time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordlens.functions.text import clean_words, explode_clean_words, tokenize
from wordlens.operators.lookup import ROW_BYTES, broadcast_limit_bytes
from wordlens.params import SHIPPED_STOP_WORDS
from wordlens.session import materialize

STATE_SCHEMA = T.StructType([T.StructField("word", T.StringType(), False),
                             T.StructField("count", T.LongType(), False)])


def token_positions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pos, word): every lower-cased token with its 1-based position."""
    return (docs.select(key, F.posexplode(tokenize(text)).alias("p", "word"))
            .select(key, (F.col("p") + 1).cast("bigint").alias("pos"), "word"))


def clean_word_positions(docs: DataFrame, key: str = "doc_id", text: str = "text",
                         stop_words: Iterable[str] = SHIPPED_STOP_WORDS,
                         drop_empty: bool = True) -> DataFrame:
    """(key, pos, word) after stop-word removal; positions count kept words only."""
    words = clean_words(text, stop_words, drop_empty)
    return (docs.select(key, F.posexplode(words).alias("p", "word"))
            .select(key, (F.col("p") + 1).cast("bigint").alias("pos"), "word"))


def without_stop_table(words: DataFrame, stops: DataFrame, word: str = "word", stop: str = "word") -> DataFrame:
    """Rows of ``words`` whose word is not in a stop list of any length, given as a table (compared in lower case).

    An anti-join: other columns, as positions, are kept, and no word is a literal of the plan. The list is written as a table of
    its distinct words first. Within the broadcast threshold it is broadcast; else rows and list are dealt out by word and the list's
    part is hashed, so a task holds its share of the list and no rows, however often a word occurs (a sort-merge join
    sorts all rows of a word in one task), and the runtime may split a word's rows over tasks, as both sides are plain shuffles.
    Rows with a null word are kept; nulls in the list are ignored.
    """
    listed = materialize(stops.select(F.lower(stop).alias("_stop")).where("_stop is not null").distinct(), "stop_words")
    size = listed.agg(F.sum(F.octet_length("_stop") + ROW_BYTES)).first()[0] or 0
    small = size <= broadcast_limit_bytes(words.sparkSession)
    return words.join(listed.hint("broadcast" if small else "shuffle_hash"), F.col(word) == F.col("_stop"), "left_anti")


def word_occurrences(docs: DataFrame, text: str = "text",
                     stop_words: Iterable[str] = SHIPPED_STOP_WORDS,
                     drop_empty: bool = True) -> DataFrame:
    """One row per kept word occurrence: (word)."""
    return explode_clean_words(docs, text, stop_words, drop_empty)


def count_words(words: DataFrame) -> DataFrame:
    """(word, count) from a column of word occurrences."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_count(docs: DataFrame, text: str = "text",
               stop_words: Iterable[str] = SHIPPED_STOP_WORDS,
               drop_empty: bool = True) -> DataFrame:
    return count_words(word_occurrences(docs, text, stop_words, drop_empty))


def seed_state(spark: SparkSession, seeds: Iterable[tuple[str, int]]) -> DataFrame:
    """A small (word, count) table of initial counts."""
    return spark.createDataFrame([(w, int(n)) for w, n in seeds], STATE_SCHEMA)


def merge_counts(state: DataFrame, delta: DataFrame) -> DataFrame:
    """New running totals = old totals + this batch's counts (both (word, count))."""
    return (state.select("word", "count").unionByName(delta.select("word", "count"))
            .groupBy("word").agg(F.sum("count").cast("bigint").alias("count")))


def word_count_seeded(docs: DataFrame, seed: DataFrame, text: str = "text",
                      stop_words: Iterable[str] = SHIPPED_STOP_WORDS,
                      drop_empty: bool = True) -> DataFrame:
    """Word count whose state starts from ``seed``: seed rows join the same aggregate.

    The occurrences are summed with the seed in one hash aggregate (no second pass).
    """
    ones = (word_occurrences(docs, text, stop_words, drop_empty)
            .select("word", F.lit(1).cast("bigint").alias("count")))
    return merge_counts(seed, ones)


def ordered_words(counts: DataFrame) -> DataFrame:
    """All (word, count) by count descending; ties by word, so the order is total."""
    return counts.orderBy(F.desc("count"), F.asc("word"))


def top_words(counts: DataFrame, k: int, score: str = "count") -> DataFrame:
    """The k best rows by ``score`` (then word): a bounded top-k, not a full sort."""
    return counts.orderBy(F.desc(score), F.asc("word")).limit(k)
