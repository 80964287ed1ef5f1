"""Keyed state with a function of the user's own and an idle time-out, and reading a query's state from outside.

Plain counts need neither: Spark's aggregation keeps them on the JVM (``jobs``). The function here is for state that an
aggregation can't express, as leaving after a time without input.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Rows of the update function's output: the running count, and whether the word has just left for want of input.
COUNTED = "word string, count bigint, gone boolean"


def idle_counts(words: DataFrame, idle_seconds: float, seeds: DataFrame | None = None, late_seconds: float = 0) -> DataFrame:
    """Running counts (word, count, gone) of a stream words(word, n, at), changed words only; a word without input for
    ``idle_seconds`` of event time leaves with its last count and starts anew if it comes back.

    ``seeds`` (the same columns, a stream) gives the initial state. Event time moves with the watermark, ``late_seconds`` behind
    the latest ``at``; a row older than that is dropped by Spark. A null word or n is no input.
    """
    idle = int(idle_seconds * 1000)

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (count,) = state.get
            state.remove()
            yield pd.DataFrame({"word": [key[0]], "count": [count], "gone": [True]})
            return
        count, last = state.get if state.exists else (0,), 0
        count = count[0]
        for batch in batches:
            count += int(batch["n"].sum())
            last = max(last, int(batch["at"].max()))
        state.update((count,))
        state.setTimeoutTimestamp(max(last + idle, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"word": [key[0]], "count": [count], "gone": [False]})

    every = words.select("word", "n", "at")
    if seeds is not None:
        every = every.unionByName(seeds.select("word", "n", "at"))
    timed = (every.where("word is not null and n is not null and at is not null").withWatermark("at", f"{late_seconds} seconds")
             .select("word", F.col("n").cast("bigint").alias("n"), F.col("at").alias("event_time"),
                     F.unix_millis("at").alias("at")))
    return timed.groupBy("word").applyInPandasWithState(update, COUNTED, "count bigint", "update", GroupStateTimeout.EventTimeTimeout)


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Keys and values of a stateful operator as of the last batch, from the checkpoint alone (the query may have ended)."""
    found = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return found.select("key.*", "value.*")  # names are those of the query's plan
