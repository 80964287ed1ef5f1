"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings become grades 0 (quality 0), 1 (quality 1 but toxic) and 2 (quality 1, not toxic). One
weight vector over hashed text features is shared by all thresholds:
P(grade <= j) = sigmoid(theta_j - w.x), theta_0 < theta_1. From it follow the expected grade
and the tail probability P(grade >= KEEP_GRADE), by which documents are selected.

Features are hashed words (lower-cased, punctuation kept), their first 4 and 5 bytes, the shapes of
their edges, and how many words repeat the one before, with log counts, inverse document
frequency and unit length. Those count that mark a lower grade: LIFT times as frequent in it as in
the top grade, beyond chance (Z standard deviations). A document without marks is thus as good
as the thresholds say. The model is fitted on a bounded sample
(``TRAIN_DOCS`` labelled documents in the order of a hash of doc_id, each of at most
``TRAIN_BYTES``); scoring is one scan over whole texts without a shuffle, with the weights
(``DIMENSIONS`` numbers) broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.arrays import Words, mix, words
from wordlens.llm.worker import receive, send

DIMENSIONS = 1 << 18
GRADES = 3
KEEP_GRADE, KEEP_PROBABILITY = 2, 0.5
TRAIN_DOCS, TRAIN_BYTES = 6000, 60_000
STEPS, RATE, PENALTY = 150, 0.1, 1e-4
MIN_DOCUMENTS, LIFT, Z = 3, 4.0, 4.0
PREFIXES = (4, 5)


def _classes() -> np.ndarray:
    """Class of a byte: itself, but a for lower-case and other letters, A for upper case, 0 for digits."""
    out = np.arange(256, dtype=np.uint64)
    out[97:123] = out[128:] = 97
    out[65:91] = 65
    out[48:58] = 48
    return out


CLASSES = _classes()


def features(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, count) of a chunk of words, each pair of row and feature once."""
    if not len(w.starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    data, row = w.data, w.row()
    upper = (data >= 65) & (data <= 90)
    lowered = np.where(upper, data + 32, data).astype(np.uint8)
    hashed = Words(0, w.n_rows, lowered, w.starts, w.ends, w.first).hashes()
    kinds, rows = [hashed], [row]
    for k in PREFIXES:
        long = np.flatnonzero(w.ends - w.starts > k)
        own = Words(0, w.n_rows, lowered, w.starts[long], w.starts[long] + k, w.first)
        kinds.append(mix(own.hashes() + np.uint64(k)))
        rows.append(row[long])
    last = CLASSES[data[w.ends - 1]]
    before = CLASSES[data[np.maximum(w.ends - 2, w.starts)]]
    kinds.append(mix((CLASSES[data[w.starts]] << np.uint64(16)) + (before << np.uint64(8)) + last + np.uint64(1 << 24)))
    rows.append(row)
    again = np.flatnonzero((hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])) + 1
    repeats = np.bincount(row[again], minlength=w.n_rows)
    some = np.flatnonzero(repeats)
    kinds.append(mix((8 * repeats[some] // w.counts()[some]).astype(np.uint64) + np.uint64(1 << 32)))
    rows.append(some)
    pair, count = np.unique(np.concatenate(rows).astype(np.uint64) * np.uint64(DIMENSIONS)
                            + np.concatenate(kinds) % np.uint64(DIMENSIONS), return_counts=True)
    return (pair // np.uint64(DIMENSIONS)).astype(np.int64), (pair % np.uint64(DIMENSIONS)).astype(np.int64), count


def marks(row: np.ndarray, feature: np.ndarray, grade: np.ndarray) -> np.ndarray:
    """True for each feature that marks a grade below the highest there is."""
    top = grade.max()
    share = np.bincount(grade, minlength=top + 1)
    in_top = np.bincount(feature[(grade == top)[row]], minlength=DIMENSIONS)
    out = np.zeros(DIMENSIONS, bool)
    for g in range(top):
        if not share[g]:
            continue
        here = np.bincount(feature[(grade == g)[row]], minlength=DIMENSIONS)
        both, part = here + in_top, share[g] / (share[g] + share[top])
        beyond = (here - both * part) / np.sqrt(both * part * (1 - part) + 1e-9)
        lift = ((here + 0.5) / share[g]) / ((in_top + 0.5) / share[top])
        out |= (beyond > Z) & (lift > LIFT) & (both >= MIN_DOCUMENTS)
    return out


def _values(row, feature, count, idf, n_rows) -> np.ndarray:
    x = (1 + np.log(count)) * idf[feature]
    norm = np.sqrt(np.bincount(row, x * x, minlength=n_rows))
    return x / np.maximum(norm, 1e-12)[row]


@dataclass
class CumulativeLink:
    """weights over hashed features, thresholds in ascending order, idf by feature."""

    weights: np.ndarray
    thresholds: np.ndarray
    idf: np.ndarray

    def score(self, row, feature, count, n_rows: int) -> np.ndarray:
        x = _values(row, feature, count, self.idf, n_rows)
        return np.bincount(row, x * self.weights[feature], minlength=n_rows)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ... (a column each)."""
        z = np.clip(score[:, None] - self.thresholds[None, :], -40, 40)
        return 1 / (1 + np.exp(-z))


def train(row: np.ndarray, feature: np.ndarray, count: np.ndarray, grade: np.ndarray,
          steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> CumulativeLink:
    """Full-batch Adam on the cumulative-link log likelihood, each grade weighted by the square root of
    its share.

    Thresholds are theta_0 and positive steps beyond it, so they stay ordered. With no rows
    or a single grade, every document gets that grade (the top grade if there are none).
    """
    n = len(grade)
    present = np.unique(grade)
    if len(present) < 2:
        top = int(present[0]) if n else GRADES - 1
        sure = np.where(np.arange(1, GRADES) <= top, -30.0, 30.0)
        return CumulativeLink(np.zeros(DIMENSIONS), sure, np.ones(DIMENSIONS))
    marking = marks(row, feature, grade)
    df = np.bincount(feature, minlength=DIMENSIONS)
    idf = np.where(marking, np.log((n + 1) / (df + 1.0)) + 1, 0.0)
    own = marking[feature]
    row, feature, count = row[own], feature[own], count[own]
    x = _values(row, feature, count, idf, n)
    used, place = np.unique(feature, return_inverse=True)
    share = np.bincount(grade, minlength=GRADES)
    importance = (1 / np.sqrt(np.maximum(share, 1)))[grade]
    importance /= importance.sum()
    w, theta = np.zeros(len(used)), np.array([-2.0] + [0.0] * (GRADES - 2))  # theta: the first, then logs of steps
    moments = [np.zeros(len(used) + GRADES - 1) for _ in range(2)]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for t in range(1, steps + 1):
        s = np.bincount(row, x * w[place], minlength=n)
        cuts = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper, lower = edges[grade + 1] - s, edges[grade] - s
        p_up = np.where(np.isinf(upper), 1.0, sigmoid(np.where(np.isinf(upper), 0, upper)))
        p_low = np.where(np.isinf(lower), 0.0, sigmoid(np.where(np.isinf(lower), 0, lower)))
        p = np.maximum(p_up - p_low, 1e-9)
        g_up, g_low = importance * p_up * (1 - p_up) / p, -importance * p_low * (1 - p_low) / p
        ds = -(g_up + g_low)  # of the log likelihood by each score
        d_cuts = np.bincount(np.clip(grade, 0, GRADES - 2), np.where(grade < GRADES - 1, g_up, 0), minlength=GRADES - 1)
        d_cuts += np.bincount(np.clip(grade - 1, 0, GRADES - 2), np.where(grade > 0, g_low, 0), minlength=GRADES - 1)
        tail = np.cumsum(d_cuts[::-1])[::-1]
        d_theta = np.concatenate([tail[:1], tail[1:] * np.exp(theta[1:])])
        gradient = np.concatenate([np.bincount(place, x * ds[row], minlength=len(used)) - penalty * w, d_theta])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient ** 2
        step = rate * (moments[0] / (1 - 0.9 ** t)) / (np.sqrt(moments[1] / (1 - 0.99 ** t)) + 1e-8)
        w, theta = w + step[:len(used)], theta + step[len(used):]
    weights = np.zeros(DIMENSIONS)
    weights[used] = w
    return CumulativeLink(weights, np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])])), idf)


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade), one row per doc_id: the lowest grade given to it. Rows without a doc_id or
    quality are left out; a missing toxic flag counts as 0."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) > 0
    grade = F.when(F.col("quality") <= 0, 0).when(toxic, 1).otherwise(2)
    return (labels.where("doc_id is not null and quality is not null")
            .groupBy("doc_id").agg(F.min(grade).alias("grade")))


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS,
        train_bytes: int = TRAIN_BYTES, **how) -> CumulativeLink:
    """The model, from at most train_docs labelled documents of at most train_bytes bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column("text")):
                row, feature, count = features(w)
                at = np.searchsorted(row, np.arange(w.n_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(v.astype(np.int32)))
                         for v in (feature, count)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grade").slice(w.first_row, w.n_rows), *lists], ["grade", "feature", "count"])

    spark = docs.sparkSession
    chosen = grades(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    chosen = spark.createDataFrame(chosen.toPandas(), "doc_id bigint, grade int")
    own = (docs.where(F.octet_length("text") <= train_bytes).select(F.col("doc_id").cast("bigint"), "text")
           .join(F.broadcast(chosen), "doc_id")  # train_docs rows of two numbers
           .groupBy("doc_id", "grade").agg(F.min("text").alias("text")).select("grade", "text"))
    found = own.mapInArrow(run, "grade int, feature array<int>, count array<int>").toArrow()
    lists = found.column("feature").combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.int32()))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = [found.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) if found.num_rows
            else np.empty(0, np.int64) for c in ("feature", "count")]
    return train(np.repeat(np.arange(len(sizes)), sizes), *flat, found.column("grade").to_numpy().astype(np.int64), **how)


def _score(docs: DataFrame, model: CumulativeLink, keep_probability: float, only_kept: bool) -> DataFrame:
    """docs' columns, then expected_grade, p_good and keep (only_kept: just docs' kept rows)."""
    shared = send(docs.sparkSession, model)
    names = list(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = receive(shared)
        for batch in batches:
            scores = np.concatenate([np.empty(0)] + [
                model.score(*features(w), w.n_rows) for w in words(batch.column("text"))])
            tails = model.tails(scores)
            good = tails[:, KEEP_GRADE - 1]
            keep = pa.array(good >= keep_probability)
            own = [batch.column(c) for c in names]
            if only_kept:
                yield pa.RecordBatch.from_arrays(own, names).filter(keep)
            else:
                yield pa.RecordBatch.from_arrays(
                    own + [pa.array(tails.sum(axis=1)), pa.array(good), keep],
                    names + ["expected_grade", "p_good", "keep"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    extra = "" if only_kept else ", expected_grade double, p_good double, keep boolean"
    return docs.mapInArrow(run, schema + extra)


def score_quality(docs: DataFrame, labels: DataFrame, keep_probability: float = KEEP_PROBABILITY,
                  **how) -> DataFrame:
    """(doc_id, expected_grade, p_good, keep) per row of docs(doc_id, text).

    expected_grade lies between 0 and 2; p_good is P(grade >= 2), keep is p_good >=
    keep_probability. A null text is empty and gets what a text without features gets.
    Repeated rows give repeated rows; other columns are ignored; an empty table gives an empty one;
    without usable labels every document is kept.
    """
    scored = _score(docs.select("doc_id", "text"), fit(docs, labels, **how), keep_probability, False)
    return scored.drop("text")


def keep_good(docs: DataFrame, labels: DataFrame, keep_probability: float = KEEP_PROBABILITY, **how) -> DataFrame:
    """The rows of docs that score_quality would keep, with docs' columns."""
    return _score(docs, fit(docs, labels, **how), keep_probability, True)
