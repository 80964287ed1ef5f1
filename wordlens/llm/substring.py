"""Substring dedup with suffix automata: words covered by a window that an earlier document has.

A window is ``WINDOW`` consecutive words. Its anchor is its smallest ``ANCHOR_WORDS``-gram hash
(the leftmost at ties), so equal windows have equal anchors wherever they stand,
and one anchor serves a run of neighbouring windows. The search goes from cheap to dear:

1. Runs (anchor, hash of the run's words) of all documents; only anchors that two
   documents share go on. Everything else is settled without its text.
2. A run that a document with a smaller id has word for word needs no text either: it goes as a whole.
3. Of anchors with unlike runs, each distinct run is looked into once: the distinct runs of an anchor are a reference shard. Its suffix
   automaton grows online, in ascending doc_id: each run is streamed for its matching
   statistics against all earlier documents' runs, then added. Ends whose longest match
   is at least a window mark a window.
4. An anchor with more than ``HOT_RUNS`` distinct runs (a common line in unlike surroundings)
   would make a shard without bound: its windows are keyed one by one, by the hash of the
   whole window, and settled by a group minimum, which partial aggregation keeps even.

Spark deals the shards out by anchor and streams each in sorted order, so a task holds one
shard's automaton (of at most HOT_RUNS runs) at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlens.llm.arrays import gram_hashes, span_hashes, texts, words
from wordlens.llm.names import free
from wordlens.session import materialize

WINDOW, ANCHOR_WORDS, HOT_RUNS = 50, 16, 1000
LAST_ID = (1 << 63) - 1


def sliding_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """Place of the smallest (leftmost at ties) of the w values from each place on."""
    done, out = 1, np.arange(len(x))
    while done < w:
        step = min(done, w - done)
        left, right = out[:-step], out[step:]
        out = np.where(x[right] < x[left], right, left)
        done += step
    return out


def row_key(docs: DataFrame) -> dict[str, Column]:
    """A null doc_id comes after all others."""
    return {"id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)),
            "th": F.xxhash64("text")}


def runs(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """(anchor, span, id, th, start, n) of docs(id, th, text): from word ``start`` on, n
    windows share the anchor; span is the hash of all their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column("text")):
                if len(w.starts) < window:
                    continue
                h = w.hashes()
                grams = gram_hashes(h, anchor)
                least = sliding_argmin(grams, window - anchor + 1)
                row = w.row()
                ok = np.flatnonzero(row[: len(least)] == row[window - 1: window - 1 + len(least)])
                if not len(ok):
                    continue
                new = np.ones(len(ok), bool)
                new[1:] = (least[ok[1:]] != least[ok[:-1]]) | (ok[1:] != ok[:-1] + 1)
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(ok)))
                first = ok[at]
                take = pa.array(w.first_row + row[first])
                yield pa.RecordBatch.from_arrays([
                    pa.array(grams[least[first]].view(np.int64)),
                    pa.array(span_hashes(h, first, first + n - 1 + window).view(np.int64)),
                    batch.column("id").take(take), batch.column("th").take(take),
                    pa.array((first - w.first[row[first]]).astype(np.int32)),
                    pa.array(n.astype(np.int32))], ["anchor", "span", "id", "th", "start", "n"])

    return docs.select("id", "th", "text").mapInArrow(
        run, "anchor bigint, span bigint, id bigint, th bigint, start int, n int")


class SuffixAutomaton:
    """Suffix automaton of several word sequences, extended online."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, nexts: dict, link: int) -> int:
        self.next.append(nexts)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _target(self, p: int, word, q: int) -> int:
        """The state for p's string with word, split off from q if q has longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = own
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = own
            p = self.link[p]
        return own

    def add(self, sequence) -> None:
        last = 0
        for word in sequence:
            q = self.next[last].get(word)
            if q is not None:
                last = self._target(last, word, q)
                continue
            own = self._state(self.length[last] + 1, {}, 0)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = own
                p = self.link[p]
            if p >= 0:
                self.link[own] = self._target(p, word, self.next[p][word])
            last = own

    def matching_statistics(self, sequence) -> list[int]:
        """For each place, the length of the longest match that ends there."""
        state = length = 0
        out = []
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                length = 0
            out.append(length)
        return out


def _spans_of_shared(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words of the runs listed for each text; one row a window for hot anchors."""
    names = ["key", "span", "words", "id", "th", "start", "n", "hot"]
    for batch in batches:
        listed = batch.column("runs").to_pylist()
        for w in words(batch.column("text")):
            rows = []
            h = w.hashes()
            ids = batch.column("id").slice(w.first_row, w.n_rows).to_pylist()
            ths = batch.column("th").slice(w.first_row, w.n_rows).to_pylist()
            for r in range(w.n_rows):
                base = int(w.first[r])
                for x in listed[w.first_row + r]:
                    a, n = base + x["start"], x["n"]
                    if x["hot"]:
                        at = np.arange(a, a + n)
                        keys = span_hashes(h[a:a + n - 1 + window], at - a, at - a + window)
                        rows += [(int(k), 0, None, ids[r], ths[r], x["start"] + i, 1, True)
                                 for i, k in enumerate(keys.view(np.int64))]
                    else:
                        own = b" ".join(w.text(i) for i in range(a, a + n - 1 + window))
                        rows.append((x["anchor"], x["span"], own, ids[r], ths[r], x["start"], n, False))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(),
                         pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _match(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Distinct runs sorted by (key, id, span): the windows of each that an earlier
    document's run has, as (anchor, span, offset, count) relative to the run."""
    key, automaton, waiting, waiting_id = None, None, [], None
    for batch in batches:
        out = []
        for k, span, own, doc in zip(*(batch.column(c).to_pylist() for c in ("key", "span", "words", "id"))):
            if k != key:
                key, automaton, waiting = k, SuffixAutomaton(), []
            elif doc != waiting_id:
                for x in waiting:  # of one document: no reference to one another
                    automaton.add(x)
                waiting = []
            waiting_id = doc
            sequence = own.split(b" ")
            ends = np.flatnonzero(np.array(automaton.matching_statistics(sequence)) >= window)
            if len(ends):
                cut = np.flatnonzero(np.diff(ends) > 1) + 1
                for part in np.split(ends, cut):
                    out.append((k, span, int(part[0]) - window + 1, len(part)))
            if len(ends) < len(sequence) - window + 1:
                waiting.append(sequence)
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 2 + [pa.int32()] * 2)],
                ["anchor", "span", "offset", "count"])


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR_WORDS,
                     hot_runs: int = HOT_RUNS) -> DataFrame:
    """(id, th, start, n) of docs(id, th, text): n consecutive windows from word ``start``
    on, each of which also starts in a document with a smaller id. May overlap."""
    found = materialize(runs(docs, window, anchor), "substring_runs")
    # tables of their own: a join right above an aggregation can't split a common anchor's rows
    shared = materialize(found.groupBy("anchor").agg(
        F.min("id").alias("a"), F.max("id").alias("b"), F.min("span").alias("low"), F.max("span").alias("high"))
        .where("a < b").select("anchor", (F.col("low") != F.col("high")).alias("unlike")), "substring_anchors")
    known = materialize(found.join(shared, "anchor"), "substring_shared")
    # a run that a smaller id has word for word goes as a whole; only first runs are looked into
    firsts = materialize(known.groupBy("anchor", "span", "unlike").agg(F.min("id").alias("first_id")), "substring_spans")
    sizes = materialize(firsts.where("unlike").groupBy("anchor").agg((F.count("*") > hot_runs).alias("hot")), "substring_sizes")
    settled = materialize(known.join(firsts, ["anchor", "span", "unlike"]), "substring_firsts")
    copies = settled.where("id > first_id").select("id", "th", "start", "n")
    first_runs = settled.where("unlike and id = first_id")
    lists = first_runs.join(sizes, "anchor").groupBy("id", "th").agg(
        F.collect_set(F.struct("anchor", "span", "start", "n", "hot")).alias("runs"))
    spans = materialize(docs.select("id", "th", "text").join(lists, ["id", "th"])
                        .mapInArrow(lambda b: _spans_of_shared(b, window),
                                    "key bigint, span bigint, words binary, id bigint, th bigint, "
                                    "start int, n int, hot boolean"), "substring_spans")
    distinct = spans.where("not hot").dropDuplicates(["key", "span"])
    matched = (distinct.select("key", "span", "words", "id").repartition("key").sortWithinPartitions("key", "id", "span")
               .mapInArrow(lambda b: _match(b, window), "anchor bigint, span bigint, offset int, count int"))
    partly = first_runs.join(matched, ["anchor", "span"]).select(
        "id", "th", (F.col("start") + F.col("offset")).alias("start"), F.col("count").alias("n"))
    hot = spans.where("hot").select("key", "id", "th", "start", "n")
    least = hot.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    common = hot.join(least, "key").where("id > a").select("id", "th", "start", "n")
    return copies.unionByName(partly).unionByName(common)


def _cut(batches: Iterator[pa.RecordBatch], window: int, keep_columns: list[str] | None,
         schema_names: list[str], marked: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = batch.column(marked).to_pylist()
        n_words, n_removed, digests, kept_texts = [], [], [], []
        for text, own in zip(texts(batch.column("text")), marks):
            parts = text.split()
            n_words.append(len(parts))
            if own:
                gone = np.zeros(len(parts) + 1, np.int64)
                for m in own:
                    gone[m["start"]] += 1
                    gone[m["start"] + m["n"] - 1 + window] -= 1
                keep = np.cumsum(gone)[:-1] == 0
                kept = [p for p, k in zip(parts, keep.tolist()) if k]
            else:
                kept = parts
            n_removed.append(len(parts) - len(kept))
            if keep_columns is None:
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            else:
                kept_texts.append((text if len(kept) == len(parts) else b" ".join(kept)).decode("utf-8", "replace"))
        if keep_columns is None:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(digests, pa.string())], schema_names)
            continue
        some = pa.array([a > b or not a for a, b in zip(n_words, n_removed)], pa.bool_())
        columns = {c: batch.column(c) for c in keep_columns}
        was_null = batch.column("text").is_null().to_pylist()
        columns["text"] = pa.array([None if z else t for z, t in zip(was_null, kept_texts)], pa.string())
        if "n_chars" in columns:
            columns["n_chars"] = pa.array(
                [old if not cut else len(t) for old, cut, t in
                 zip(columns["n_chars"].to_pylist(), n_removed, kept_texts)], pa.int64())
        yield pa.RecordBatch.from_arrays([columns[c] for c in schema_names], schema_names).filter(some)


def _marked(docs: DataFrame, window: int, **how) -> tuple[DataFrame, str]:
    """docs with a column of the marked windows, and its name."""
    own_id, own_hash, marked = free(docs.columns, "id", "hash", "marks")
    key = row_key(docs)
    keyed = docs.withColumns({own_id: key["id"], own_hash: key["th"]})
    own = keyed.select(F.col(own_id).alias("id"), F.col(own_hash).alias("th"), "text")
    marks = repeated_windows(own, window, **how).groupBy("id", "th").agg(
        F.collect_set(F.struct("start", "n")).alias("marks"))
    marks = marks.select(F.col("id").alias(own_id), F.col("th").alias(own_hash), F.col("marks").alias(marked))
    return keyed.join(marks, [own_id, own_hash], "left").drop(own_id, own_hash), marked


def removal_digest(docs: DataFrame, window: int = WINDOW, **how) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row of docs(doc_id, text).

    Words are maximal runs of non-white-space (ASCII). A word goes if a window that covers it
    also starts in a document with a smaller doc_id; windows are judged on the input. A
    null text has no words. A null doc_id comes after all others (such rows remove nothing
    from one another). Rows that share a doc_id are one document in this respect: they
    take nothing from one another either. Other columns are ignored; an empty
    table gives an empty one.
    """
    cut, marked = _marked(docs.select("doc_id", "text"), window, **how)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return cut.mapInArrow(lambda b: _cut(b, window, None, names, marked),
                             f"doc_id {dict(docs.dtypes)['doc_id']}, n_words bigint, "
                             "n_removed bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, **how) -> DataFrame:
    """docs with the repeated words removed (kept words joined by a space; a text that loses
    nothing stays as it is); rows that lose all their words go. Columns as in docs;
    n_chars, if there, follows the text."""
    names = list(docs.columns)
    cut, marked = _marked(docs, window, **how)
    schema = ", ".join(f"`{c}` {'bigint' if c == 'n_chars' else t}" for c, t in docs.dtypes)
    return cut.mapInArrow(lambda b: _cut(b, window, names, names, marked), schema)
