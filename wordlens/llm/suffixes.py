"""Sparse suffix arrays: repeated passages of documents from sorted suffixes at minimisers.

1. Kept suffixes start at content-selected places: the smallest ``GRAM``-gram hash of every ``SPAN`` words'
   grams (a minimiser), so a passage of ``MIN_WORDS`` words has one within its first SPAN places wherever it
   stands, and at least KEY = MIN_WORDS - SPAN + 1 words of the passage follow it.
2. Only suffixes whose first KEY words start another document's suffix too go on. Of those with
   equal surroundings (SPAN - 1 words on either side) all but the first are matches as they stand; the first takes part
   in the sort, with its surroundings as 24-bit symbols. So copies of any number cost one row in the sort.
3. Sort by (key, right symbols): neighbours share the longest prefixes. Each suffix is compared with
   the ``NEIGHBOURS`` before it; a match is extended right by the sorted symbols and left by
   the others. Matches of at least MIN_WORDS words count. The sort deals rows out by range,
   which splits a common key; the rows at a range's end are carried to the next one.
4. The windows of MIN_WORDS words that hold the key of a first document's suffix (also where it stands again with the
   same surroundings) start at one of SPAN places. Each is matched with the first document that has it, by a group minimum of its 64-bit hash; so what the few neighbours leave out is found
   however many texts share the key.
5. Matches of two documents on one diagonal that touch or overlap are one passage.

So every window of MIN_WORDS words that stands in a document with a smaller id is covered. The group minimum has one row
a task for a window, however many documents share it.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordlens.llm.arrays import gram_hashes, mix, span_hashes, words
from wordlens.llm.substring import LAST_ID, row_key, sliding_argmin
from wordlens.session import materialize

MIN_WORDS, GRAM, SPAN, NEIGHBOURS = 50, 8, 24, 4
SEPARATOR = 0  # a symbol that stands for no word: before the first or after the last


def suffix_places(docs: DataFrame, min_words: int = MIN_WORDS, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(key, content, id, th, place, before, length) of docs(id, th, text): the kept suffixes with at least a
    key's words. content is the hash of the key's words and span - 1 on either side, as far as the text goes; before
    counts those on the left, length all of them."""
    key_words = min_words - span + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column("text")):
                h, row = w.hashes(), w.row()
                if len(h) < min_words:
                    continue
                least = sliding_argmin(gram_hashes(h, gram), span)
                whole = np.flatnonzero(row[:len(h) - min_words + 1] == row[min_words - 1:])
                at = np.unique(least[whole])
                at = at[at + key_words <= len(h)]
                at = at[row[at] == row[at + key_words - 1]]
                first, last = w.first[row[at]], w.first[row[at] + 1]
                left, right = np.maximum(at - span + 1, first), np.minimum(at + key_words + span - 1, last)
                take = pa.array(w.first_row + row[at])
                # a text's edge is part of the content, so that equal contents end alike
                content = span_hashes(h, left, right) ^ mix(((at - left) * 4096 + right - at).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(gram_hashes(h, key_words)[at].view(np.int64)), pa.array(content.view(np.int64)),
                    batch.column("id").take(take), batch.column("th").take(take), pa.array((at - first).astype(np.int32)),
                    pa.array((at - left).astype(np.int16)), pa.array((right - left).astype(np.int16))],
                    ["key", "content", "id", "th", "place", "before", "length"])

    return docs.select("id", "th", "text").mapInArrow(
        run, "key bigint, content bigint, id bigint, th bigint, place int, before smallint, length smallint")


def _surroundings(batches: Iterator[pa.RecordBatch], key_words: int, reach: int) -> Iterator[pa.RecordBatch]:
    """The listed suffixes of each text that are to be sorted, with ``reach`` symbols to the right of the key, and to the left (nearest first)."""
    for batch in batches:
        listed = batch.column("suffixes").to_pylist()
        for w in words(batch.column("text")):
            symbols = (w.hashes() >> np.uint64(40)).astype(np.uint32)
            symbols[symbols == SEPARATOR] = 1
            sizes = w.counts()
            found = [(r, x["key"], x["place"]) for r in range(w.n_rows) for x in listed[w.first_row + r] if x["sorted"]]
            if not found:
                continue
            row, keys, place = (np.array(x, np.int64) for x in zip(*found))

            def around(offsets: np.ndarray) -> list[bytes]:
                at = place[:, None] + offsets[None, :]
                inside = (at >= 0) & (at < sizes[row][:, None])
                own = np.where(inside, symbols[np.where(inside, at + w.first[row][:, None], 0)], SEPARATOR).astype(">u4")
                return [x.tobytes() for x in own.view(np.uint8).reshape(len(row), -1, 4)[:, :, 1:]]

            take = pa.array(w.first_row + row)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys), pa.array(around(np.arange(key_words, key_words + reach)), pa.binary()),
                pa.array(around(-1 - np.arange(reach)), pa.binary()), batch.column("id").take(take),
                batch.column("th").take(take), pa.array(place.astype(np.int32))],
                ["key", "right", "left", "id", "th", "place"])


def _windows(batches: Iterator[pa.RecordBatch], min_words: int, span: int) -> Iterator[pa.RecordBatch]:
    """The windows of min_words words around the key of each listed suffix: (window, id, th, place), place of the first word."""
    for batch in batches:
        listed = batch.column("suffixes").to_pylist()
        for w in words(batch.column("text")):
            grams = gram_hashes(w.hashes(), min_words)
            found = [(r, x["place"]) for r in range(w.n_rows) for x in listed[w.first_row + r]]
            if not found or not len(grams):
                continue
            row, place = (np.array(x, np.int64) for x in zip(*found))
            at = (w.first[row] + place)[:, None] - np.arange(span)
            own = np.repeat(row, span)[((at >= w.first[row][:, None]) & (at + min_words <= w.first[row + 1][:, None])).ravel()]
            at = at[(at >= w.first[row][:, None]) & (at + min_words <= w.first[row + 1][:, None])]
            at, first = np.unique(at, return_index=True)  # suffixes close by share windows
            own = own[first]
            take = pa.array(w.first_row + own)
            yield pa.RecordBatch.from_arrays([
                pa.array(grams[at].view(np.int64)), batch.column("id").take(take), batch.column("th").take(take),
                pa.array((at - w.first[own]).astype(np.int32))], ["window", "id", "th", "place"])


def common_symbols(a: bytes, b: bytes) -> int:
    """Words that two runs of symbols (3 bytes each) share from their start on."""
    if a == b and SEPARATOR.to_bytes(3, "big") not in a:
        return len(a) // 3
    x, y = np.frombuffer(a, np.uint8).reshape(-1, 3), np.frombuffer(b, np.uint8).reshape(-1, 3)
    bad = np.flatnonzero((x != y).any(axis=1) | ~x.any(axis=1))
    return int(bad[0]) if len(bad) else len(x)


def _neighbours(batches: Iterator[pa.RecordBatch], key_words: int, min_words: int, neighbours: int,
                edges: bool) -> Iterator[pa.RecordBatch]:
    """Matches (role 0) of a sorted range's rows with those shortly before; edges: also the first and last rows
    (role 1 and 2) as they are. Input columns key, right, left, id, th, place
    and side (without edges, rows of one side are not compared)."""
    number = TaskContext.get().partitionId()
    names = ["role", "number", "key", "right", "left", "id", "th", "place", "to_id", "to_place", "before", "length"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(),
             pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    last: deque = deque(maxlen=neighbours)
    seen = 0

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names)

    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("key", "right", "left", "id", "th", "place", "side")]
        for x in zip(*columns):
            if last and last[-1][:6] == x[:6]:
                continue  # a repeated row of the table
            if edges and seen < neighbours:
                out.append((1, number, *x[:6], None, None, None, None))
            seen += 1
            for y in last:
                if y[0] != x[0] or y[3] == x[3] or (not edges and y[6] == x[6]):
                    continue
                before = common_symbols(x[2], y[2])
                length = before + key_words + common_symbols(x[1], y[1])
                if length >= min_words:
                    late, early = (x, y) if x[3] > y[3] else (y, x)
                    out.append((0, number, None, None, None, late[3], late[4], late[5], early[3], early[5], before, length))
            last.append(x)
        if out:
            yield table(out)
    if edges and last:
        yield table([(2, number, *y[:6], None, None, None, None) for y in last])


MATCHES = ("role int, number int, key bigint, right binary, left binary, id bigint, th bigint, place int, "
           "to_id bigint, to_place int, before int, length int")


def _merged(matches: DataFrame) -> DataFrame:
    """Matches of one pair of documents on one diagonal as maximal passages."""
    own = matches.select("id", "th", "to_id", (F.col("place") - F.col("before")).alias("start"),
                         (F.col("place") - F.col("before") + F.col("length")).alias("end"),
                         (F.col("to_place") - F.col("place")).alias("diagonal"))
    by = Window.partitionBy("id", "th", "to_id", "diagonal").orderBy("start", "end")
    so_far = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") <= F.col("so_far"), 0).otherwise(1)
    return (own.withColumn("so_far", so_far).withColumn("passage", F.sum(new).over(by))
            .groupBy("id", "th", "to_id", "diagonal", "passage").agg(F.min("start").alias("start"), F.max("end").alias("end")))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, span: int = SPAN,
                      neighbours: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, start, n_words, first_doc_id, first_start): passages of at least min_words words of a document that
    stand in a document with a smaller doc_id too; places count words (maximal runs of
    non-white-space) from 0.

    Every window of min_words words that a document with a smaller doc_id has is covered. A passage is reported against
    the first document of each window and the neighbours in the suffix order, not against all documents that have it. Null texts have no words. Rows with a null doc_id come after all others
    and are left out of the result (there is no id to report). Rows that share a doc_id are not compared with one
    another. Other columns are ignored; an empty table gives an empty one.
    """
    key_words, reach = min_words - span + 1, span - 1
    own = docs.select(*[c.alias(k) for k, c in row_key(docs).items()], "text").where(F.col("id") < LAST_ID)
    found = suffix_places(own, min_words, span)
    shared = materialize(found.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("key"),
                         "suffix_keys")
    known = materialize(found.join(shared, "key", "left_semi"), "suffix_places")
    # one suffix stands for all with the same surroundings: the first document's
    firsts = materialize(known.groupBy("content").agg(F.min(F.struct("id", "th", "place")).alias("f")), "suffix_firsts")
    settled = known.join(firsts, "content")
    alike = settled.where((F.col("id") > F.col("f.id")) & (F.col("length") >= min_words)).select(
        "id", "th", "place", F.col("f.id").alias("to_id"), F.col("f.place").alias("to_place"), "before", "length")
    lists = settled.where("id = f.id").groupBy("id", "th").agg(F.collect_set(F.struct(
        "key", "place", F.expr("th = f.th and place = f.place").alias("sorted"))).alias("suffixes"))
    order = ["key", "right", "left", "id"]
    listed = own.join(lists, ["id", "th"]).select("id", "th", "text", "suffixes")
    suffixes = listed.mapInArrow(
        lambda b: _surroundings(b, key_words, reach), "key bigint, right binary, left binary, id bigint, th bigint, place int")
    suffixes = materialize(suffixes.withColumn("side", F.lit(0)), "suffixes")
    ranges = materialize(suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        lambda b: _neighbours(b, key_words, min_words, neighbours, True), MATCHES), "suffix_matches")
    # the last rows of a range meet the first of the next that has rows
    full = sorted(r.number for r in ranges.where("role = 1").select("number").distinct().collect())
    turn = docs.sparkSession.createDataFrame(list(zip(full, full[1:])), "number int, next int")
    edge = ["key", "right", "left", "id", "th", "place"]
    tails = ranges.where("role = 2").join(F.broadcast(turn), "number").select(F.col("next").alias("at"), *edge, F.lit(0).alias("side"))
    heads = ranges.where("role = 1").select(F.col("number").alias("at"), *edge, F.lit(1).alias("side"))
    across = (tails.unionByName(heads).repartition("at").sortWithinPartitions("at", "side", *order)
              .mapInArrow(lambda b: _neighbours(b, key_words, min_words, 2 * neighbours, False), MATCHES))
    pairs = ranges.where("role = 0").unionByName(across.where("role = 0")).select(
        "id", "th", "place", "to_id", "to_place", "before", "length")
    windows = materialize(listed.mapInArrow(
        lambda b: _windows(b, min_words, span), "window bigint, id bigint, th bigint, place int"), "suffix_windows")
    earliest = materialize(windows.groupBy("window").agg(F.min(F.struct("id", "place")).alias("f"), F.max("id").alias("b"))
                           .where("f.id < b").select("window", "f"), "suffix_earliest")
    settled_windows = windows.join(earliest, "window").where(F.col("id") > F.col("f.id")).select(
        "id", "th", "place", F.col("f.id").alias("to_id"), F.col("f.place").alias("to_place"),
        F.lit(0).alias("before"), F.lit(min_words).alias("length"))
    return _merged(pairs.unionByName(alike).unionByName(settled_windows)).select(
        F.col("id").alias("doc_id"), F.col("start").cast("bigint").alias("start"),
        (F.col("end") - F.col("start")).cast("bigint").alias("n_words"), F.col("to_id").alias("first_doc_id"),
        (F.col("start") + F.col("diagonal")).cast("bigint").alias("first_start"))
