"""Benchmark decontamination by greedy string tiling.

1. Seeds: hashes of ``MIN_TILE`` consecutive words (lower-cased, ASCII punctuation dropped) of the
   test items. One scan joins every document's rolling hashes to them and lists, for each
   document, the items that share a seed. The items' seeds go along in blocks of bounded size
   (``BLOCK_SEEDS`` hashes), a scan for each block, so nothing unbounded is broadcast.
2. Greedy string tiling of each such pair: the longest common run of unmarked words is marked
   again and again, down to MIN_TILE words. Matches are found by running Karp-Rabin:
   hashes of all unmarked runs of the length looked for, which is halved when no more matches
   turn up; each candidate is checked word by word and extended.
3. A document is contaminated by an item if its tiles cover at least ``COVERAGE`` of the item's words,
   in whatever order the passages stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.arrays import gram_hashes, words
from wordlens.llm.names import free

MIN_TILE, COVERAGE = 5, 0.5
BLOCK_SEEDS = 1_000_000
#: Length that running Karp-Rabin looks for first.
SEARCH_LENGTH = 20


def _separators() -> np.ndarray:
    """ASCII bytes that are no letter or digit."""
    out = np.zeros(256, bool)
    out[:128] = True
    for a, b in ((48, 58), (65, 91), (97, 123)):
        out[a:b] = False
    return out


SEPARATORS = _separators()


def _scan(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray,
          s: int) -> list[tuple[int, int, int]]:
    """The longest common runs (length, place in a, place in b) of unmarked words that have at
    least s of them; [] if there are none. Candidates come from rolling hashes."""
    if min(len(a), len(b)) < s:
        return []
    ones = np.ones(s, np.int64)
    ok_a = np.flatnonzero(np.convolve(free_a, ones, "valid") == s)
    ok_b = np.flatnonzero(np.convolve(free_b, ones, "valid") == s)
    ha, hb = gram_hashes(a, s), gram_hashes(b, s)
    ok_a = ok_a[np.isin(ha[ok_a], hb[ok_b])]
    where: dict[int, list[int]] = {}
    for y in ok_b[np.isin(hb[ok_b], ha[ok_a])].tolist():
        where.setdefault(int(hb[y]), []).append(y)
    longest, found = s, []
    for x in ok_a.tolist():
        for y in where.get(int(ha[x]), ()):
            if x and y and free_a[x - 1] and free_b[y - 1] and a[x - 1] == b[y - 1]:
                continue  # not the start of its run
            n = 0
            while x + n < len(a) and y + n < len(b) and free_a[x + n] and free_b[y + n] and a[x + n] == b[y + n]:
                n += 1
            if n > longest:
                longest, found = n, []
            if n == longest:
                found.append((n, x, y))
    return found


def tiles(a: np.ndarray, b: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (length, place in a, place in b),
    not overlapping in either, longest first (ties: smallest places)."""
    free_a, free_b = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
    out: list[tuple[int, int, int]] = []
    s = max(SEARCH_LENGTH, least)
    while True:
        found = _scan(a, b, free_a, free_b, s)
        for n, x, y in sorted(found, key=lambda t: t[1:]):
            if free_a[x:x + n].all() and free_b[y:y + n].all():
                free_a[x:x + n] = free_b[y:y + n] = 0
                out.append((n, x, y))
        if not found:
            if s == least:
                return out
            s = max(s // 2, least)


def _items(benchmark: DataFrame, block_seeds: int) -> Iterator[dict]:
    """Blocks of test items (ids and word hashes). Items arrive one at a time: a stated query set,
    read in blocks."""
    block: dict = {"ids": [], "words": [], "seeds": 0}
    rows = benchmark.select(F.col("item_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    for item in rows.orderBy("item_id", "text").toLocalIterator():
        for w in words(pa.array([item.text], pa.string()), SEPARATORS, lower=True):
            h = w.hashes()
            if not len(h):
                continue
            block["ids"].append(item.item_id)
            block["words"].append(h)
            block["seeds"] += len(h)
        if block["seeds"] >= block_seeds:
            yield block
            block = {"ids": [], "words": [], "seeds": 0}
    if block["ids"]:
        yield block


def _seeds(block: dict, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted seed hashes and the item (its place in the block) of each. An item of fewer than
    ``least`` words is one seed of all its words."""
    grams = [gram_hashes(h, min(least, len(h))) for h in block["words"]]
    item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    flat = np.concatenate(grams)
    order = np.argsort(flat, kind="stable")
    return flat[order], item[order]


def _tile_block(docs: DataFrame, block: dict, least: int, coverage: float) -> DataFrame:
    seeds, owner = _seeds(block, least)
    shared = docs.sparkSession.sparkContext.broadcast((seeds, owner, block["words"], block["ids"]))
    short = sorted({len(h) for h in block["words"] if len(h) < least})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, owner, items, ids = shared.value
        for batch in batches:
            found: list[tuple] = []
            for w in words(batch.column("text"), SEPARATORS, lower=True):
                h = w.hashes()
                row = w.row()
                pairs = [np.empty(0, np.int64)]
                for k in [*short, least]:
                    grams = gram_hashes(h, k)
                    whole = row[:len(grams)] == row[k - 1:k - 1 + len(grams)]
                    at = np.searchsorted(seeds, grams)
                    hit = np.flatnonzero(whole & (seeds[np.minimum(at, len(seeds) - 1)] == grams))
                    if not len(hit):
                        continue
                    to = np.searchsorted(seeds, grams[hit], side="right")
                    many = to - at[hit]
                    which = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(at[hit], many)
                    pairs.append(np.unique(np.repeat(row[hit], many) * len(items) + owner[which]))
                for pair in np.unique(np.concatenate(pairs)).tolist():
                    r, i = divmod(pair, len(items))
                    own = h[w.first[r]:w.first[r + 1]]
                    item = items[i]
                    found_tiles = tiles(own, item, min(least, len(item)))
                    covered = sum(t[0] for t in found_tiles)
                    if covered >= coverage * len(item):
                        found.append((w.first_row + r, ids[i], covered / len(item), len(found_tiles),
                                      max(t[0] for t in found_tiles)))
            if found:
                row, item, share, n, longest = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())),
                     batch.column("th").take(pa.array(row, pa.int64())), pa.array(item, pa.int64()),
                     pa.array(share, pa.float64()), pa.array(n, pa.int32()), pa.array(longest, pa.int32())],
                    ["doc_id", "th", "item_id", "coverage", "n_tiles", "longest_tile"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, th bigint, item_id bigint, "
                                "coverage double, n_tiles int, longest_tile int")


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: float = COVERAGE,
                       block_seeds: int = BLOCK_SEEDS, with_hash: bool = False) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest_tile) for each row of docs(doc_id, text) and
    item of benchmark(item_id, text) whose tiles cover at least ``coverage`` of the item's words.

    Null and empty texts have no words and match nothing. Repeated rows and items give repeated
    pairs. Null ids are carried as they are. Other columns are ignored. An empty docs or
    benchmark table gives an empty table.
    """
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    blocks = [_tile_block(own, b, least, coverage) for b in _items(benchmark, block_seeds)]
    if not blocks:
        none = own.limit(0).selectExpr("doc_id", "th", "0L as item_id", "0D as coverage", "0 as n_tiles", "0 as longest_tile")
        return none if with_hash else none.drop("th")
    pairs = reduce(DataFrame.unionByName, blocks)
    return pairs if with_hash else pairs.drop("th")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of docs that no test item contaminates, with docs' columns."""
    own_id, own_hash, own_key = free(docs.columns, "id", "hash", "key")
    bad = contaminated_pairs(docs, benchmark, with_hash=True, **how).select(
        F.col("doc_id").alias(own_id), F.col("th").alias(own_hash)).distinct()
    keyed = docs.withColumn(own_key, F.xxhash64("text"))
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(bad[own_id]) & (keyed[own_key] == bad[own_hash]),
                      "left_anti").drop(own_key)
