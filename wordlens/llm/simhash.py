"""SimHash near-duplicates: fingerprints of word shingles, linked by a pigeonring filter.

A 64-bit fingerprint is cut into ``max_bits + 1`` segments on a ring. If two
fingerprints differ in at most ``max_bits`` bits, some start on the ring has the property that
each chain of l consecutive segments from it differs in at most
``l * max_bits / segments`` bits (the strong pigeonring principle). So, from that start,
the first segment is equal and the second differs in one bit at most. These two segments are
the join key: one side emits its key as it is, the other with each 0 bit of the second
segment set in turn. Candidates must pass all chains of that start, the last of
which is the full Hamming check; a pair counts at its first such start only, so that it
appears once and needs no distinct.

Exact copies share a fingerprint and are joined as one; a group of any size costs one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlens.llm.arrays import texts
from wordlens.llm.components import components
from wordlens.llm.names import free
from wordlens.session import materialize

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
#: Shingles whose bits are counted at once (64 bytes each).
BLOCK = 1 << 14


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text; 0 if it has no word.

    A bit is set if it is set in over half the shingles' hashes, repeats included.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = max(len(parts) - shingle + 1, 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = ends - np.fromiter(map(len, parts), np.int64, len(parts)) - 1
    last = ends[min(shingle, len(parts)) - 1:] - 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        spans = zip(starts[at:min(at + BLOCK, n)].tolist(), last[at:at + BLOCK].tolist())
        h = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp) per row of docs(doc_id, text), in one scan without shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle, seed) for t in texts(batch.column("text"))],
                             np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))],
                ["doc_id", "text_hash", "fp"])

    own = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("text_hash"))
    return own.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    m = max_bits + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs (a, b) of different values of column fp (distinct) that differ in at
    most ``max_bits`` bits, each once.

    Neither side is broadcast, however small: Spark takes each to be as large as fps, but it has
    5 and about 37 rows for each of its values (at the default number of bits).
    """
    if max_bits < 1:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    segs = _segments(max_bits)
    m = len(segs)

    def part(i: int) -> Column:
        low, width = segs[i % m]
        return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))

    def key(i: int) -> Column:
        return F.shiftleft(part(i), segs[(i + 1) % m][1]).bitwiseOR(part(i + 1))

    def row(i: int, value: Column, when: Column | None = None) -> Column:
        out = F.struct(F.lit(i).alias("start"), value.alias("key"))
        return out if when is None else F.when(when, out)

    index = fps.select(F.col("fp").alias("a"), F.inline(F.array(*[row(i, key(i)) for i in range(m)])))
    flips = []
    for i in range(m):
        flips.append(row(i, key(i)))
        for bit in range(segs[(i + 1) % m][1]):
            one = F.lit(1 << bit)
            flips.append(row(i, key(i).bitwiseOR(one), part(i + 1).bitwiseAND(one) == 0))
    probe = fps.select(F.col("fp").alias("b"), F.inline(F.filter(F.array(*flips), lambda x: x.isNotNull())))

    differ = [F.bit_count(F.col("a").bitwiseXOR(F.col("b")).bitwiseAND(
        F.lit(_signed(((1 << w) - 1) << low)))).alias(f"c{i}") for i, (low, w) in enumerate(segs)]

    def chain(i: int) -> Column:
        sums = [reduce(Column.__add__, [F.col(f"c{(i + j) % m}") for j in range(n)]) <= n * max_bits // m
                for n in range(1, m + 1)]
        return reduce(Column.__and__, sums)

    first = F.coalesce(*[F.when(chain(i), F.lit(i)) for i in range(m)])
    second = F.element_at(F.array(*[F.col(f"c{(i + 1) % m}") for i in range(m)]), F.col("start") + 1)
    return (index.join(probe.hint("merge"), ["start", "key"]).where("a <> b")
            .select("a", "b", "start", *differ)
            .where((first == F.col("start")) & ((second > 0) | (F.col("a") < F.col("b"))))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) per row of docs(doc_id, text).

    root is the component's smallest fingerprint (signed); component_id is the smallest doc_id that is reachable over links of fingerprints with at
    most max_bits differing bits, the row's own included.

    Null texts and texts without a word have fingerprint 0 and link like any other. A
    null doc_id counts for no minimum (a component of such rows alone has a null id).
    Repeated rows give repeated rows. Other columns of docs are ignored. An empty table
    gives an empty one. For a table of very many rows of one text, only its one
    fingerprint takes part in the search.
    """
    own = materialize(fingerprints(docs, shingle, seed), "simhash")
    distinct = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_distinct")
    parts = components(near_pairs(distinct.select("fp"), max_bits))
    rooted = (distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    # a table of its own: a join right above an aggregation can't split a large component's rows
    ids = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash_components")
    return own.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp")


def keep_one_per_group(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs with one row of each component: that with the smallest doc_id
    (a null id is the largest; then the smallest text hash; one of equal rows)."""
    last = F.lit((1 << 63) - 1)
    groups = near_duplicates(docs, **how)
    chosen = groups.groupBy("root").agg(
        F.min(F.struct(F.coalesce("doc_id", last).alias("id"), F.col("text_hash").alias("hash"))).alias("k"))
    key = free(docs.columns, "id", "hash")
    keyed = docs.withColumns({key[0]: F.coalesce(F.col("doc_id").cast("bigint"), last), key[1]: F.xxhash64("text")})
    kept = keyed.join(chosen.select(F.col("k.id").alias(key[0]), F.col("k.hash").alias(key[1])), key, "left_semi")
    return kept.dropDuplicates(key).select(*[F.col(f"`{c}`") for c in docs.columns])
