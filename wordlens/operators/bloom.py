"""Bloom filter over URLs as a table of 64-bit words, used to spare exact look-ups.

A filter is ``slices``: rows (block, bits). An item belongs to one block, and sets k of its
word's 63 low bits. Build and merge are ``bit_or`` per block, and a look-up reads
one row per item, whatever k is. Sizes follow from the expected items and the false-positive rate, for this
blocked layout (``blocked_shape``).

The filter never decides alone: what it does not contain is new; what it may contain is confirmed by
an exact anti-join. So a filter beyond its design point costs time and never a URL.
``GrowingFilter`` adds a slice of twice the capacity when the last one is full.
"""

from __future__ import annotations

import math
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlens.functions.hashing import wide_pair
from wordlens.params import BLOOM_EXPECTED_ITEMS, BLOOM_FPP

BLOOM_SEED = "bloom"
#: Usable bits of a word (the sign bit stays free).
WORD_BITS = 63


def _false_positive_rate(load: float, k: int) -> float:
    """Of a word that gets a Poisson number of items (mean ``load``), k bits each."""
    total, weight = 0.0, math.exp(-load)
    for j in range(int(load + 12 * math.sqrt(load) + 20)):
        total += weight * (1 - (1 - 1 / WORD_BITS) ** (k * j)) ** k
        weight *= load / (j + 1)
    return total


@cache
def items_per_block(fpp: float = BLOOM_FPP) -> tuple[float, int]:
    """(items that a word takes, bits per item): the fullest words that keep to the false-positive rate."""
    if not 0.0 < fpp < 1.0:
        raise ValueError("fpp must be in (0, 1)")
    loads = []
    for k in range(1, 11):
        low, high = 1e-4, 64.0
        for _ in range(50):
            middle = (low + high) / 2
            low, high = (middle, high) if _false_positive_rate(middle, k) <= fpp else (low, middle)
        loads.append((low, k))
    return max(loads)


def blocked_shape(expected_items: int = BLOOM_EXPECTED_ITEMS, fpp: float = BLOOM_FPP) -> tuple[int, int]:
    """(number of words, bits per item) of a filter for so many items."""
    if expected_items <= 0:
        raise ValueError("expected_items must be > 0")
    load, k = items_per_block(fpp)
    return max(1, math.ceil(expected_items / load)), k


def sized_for(items: DataFrame, least: int = BLOOM_EXPECTED_ITEMS) -> int:
    """Expected items of a table's filter: its rows, and the design point at least. Counts a written table's rows."""
    return max(items.count(), least)


def sql_blocks(count: str, fpp: float = BLOOM_FPP, least: int = BLOOM_EXPECTED_ITEMS) -> str:
    """The DuckDB expression of that filter's number of words, for a count of items."""
    return f"CAST(ceil(greatest({count}, {least}) / CAST({items_per_block(fpp)[0]!r} AS DOUBLE)) AS BIGINT)"


def _place(item: Column, blocks: int, k: int, seed: str) -> tuple[Column, Column]:
    """(block, mask) of an item."""
    where, which = wide_pair(item, seed)
    places = [F.pmod(F.shiftright(which, 6 * i).bitwiseAND(F.lit(63)), F.lit(WORD_BITS)).cast("int") for i in range(k)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places]
    return F.pmod(where, F.lit(blocks)), reduce(Column.bitwiseOR, bits)


def sql_place(item: str, blocks: int | str, k: int, seed: str) -> tuple[str, str]:
    """The DuckDB expressions of the same block and mask."""
    from wordlens.functions.hashing import sql_wide
    which = sql_wide(item, seed, 1)
    bits = [f"(CAST(1 AS BIGINT) << CAST((({which} >> {6 * i}) & 63) % {WORD_BITS} AS INTEGER))" for i in range(k)]
    return f"({sql_wide(item, seed, 0)} % {blocks})", "(" + " | ".join(bits) + ")"


def bloom_bits(items: DataFrame, item: str = "url", expected_items: int = BLOOM_EXPECTED_ITEMS,
               fpp: float = BLOOM_FPP, seed: str = BLOOM_SEED) -> DataFrame:
    """(block, bits): the filter of the items, aggregated partially in each map task."""
    block, mask = _place(F.col(item), *blocked_shape(expected_items, fpp), seed)
    return items.select(block.alias("block"), mask.alias("bits")).groupBy("block").agg(F.bit_or("bits").alias("bits"))


def bloom_merge(*filters: DataFrame) -> DataFrame:
    """OR of filters with the same shape and seed."""
    return reduce(DataFrame.unionByName, [f.select("block", "bits") for f in filters]).groupBy("block").agg(
        F.bit_or("bits").alias("bits"))


def might_contain(df: DataFrame, bits: DataFrame, item: str = "url", expected_items: int = BLOOM_EXPECTED_ITEMS,
                  fpp: float = BLOOM_FPP, seed: str = BLOOM_SEED, out: str = "might_contain") -> DataFrame:
    """Add boolean ``out``: all the item's bits are set. One equi-join on the block; Catalyst picks
    broadcast or shuffle by the filter's size."""
    block, mask = _place(F.col(item), *blocked_shape(expected_items, fpp), seed)
    words = bits.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    return (df.select("*", block.alias("_block"), mask.alias("_mask")).join(words, "_block", "left")
            .select(*df.columns, hit.alias(out)))


def new_urls_bloom(batch: DataFrame, bits: DataFrame, processed: DataFrame, url: str = "url",
                   expected_items: int = BLOOM_EXPECTED_ITEMS, fpp: float = BLOOM_FPP,
                   seed: str = BLOOM_SEED) -> DataFrame:
    """Distinct URLs of ``batch`` that are not in ``processed``, of which ``bits`` is the filter.

    Those that the filter lacks are new at once; only the others are joined."""
    seen = might_contain(batch.select(url).distinct(), bits, url, expected_items, fpp, seed)
    fresh = seen.where("not might_contain").select(url)
    confirmed = seen.where("might_contain").select(url).join(processed.select(url), url, "left_anti")
    return fresh.unionByName(confirmed)


def slice_capacity(number: int, expected_items: int = BLOOM_EXPECTED_ITEMS) -> int:
    """Items that slice ``number`` of a growing filter is made for."""
    return expected_items << number


def slice_for(items_before: int, expected_items: int = BLOOM_EXPECTED_ITEMS) -> int:
    """The slice that takes the next items: the first whose capacity, with all before, is not used up."""
    number, room = 0, slice_capacity(0, expected_items)
    while items_before >= room:
        number += 1
        room += slice_capacity(number, expected_items)
    return number


def in_any_slice(df: DataFrame, slices: DataFrame, numbers: range, item: str = "url",
                 expected_items: int = BLOOM_EXPECTED_ITEMS, fpp: float = BLOOM_FPP, seed: str = BLOOM_SEED,
                 out: str = "might_contain") -> DataFrame:
    """``might_contain`` over a growing filter (slice, block, bits): one look-up for each slice, whose number
    grows with the logarithm of the items."""
    found = df.withColumn(out, F.lit(False))
    for n in numbers:
        one = might_contain(found.withColumnRenamed(out, "_before"), slices.where(F.col("slice") == n), item,
                            slice_capacity(n, expected_items), fpp, f"{seed}{n}", "_now")
        found = one.select(*df.columns, (F.col("_before") | F.col("_now")).alias(out))
    return found
