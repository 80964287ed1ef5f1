"""Count-min sketch over words, stored as a table of cells, with heavy hitters.

A sketch of depth d and width w is ``cells(row int, bucket bigint, cnt bigint)``, at
most d*w rows. Building it is a hash aggregate keyed by the cell, so every map task
combines its tokens into at most d*w partial rows before the shuffle: no single key,
no skew, whatever the word distribution. Merging sketches is union + sum, and a point
estimate is the minimum over the d cells of the word (d lookups into a broadcast
table whose size is fixed by (eps, delta)).

The estimate never undercounts; it overcounts by at most eps * N with probability
at least 1 - delta (Cormode and Muthukrishnan, 2005).

Heavy hitters come from the sketch alone (``hierarchy_cells``): beside the words' own cells it has one small sketch for each
prefix length of the words' hashes. From the shortest prefixes on, only those that are heavy are extended, so a level
never has more candidates than heavy prefixes times the fan-out, and only words whose hash was found are looked up.
"""

from __future__ import annotations

import math
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordlens.functions.hashing import position, with_hash_pair
from wordlens.operators.lookup import fits_broadcast, probe_positions
from wordlens.params import CMS_DELTA, CMS_HEAVY_HITTER_PCT, CMS_SEED, cms_shape

DEFAULT_EPS = CMS_HEAVY_HITTER_PCT / 2
#: Bits of the hash prefixes of the levels (the first level counts its prefixes exactly) and rows of a later level's sketch. An
#: inner level only has to keep light prefixes few, so it needs fewer rows than the words' own sketch.
PREFIX_BITS, PREFIX_ROWS = (10, 21, 32), 4
PRIME = 2 ** 31 - 1


def sketch_cells(words: DataFrame, word: str = "word", weight: str | None = None,
                 eps: float = DEFAULT_EPS, delta: float = CMS_DELTA,
                 seed: int = CMS_SEED) -> DataFrame:
    """(row, bucket, cnt) of all word occurrences (or of ``weight`` per row).

    Occurrences are first summed per word, so the digest and the d-fold explode run once per
    distinct word instead of once per token; the word aggregate is partial in every map task.
    """
    amount = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    weighted = words.groupBy(F.col(word).alias("word")).agg(F.sum(amount).alias("count"))
    return sketch_from_counts(weighted, eps=eps, delta=delta, seed=seed)


def sketch_from_counts(counts: DataFrame, word: str = "word", count: str = "count",
                       eps: float = DEFAULT_EPS, delta: float = CMS_DELTA,
                       seed: int = CMS_SEED) -> DataFrame:
    """Sketch cells from an exact (word, count) aggregate (e.g. a batch's counts)."""
    return _cells(counts.select(F.col(word).alias("_w"), F.col(count).cast("bigint").alias("_n")),
                  eps, delta, seed)


def _cells(weighted: DataFrame, eps: float, delta: float, seed: int) -> DataFrame:
    depth, width = cms_shape(eps, delta)
    hashed = with_hash_pair(weighted, "_w", seed)
    exploded = hashed.select(F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("row"),
                             "_h1", "_h2", "_n")
    return (exploded.groupBy(F.col("row").cast("int").alias("row"),
                             position(F.col("_h1"), F.col("_h2"), F.col("row"), width)
                             .alias("bucket"))
            .agg(F.sum("_n").cast("bigint").alias("cnt")))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """Cell-wise sum of sketches with the same shape and seed."""
    merged = sketches[0].select("row", "bucket", "cnt")
    for other in sketches[1:]:
        merged = merged.unionByName(other.select("row", "bucket", "cnt"))
    return merged.groupBy("row", "bucket").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def sketch_total(cells: DataFrame) -> DataFrame:
    """One row: N, the number of counted items (the sum of any one sketch row)."""
    return cells.where(F.col("row") == 0).agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("total"))


def estimate(words: DataFrame, cells: DataFrame, word: str = "word",
             eps: float = DEFAULT_EPS, delta: float = CMS_DELTA, seed: int = CMS_SEED,
             out: str = "est") -> DataFrame:
    """Add ``out``: the sketch's count estimate of each row's word.

    Cells are keyed ``row * width + bucket``, so one (broadcast) table answers all d
    probes; a missing cell counts 0.
    """
    depth, width = cms_shape(eps, delta)
    keyed = cells.select((F.col("row").cast("bigint") * width + F.col("bucket")).alias("cell"),
                         "cnt")
    hashed = with_hash_pair(words, word, seed)
    cell_keys = [F.lit(i * width).cast("bigint") + position(F.col("_h1"), F.col("_h2"), i, width)
                 for i in range(depth)]
    probed = probe_positions(hashed, cell_keys, keyed, key="cell", value="cnt",
                             max_rows=depth * width, prefix="_c", row_id=word).drop("_h1", "_h2")
    est = F.least(*[F.coalesce(F.col(f"_c{i}"), F.lit(0)) for i in range(depth)]) \
        if depth > 1 else F.coalesce(F.col("_c0"), F.lit(0))
    return probed.withColumn(out, est.cast("bigint")).drop(*[f"_c{i}" for i in range(depth)])


def heavy_cells(cells: DataFrame, pct: float = CMS_HEAVY_HITTER_PCT) -> DataFrame:
    """Cells that hold at least ``pct`` of all counted items: at most 1 / pct in each row of the sketch.

    N is a scalar subquery over the sketch, evaluated once. The share is a decimal literal,
    so ``pct * N`` is exact at the threshold.
    """
    total = sketch_total(cells).scalar()
    return cells.where(F.col("cnt") >= F.lit(Decimal(repr(pct))) * total)


def heavy_hitter_estimates(vocab: DataFrame, cells: DataFrame, eps: float = DEFAULT_EPS,
                           delta: float = CMS_DELTA, seed: int = CMS_SEED,
                           pct: float = CMS_HEAVY_HITTER_PCT,
                           word: str = "word") -> DataFrame:
    """(word, est) for every candidate whose estimate is at least ``pct`` of all counted items.

    A word passes only if all its cells are heavy, and a sketch row has at most 1 / pct heavy
    cells. So the candidates are inner-joined with the heavy cells row by row: the first join
    drops almost all of them. ``vocab`` holds distinct words (e.g. the keys of a word aggregate).
    """
    depth, width = cms_shape(eps, delta)
    spark = vocab.sparkSession
    heavy = heavy_cells(cells, pct)
    if fits_broadcast(spark, depth * math.ceil(1 / pct)):
        heavy = F.broadcast(heavy)
    found = with_hash_pair(vocab.select(word), word, seed)
    for i in range(depth):
        own = heavy.select(F.col("row").alias("_row"), F.col("bucket").alias("_bucket"), F.col("cnt").alias(f"_c{i}"))
        place = position(F.col("_h1"), F.col("_h2"), i, width)
        found = found.join(own, (F.col("_bucket") == place) & (F.col("_row") == i)).drop("_row", "_bucket")
    cnts = [F.col(f"_c{i}") for i in range(depth)]
    return found.select(word, (F.least(*cnts) if depth > 1 else cnts[0]).cast("bigint").alias("est"))


def _prefix(h1: Column, bits: int) -> Column:
    return F.shiftright(h1, 32 - bits)


def _multipliers(row: int) -> tuple[int, int]:
    """Of the row's hash (a * prefix + b) mod (2**31 - 1) of prefixes: powers of the primitive roots 48271 and 16807."""
    return pow(48271, row + 1, PRIME), pow(16807, row + 1, PRIME)


def _prefix_place(prefix: Column, row: int, width: int) -> Column:
    a, b = _multipliers(row)
    return (prefix * F.lit(a) + F.lit(b)) % F.lit(PRIME) % F.lit(width)


def sql_prefix_place(prefix: str, row: int, width: int) -> str:
    """The DuckDB expression of the same bucket."""
    a, b = _multipliers(row)
    return f"(({prefix} * {a} + {b}) % {PRIME} % {width})"


def hierarchy_cells(words: DataFrame, word: str = "word", weight: str | None = None, eps: float = DEFAULT_EPS,
                    delta: float = CMS_DELTA, seed: int = CMS_SEED) -> DataFrame:
    """(level, row, bucket, cnt): the words' sketch (level 0, as ``sketch_cells``) and those of their hashes' prefixes.

    Occurrences are summed per word first (partially in every map task). Sketches of the same shape are merged by cell.
    """
    depth, width = cms_shape(eps, delta)
    amount = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    weighted = words.groupBy(F.col(word).alias("_w")).agg(F.sum(amount).alias("_n"))
    cell = lambda level, row, bucket: F.struct(
        F.lit(level).alias("level"), F.lit(row).alias("row"), bucket.cast("bigint").alias("bucket"))
    cells = [cell(0, i, position(F.col("_h1"), F.col("_h2"), i, width)) for i in range(depth)]
    cells.append(cell(1, 0, _prefix(F.col("_h1"), PREFIX_BITS[0])))
    for level, bits in enumerate(PREFIX_BITS[1:], 2):
        cells += [cell(level, r, _prefix_place(_prefix(F.col("_h1"), bits), r, width)) for r in range(PREFIX_ROWS)]
    exploded = with_hash_pair(weighted, "_w", seed).select(F.inline(F.array(*cells)), "_n")
    return exploded.groupBy("level", "row", "bucket").agg(F.sum("_n").cast("bigint").alias("cnt"))


def word_cells(hierarchy: DataFrame) -> DataFrame:
    """The words' own sketch (row, bucket, cnt) within a hierarchy."""
    return hierarchy.where("level = 0").select("row", "bucket", "cnt")


def heavy_prefixes(hierarchy: DataFrame, level: int, eps: float = DEFAULT_EPS, delta: float = CMS_DELTA,
                   pct: float = CMS_HEAVY_HITTER_PCT) -> DataFrame:
    """(prefix): hash prefixes of a level (from 1) that may hold a word whose estimate is at least ``pct`` of all items, found
    from the first level down.

    An estimate may be eps of all items above the count, so prefixes are kept from ``pct`` - eps on (half of pct at
    least). Every cell of such a prefix is that heavy, and a row has at most 2 / pct such cells.
    """
    width = cms_shape(eps, delta)[1]
    spark = hierarchy.sparkSession
    total = sketch_total(word_cells(hierarchy)).scalar()
    share = max(Decimal(repr(pct)) - Decimal(repr(eps)), Decimal(repr(pct)) / 2)
    heavy = hierarchy.where((F.col("level") > 0) & (F.col("cnt") >= F.lit(share) * total))
    if fits_broadcast(spark, len(PREFIX_BITS) * PREFIX_ROWS * math.ceil(2 / pct)):
        heavy = F.broadcast(heavy)
    found = heavy.where("level = 1").select(F.col("bucket").alias("prefix"))
    for at in range(2, level + 1):
        step = PREFIX_BITS[at - 1] - PREFIX_BITS[at - 2]
        first = F.shiftleft("prefix", step)
        found = found.select(F.explode(F.sequence(first, first + (1 << step) - 1)).alias("prefix"))
        for r in range(PREFIX_ROWS):
            own = heavy.where((F.col("level") == at) & (F.col("row") == r)).select(F.col("bucket").alias(f"_b{r}"))
            found = found.join(own, _prefix_place(F.col("prefix"), r, width) == F.col(f"_b{r}"), "left_semi")
    return found


def found_words(words: DataFrame, hierarchy: DataFrame, word: str = "word", eps: float = DEFAULT_EPS, delta: float = CMS_DELTA,
                seed: int = CMS_SEED, pct: float = CMS_HEAVY_HITTER_PCT) -> DataFrame:
    """(word): distinct words of ``words`` whose hash the hierarchy finds heavy. All others are dropped where they are read."""
    found = heavy_prefixes(hierarchy, len(PREFIX_BITS), eps, delta, pct)
    hashed = with_hash_pair(words.select(word), word, seed)
    return hashed.join(found, _prefix(F.col("_h1"), PREFIX_BITS[-1]) == F.col("prefix"), "left_semi").select(word).distinct()


def sketch_heavy_hitters(words: DataFrame, hierarchy: DataFrame, eps: float = DEFAULT_EPS, delta: float = CMS_DELTA,
                         seed: int = CMS_SEED, pct: float = CMS_HEAVY_HITTER_PCT, word: str = "word") -> DataFrame:
    """(word, est): words whose estimate is at least ``pct`` of all counted items, found in the hierarchy; ``words`` only
    gives names to found hashes (occurrences, or any table that has the heavy words).

    No word with ``pct`` of all items is missed. Of words whose estimate alone is that high, by collisions in every row, the levels
    drop those whose prefixes are too light; a plain sketch (``heavy_hitter_estimates``) can't tell them.
    """
    named = found_words(words, hierarchy, word, eps, delta, seed, pct)
    return heavy_hitter_estimates(named, word_cells(hierarchy), eps, delta, seed, pct, word)


def named_cells(words: DataFrame, word: str = "word", weight: str | None = None, eps: float = DEFAULT_EPS,
                delta: float = CMS_DELTA, seed: int = CMS_SEED) -> DataFrame:
    """(row, bucket, cnt, name): the words' sketch, each cell with its most frequent word (of equals, the last)."""
    depth, width = cms_shape(eps, delta)
    amount = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    weighted = words.groupBy(F.col(word).alias("_w")).agg(F.sum(amount).alias("_n"))
    places = F.array(*[position(F.col("_h1"), F.col("_h2"), i, width) for i in range(depth)])
    cells = with_hash_pair(weighted, "_w", seed).select(F.posexplode(places).alias("row", "bucket"), "_n", "_w")
    return cells.groupBy("row", "bucket").agg(F.sum("_n").cast("bigint").alias("cnt"), F.max(F.struct("_n", "_w")).alias("best")).select(
        "row", "bucket", "cnt", F.col("best._w").alias("name"))


def named_topk(cells: DataFrame, k: int, eps: float = DEFAULT_EPS, delta: float = CMS_DELTA, seed: int = CMS_SEED,
               pct: float = CMS_HEAVY_HITTER_PCT) -> DataFrame:
    """(word, est): the top k heavy hitters by estimate (ties by word) among the names of heavy cells, at most 1 / pct a row. A
    word is not named only if a more frequent one shares its cell in every row; of the top words, practically none."""
    depth, width = cms_shape(eps, delta)
    heavy = heavy_cells(cells, pct)
    named = with_hash_pair(heavy.select(F.col("name").alias("word")).distinct(), "word", seed)
    places = F.array(*[position(F.col("_h1"), F.col("_h2"), i, width) for i in range(depth)])
    found = named.select("word", F.posexplode(places).alias("row", "bucket")).join(
        heavy.select("row", "bucket", "cnt"), ["row", "bucket"])
    hitters = found.groupBy("word").agg(F.min("cnt").alias("est"), F.count(F.lit(1)).alias("n")).where(F.col("n") == depth)
    return best_estimates(hitters.select("word", "est"), k)


def sketch_topk(vocab: DataFrame, k: int, cells: DataFrame, eps: float = DEFAULT_EPS,
                delta: float = CMS_DELTA, seed: int = CMS_SEED,
                pct: float = CMS_HEAVY_HITTER_PCT, word: str = "word") -> DataFrame:
    """Top k heavy hitters by estimate (ties by word), of a vocabulary and a plain sketch."""
    return best_estimates(heavy_hitter_estimates(vocab, cells, eps, delta, seed, pct, word), k, word)


def best_estimates(hitters: DataFrame, k: int, word: str = "word") -> DataFrame:
    """The k rows of (word, est) with the highest estimates, ties by word."""
    return hitters.orderBy(F.desc("est"), F.asc(word)).limit(k)


#: Items that a frequent-items sketch tracks (it proposes a tenth of them).
TRACKED = 10_000


def frequent_sketch(words: DataFrame, tracked: int = TRACKED, word: str = "word") -> DataFrame:
    """(sketch, n): Spark's frequent-items sketch of a table's words, in one scan, and how many there are."""
    return words.agg(F.expr(f"approx_top_k_accumulate({word}, {tracked})").alias("sketch"), F.count(word).alias("n"))


def merge_frequent(*sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One (sketch, n) of tables' sketches."""
    every = reduce(DataFrame.unionByName, sketches)
    return every.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))


def top_of_sketch(sketch: DataFrame, words: DataFrame, k: int, tracked: int = TRACKED, word: str = "word") -> DataFrame:
    """(word, count): the k most frequent of ``words``, exactly, found by their sketch (one of them all, or merged) if it can tell them.

    The sketch proposes up to ``tracked`` / 10 words (at least k); their counts are then exact, from a semi-join of the
    occurrences. A word that is not proposed occurs at most twice the sketch's error (3.5 / its map's size of all
    occurrences), or at most as often as the last proposal's estimate where there were more. If the k-th count is not above
    that (a flat or very large vocabulary), or fewer than k were proposed, all words are counted.
    """
    proposals, tracked = max(k, tracked // 10), max(k, tracked)
    top, n = sketch.select(F.expr(f"approx_top_k_estimate(sketch, {proposals})"), "n").first()
    unseen = 2 * 3.5 * (n or 0) / (1 << math.ceil(math.log2(tracked / 0.75)))
    if top and len(top) >= proposals:
        unseen = max(unseen, min(x["count"] for x in top))
    spark = words.sparkSession
    if top and len(top) >= k:
        proposed = spark.createDataFrame([(x["item"],) for x in top], words.select(word).schema)
        counted = words.join(F.broadcast(proposed), word, "left_semi").groupBy(word).agg(F.count(F.lit(1)).alias("count"))
        best = counted.orderBy(F.desc("count"), F.asc(word)).limit(k)
        found = best.collect()
        if len(found) == k and found[-1]["count"] > unseen:
            return spark.createDataFrame(found, best.schema).orderBy(F.desc("count"), F.asc(word))
    exact = words.where(F.col(word).isNotNull()).groupBy(word).agg(F.count(F.lit(1)).alias("count"))
    return exact.orderBy(F.desc("count"), F.asc(word)).limit(k)


def frequent_items(words: DataFrame, k: int, tracked: int = TRACKED, word: str = "word") -> DataFrame:
    """Exact counts of the k most frequent words, found by a frequent-items sketch (see ``top_of_sketch``)."""
    tracked = max(k, tracked)
    return top_of_sketch(frequent_sketch(words, tracked, word), words, k, tracked, word)


def audit(counts: DataFrame, cells: DataFrame, eps: float = DEFAULT_EPS,
          delta: float = CMS_DELTA, seed: int = CMS_SEED) -> DataFrame:
    """(word, count, est, err) for every word of an exact count; err = est - count.

    The estimates are added to the exact aggregate's output directly (broadcast
    probes), so the audit costs the exact count plus no further shuffle.
    """
    est = estimate(counts.select("word", "count"), cells, "word", eps, delta, seed)
    return est.withColumn("err", (F.col("est") - F.col("count")).cast("bigint"))
