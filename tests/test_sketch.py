
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from wordlens.functions.hashing import with_hash_pair
from wordlens.operators import bloom, cms, counts
from wordlens.operators.lookup import byte_size, fits_broadcast
from wordlens.params import cms_shape
from wordlens.session import materialize
from wordlens.sources import tables


def _cells_dict(df):
    return {(r.row, r.bucket): r.cnt for r in df.collect()}


def test_shapes_follow_standard_sizing():
    assert cms_shape(0.01, 1e-3) == (7, 272)
    assert cms_shape(0.0005, 1e-3) == (7, 5437)
    blocks, k = bloom.blocked_shape(1000, 0.03)
    assert 7.3 * 1000 / 63 < blocks < 2 * 7.3 * 1000 / 63 and 1 <= k <= 10


def test_sketch_never_underestimates_and_error_is_bounded(spark):
    occ = counts.word_occurrences(tables.documents(spark, SF_MID))
    wc = materialize(counts.count_words(occ))
    cells = materialize(cms.sketch_from_counts(wc))
    rows = cms.audit(wc, cells).select("err", "count").collect()
    n = sum(r["count"] for r in rows)
    assert min(r.err for r in rows) >= 0
    # error <= eps * N for all but about a delta share of the words
    over = sum(1 for r in rows if r.err > cms.DEFAULT_EPS * n)
    assert over <= max(1, math.ceil(1e-3 * len(rows)))


def test_merge_equals_sketch_of_union_and_commutes(spark):
    a = counts.word_occurrences(tables.documents(spark, SF_SMALL))
    b = counts.word_occurrences(tables.conversations(spark, SF_SMALL, ("text",)))
    sa, sb = cms.sketch_cells(a), cms.sketch_cells(b)
    union = _cells_dict(cms.sketch_cells(a.unionByName(b)))
    assert _cells_dict(cms.merge_sketches(sa, sb)) == union
    assert _cells_dict(cms.merge_sketches(sb, sa)) == union


def test_estimate_broadcast_and_shuffle_paths_agree(spark):
    occ = counts.word_occurrences(tables.documents(spark, SF_SMALL))
    wc = materialize(counts.count_words(occ))
    cells = materialize(cms.sketch_from_counts(wc))
    fast = {r.word: r.est for r in cms.estimate(wc.select("word"), cells).collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        slow_df = cms.estimate(wc.select("word"), cells)
        plan = slow_df._jdf.queryExecution().executedPlan().toString()
        slow = {r.word: r.est for r in slow_df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in plan
    assert fast == slow


def test_heavy_hitters_contain_every_true_heavy_hitter(spark):
    occ = counts.word_occurrences(tables.documents(spark, SF_MID))
    wc = materialize(counts.count_words(occ))
    cells = materialize(cms.sketch_from_counts(wc))
    hh = {r.word for r in cms.heavy_hitter_estimates(wc, cells).collect()}
    rows = wc.collect()
    n = sum(r["count"] for r in rows)
    true_hh = {r.word for r in rows if r["count"] >= 0.001 * n}
    assert true_hh <= hh
    assert len(hh) < 2 * len(true_hh) + 10


def test_heavy_hitters_by_cells_equal_those_by_estimates(spark):
    occ = counts.word_occurrences(tables.documents(spark, SF_MID))
    wc = materialize(counts.count_words(occ))
    cells = materialize(cms.sketch_from_counts(wc))
    total = sum(r["count"] for r in wc.collect())
    want = {(r.word, r.est) for r in cms.estimate(wc.select("word"), cells).collect() if r.est >= 0.001 * total}
    assert {tuple(r) for r in cms.heavy_hitter_estimates(wc, cells).collect()} == want


def test_sizes_and_thresholds(spark):
    assert [byte_size(x) for x in ("-1", "10485760", "10MB", "64k", "1g", "256b", " 2 mb ")] == [
        -1, 10485760, 10 << 20, 64 << 10, 1 << 30, 256, 2 << 20]
    with pytest.raises(ValueError):
        byte_size("much")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for value, fits in (("-1", False), ("0", False), ("10MB", True), ("1k", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
            assert fits_broadcast(spark, 1000) is fits
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        occ = counts.word_occurrences(tables.documents(spark, SF_SMALL))
        wc = materialize(counts.count_words(occ))
        cells = materialize(cms.sketch_from_counts(wc))
        for df in (cms.estimate(wc.select("word"), cells), cms.heavy_hitter_estimates(wc, cells)):
            assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_frequent_items_are_counted_exactly(spark):
    occ = counts.word_occurrences(tables.documents(spark, SF_SMALL))
    want = [tuple(r) for r in counts.top_words(counts.count_words(occ), 10).collect()]
    assert [tuple(r) for r in cms.frequent_items(occ, 10).collect()] == want


@pytest.mark.parametrize("members,fpp", [(20, 0.05), (500, 0.03), (5000, 0.01)])
def test_bloom_no_false_negatives_and_rate_near_target(spark, members, fpp):
    urls = spark.range(2 * members).selectExpr("id", "concat('http://x/', id) AS url")
    bits = materialize(bloom.bloom_bits(urls.where(f"id < {members}"), expected_items=members, fpp=fpp))
    probed = bloom.might_contain(urls, bits, expected_items=members, fpp=fpp)
    got = {r.inside: (r.yes, r.n) for r in probed.groupBy((F.col("id") < members).alias("inside")).agg(
        F.sum(F.col("might_contain").cast("int")).alias("yes"), F.count("*").alias("n")).collect()}
    assert got[True] == (members, members)
    assert got[False][0] <= 3 * fpp * members + 4


def test_bloom_merge_is_filter_of_union(spark):
    urls = tables.pages(spark, SF_SMALL, ("url",))
    a = urls.where(F.col("url").startswith("https:"))
    b = urls.where(~F.col("url").startswith("https:"))
    merged = {tuple(r) for r in bloom.bloom_merge(bloom.bloom_bits(a), bloom.bloom_bits(b)).collect()}
    assert merged == {tuple(r) for r in bloom.bloom_bits(urls).collect()}


@pytest.mark.parametrize("expected", [10, 1000])
def test_a_full_filter_hides_no_new_url(spark, expected):
    """5000 members in a filter for far fewer: almost all probes are maybe, none is lost."""
    urls = spark.range(8000).selectExpr("concat('http://x/', id) AS url", "id")
    processed = urls.where("id < 5000").select("url")
    bits = materialize(bloom.bloom_bits(processed, expected_items=expected))
    got = bloom.new_urls_bloom(urls.select("url"), bits, processed, expected_items=expected)
    assert {r.url for r in got.collect()} == {f"http://x/{i}" for i in range(5000, 8000)}


def test_slices_grow(spark):
    assert [bloom.slice_for(n, 10) for n in (0, 9, 10, 29, 30, 69, 70)] == [0, 0, 1, 1, 2, 2, 3]


def test_frequent_items_of_a_flat_vocabulary(spark):
    """Three words that stand five times among 60,000 that stand twice: the sketch alone cannot tell them."""
    rows = [(f"w{i % 60_000:05d}",) for i in range(120_000)] + [(w,) for w in ("top1", "top2", "top3") for _ in range(5)]
    rows = rows[-15:-8] + rows[:-15] + rows[-8:]
    got = [tuple(r) for r in cms.frequent_items(spark.createDataFrame(rows, "word string"), 5).collect()]
    assert got == [("top1", 5), ("top2", 5), ("top3", 5), ("w00000", 2), ("w00001", 2)]


def test_frequent_items_of_a_steep_vocabulary(spark):
    rows = [(f"w{i}",) for i in range(20) for _ in range(1000 >> min(i, 9))]
    got = [tuple(r) for r in cms.frequent_items(spark.createDataFrame(rows, "word string"), 4).collect()]
    assert got == [("w0", 1000), ("w1", 500), ("w2", 250), ("w3", 125)]


def _weighted(spark, seed, n=30_000, heavy=60):
    """Word counts with many words on either side of the heavy-hitter share."""
    import numpy as np
    rng = np.random.default_rng(seed)
    rows = [(f"w{i}", int(c)) for i, c in enumerate(rng.zipf(1.6, n).clip(max=3000))]
    total = sum(c for _, c in rows)
    rows += [(f"h{i}", int(total * rng.uniform(0.0006, 0.002))) for i in range(heavy)]
    return spark.createDataFrame(rows, "word string, n bigint").repartition(4)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hierarchy_finds_the_heavy_hitters_of_a_vocabulary(spark, seed):
    counted = _weighted(spark, seed)
    levels = materialize(cms.hierarchy_cells(counted, weight="n"))
    assert _cells_dict(cms.word_cells(levels)) == _cells_dict(cms.sketch_cells(counted, weight="n"))
    n = sum(r.cnt for r in levels.where("level = 0 and row = 0").collect())
    plain = {tuple(r) for r in cms.heavy_hitter_estimates(counted, cms.word_cells(levels)).collect()}
    got = {tuple(r) for r in cms.sketch_heavy_hitters(counted, levels).collect()}
    exact = {r.word for r in counted.where(F.col("n") >= 0.001 * n).collect()}
    assert exact <= {w for w, _ in got} and got <= plain and len(exact) > 20
    half = {r.word for r in counted.where(F.col("n") >= 0.0005 * n).collect()}
    assert {(w, e) for w, e in plain if w in half} <= got  # what it drops are light words with collisions in every row
    for level, bits in enumerate(cms.PREFIX_BITS, 1):
        found = [r.prefix for r in cms.heavy_prefixes(levels, level).collect()]
        assert len(found) == len(set(found)) <= 2 / 0.001
        true = with_hash_pair(counted, "word", 1).groupBy(cms._prefix(F.col("_h1"), bits).alias("p")).agg(F.sum("n").alias("n"))
        assert {r.p for r in true.where(F.col("n") >= 0.0005 * n).collect()} <= set(found)
    assert cms.found_words(counted, levels).count() <= 2 / 0.001  # of some 30,000: the others never meet the sketch


def test_hierarchies_of_parts_merge(spark):
    a, b = _weighted(spark, 4, 500), _weighted(spark, 5, 500)
    parts = cms.hierarchy_cells(a, weight="n").unionByName(cms.hierarchy_cells(b, weight="n"))
    merged = parts.groupBy("level", "row", "bucket").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    whole = cms.hierarchy_cells(a.unionByName(b), weight="n")
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_empty_hierarchy(spark):
    levels = cms.hierarchy_cells(spark.createDataFrame([], "word string"))
    assert cms.sketch_heavy_hitters(spark.createDataFrame([], "word string"), levels).count() == 0


@pytest.mark.parametrize("words", [["a"] * 50 + ["b"] * 40 + ["c"] * 3, [f"w{i}" for i in range(60_000)] + ["top"] * 9])
def test_merged_frequent_items(spark, words):
    """A skewed and a flat vocabulary; the second is beyond what the sketch can tell, so all words are counted."""
    parts = [spark.createDataFrame([(w,) for w in words[i::2]], "word string") for i in range(2)]
    sketch = cms.merge_frequent(*[materialize(cms.frequent_sketch(p)) for p in parts])
    assert sketch.first().n == len(words)
    from collections import Counter
    want = sorted(Counter(words).items(), key=lambda t: (-t[1], t[0]))[:3]
    assert [tuple(r) for r in cms.top_of_sketch(sketch, parts[0].unionByName(parts[1]), 3).collect()] == want


def test_filter_shape_follows_the_items(spark):
    """20,000 items in a filter sized for them keep to the false-positive rate; the fixed shape would be full."""
    items = spark.range(20_000).select(F.concat(F.lit("http://x/"), "id").alias("url"))
    n = bloom.sized_for(items)
    bits = materialize(bloom.bloom_bits(items, expected_items=n))
    other = spark.range(20_000).select(F.concat(F.lit("http://y/"), "id").alias("url"))
    assert n == 20_000 and bloom.might_contain(items, bits, expected_items=n).where("not might_contain").isEmpty()
    assert bloom.might_contain(other, bits, expected_items=n).where("might_contain").count() < 0.04 * 20_000


@pytest.mark.parametrize("seed", [1, 2])
def test_names_of_cells_give_the_top_words(spark, seed):
    counted = _weighted(spark, seed, 5000)
    cells = materialize(cms.named_cells(counted, weight="n"))
    plain = cells.select("row", "bucket", "cnt")
    assert _cells_dict(plain) == _cells_dict(cms.sketch_cells(counted, weight="n"))
    assert [tuple(r) for r in cms.named_topk(cells, 10).collect()] == [tuple(r) for r in cms.sketch_topk(counted, 10, plain).collect()]
