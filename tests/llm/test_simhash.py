"""SimHash near-dedup against brute force over all pairs."""

import random
import re

import __spark_entry__ as entry
import pytest
import xxhash
from pyspark.sql import functions as F

from wordlens.llm import simhash
from wordlens.session import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "extra string, doc_id bigint, text string, fp string"


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = WORD.findall(lowered)
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, most=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= most:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["É", "Straße", "x y"]
    rows = []
    for i in range(120):
        base = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 4, 60, 300, 900]))]
        rows.append(base)
        for _ in range(rng.choice([0, 0, 1, 4])):
            near = list(base)
            for _ in range(rng.randrange(3)):
                if near:
                    near[rng.randrange(len(near))] = rng.choice(vocab)
            rows.append(near)
    out = [("e", i * 3 % 1009, rng.choice([" ", "\n", " \t"]).join(r), "clash") for i, r in enumerate(rows)]
    out += [(None, None, None, None), (None, 5000, None, "z"), ("", 5001, "", None), ("", 5002, " \n\t ", None),
            (None, None, "alone " * 40, None), out[3], out[3], ("", 7, "A B C", None), ("", 6, "a b c", None)]
    return out


@pytest.mark.parametrize("text", ["", "one", "A b C d", "x " * 5000, "É é\x0b\x0cq\x1cz", "a　b c d e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_components(spark):
    rows = corpus()
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [brute_fingerprint(r[2]) for r in rows]
    want = brute_components([r[1] for r in rows], fps)
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=key) == sorted(
        zip([r[1] for r in rows], fps, want), key=key)


@pytest.mark.parametrize("most", [1, 3, 4, 7])
def test_pairs_are_exact_and_single(spark, most):
    rng = random.Random(most)
    fps = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(8):
            fps.add(x - (1 << 64) if x >> 63 else x)
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    want = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) % (1 << 64)).count("1") <= most}
    got = [(min(r.a, r.b), max(r.a, r.b)) for r in
           simhash.near_pairs(spark.createDataFrame([(x,) for x in fps], "fp bigint"), most).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_small_table_of_fingerprints_is_not_broadcast_with_all_its_keys(spark):
    """Each has about 37 keys, which Spark's estimate of the exploded table leaves out."""
    own = materialize(spark.range(3000).select(F.xxhash64("id").alias("fp")), "test")
    pairs = simhash.near_pairs(own)
    plan = pairs._jdf.queryExecution().executedPlan()
    assert "Broadcast" not in plan.toString() and "SortMergeJoin" in plan.toString()
    pairs.collect()
    assert "Broadcast" not in plan.toString()  # nor once the sizes are known


def test_op8_broadcasts_no_table_of_keys(spark, tmp_path, monkeypatch):
    spark.range(300).selectExpr("id AS doc_id", "concat('w', id, ' a b c d') AS text").write.parquet(f"{tmp_path}/documents.parquet")
    plans, find = [], simhash.components

    def components(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return find(links)

    monkeypatch.setattr(simhash, "components", components)
    assert entry.queries()["op8_simhash"](spark, str(tmp_path)).count() == 300
    assert len(plans) == 1 and "Generate" in plans[0] and "Broadcast" not in plans[0]


def test_one_row_of_each_group_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    groups = simhash.near_duplicates(docs).select("root").distinct().count()
    kept = kept.collect()
    assert len(kept) == groups
    ids = {c for c in brute_components([r[1] for r in rows], [brute_fingerprint(r[2]) for r in rows]) if c is not None}
    assert {r.doc_id for r in kept if r.doc_id is not None} == ids


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_one_per_group(docs).count() == 0
