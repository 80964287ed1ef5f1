"""Decontamination against a plain greedy string tiling of all pairs."""

import random
import re

import pyarrow as pa
import pytest

from wordlens.llm import tiling
from wordlens.llm.arrays import words

DOCS = "item_id string, doc_id bigint, text string, coverage int"
ITEMS = "doc_id int, item_id bigint, text string"
WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_tiles(a, b, least):
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = []
        for x in range(len(a)):
            for y in range(len(b)):
                n = 0
                while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n] and free_a[x + n] and free_b[y + n]:
                    n += 1
                if n >= least and (not best or n >= best[0][0]):
                    best = [z for z in best if z[0] == n] + [(n, x, y)]
        if not best:
            return out
        for n, x, y in best:
            if all(free_a[x:x + n]) and all(free_b[y:y + n]):
                free_a[x:x + n] = free_b[y:y + n] = [False] * n
                out.append((n, x, y))


def corpus():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(25)] + ["É"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(0, i, text(rng.choice([2, 4, 5, 20, 45]))) for i in range(12)] + [(0, 50, None), (0, 51, "!!"), (0, None, text(30))]
    items.append(items[3])
    docs = []
    for i in range(60):
        own = (rng.choice(items)[2] or "").split()
        if rng.random() < 0.4 and len(own) > 9:  # reordered
            k = len(own) // 2
            own = own[k:] + ["between"] + own[:k]
        if rng.random() < 0.3:
            own = own[:len(own) // 3]
        docs.append(("c", i, f"{text(rng.randrange(30))}, {' '.join(own).upper()}. {text(rng.randrange(30))}", 1))
    docs += [(None, None, docs[0][2], None), ("", 70, None, 1), ("", 71, "", 1), docs[2], docs[2], ("", 72, text(5000), 0)]
    return docs, items


key = lambda t: tuple((x is None, x or 0) for x in t)


@pytest.mark.parametrize("block", [1_000_000, 60])
def test_matches_plain_tiling(spark, block):
    docs, items = corpus()
    want = []
    for _, d, text, _ in docs:
        for _, i, item in items:
            own = plain_words(item)
            least = min(5, len(own))
            found = plain_tiles(plain_words(text), own, least) if own else []
            covered = sum(t[0] for t in found)
            if found and covered >= 0.5 * len(own):
                want.append((d, i, covered / len(own), len(found), max(t[0] for t in found)))
    got = tiling.contaminated_pairs(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_seeds=block)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    kept = tiling.drop_contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_seeds=block)
    bad = {w[0] for w in want}
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x or 0)) == sorted(
        (d for _, d, _, _ in docs if d not in bad), key=lambda x: (x is None, x or 0))
    assert kept.columns == ["item_id", "doc_id", "text", "coverage"]


def test_tiles_of_random_sequences():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(60))] for _ in range(2))
        own = [next(iter(words(pa.array([" ".join(x)])))).hashes() for x in (a, b)]
        for least in (2, 5):
            assert sorted(tiling.tiles(*own, least)) == sorted(plain_tiles(a, b, least))


def test_empty_tables(spark):
    docs, items = corpus()
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some_docs, some_items = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert tiling.contaminated_pairs(no_docs, some_items).count() == 0
    assert tiling.contaminated_pairs(some_docs, no_items).count() == 0
    assert tiling.drop_contaminated(some_docs, no_items).count() == len(docs)
