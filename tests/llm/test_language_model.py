"""Language model: base scores against brute force, scores against the same model by dictionaries, the trie's parts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wordlens.llm import language_model as lm
from wordlens.llm.ngram_trie import CONTEXT_BITS, EliasFano, Level, codebook, codes

SCHEMA = "word string, doc_id bigint, text string, chunk int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = {"shard_tokens": 300, "chunk_bytes": 2_000}


def corpus(n=150):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(30)] + ["É", "Abc", "x y"]
    rows = [("c", i, " ".join(rng.choice(vocab[:rng.choice([3, 33])]) for _ in range(rng.choice([0, 1, 5, 80]))), 1) for i in range(n)]
    return rows + [("c", None, "lonely words", 1), ("c", 500, None, 1), ("c", 501, "", 1), rows[3], rows[3], ("c", -4, "new " * 3000, 1)]


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def held_out(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


def brute(rows):
    c = Counter(t for _, d, text, _ in rows if not held_out(d) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return [(d, held_out(d), len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n,
             sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tokens(t))) for _, d, t, _ in rows]


key = lambda t: tuple((x is None, x or 0) for x in t)


@pytest.mark.parametrize("how", [{}, SMALL, SMALL | {"common_share": 0.2}, SMALL | {"common_share": 0.01}])
def test_base_scores(spark, how):
    rows = corpus()
    got = sorted((tuple(r) for r in lm.score_texts(spark.createDataFrame(rows, SCHEMA).repartition(2), **how).collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(g[6] < 0 for g in got)


def plain_scores(rows):
    """The same model by dictionaries: all words, all n-grams that training has twice."""
    seqs = [["<s>"] + tokens(t) for _, d, t, _ in rows if not held_out(d)]
    c1 = Counter(x for s in seqs for x in s)
    grams = {n: Counter(tuple(s[i:i + n]) for s in seqs for i in range(len(s) - n + 1)) for n in (2, 3)}
    kept = {n: {g: c for g, c in grams[n].items() if c >= 2} for n in (2, 3)}
    taken = Counter()
    for n in (2, 3):
        for g, c in kept[n].items():
            taken[g[:-1]] += c - 0.75
    total = sum(c1.values()) - c1["<s>"] + len(c1) - ("<s>" in c1) + 1

    def p(context, w):
        if not context:
            return (c1[w] + 1) / total
        of = c1[context[0]] if len(context) == 1 else kept[2].get(context, 0)
        if not of:
            return p(context[1:], w)
        own = max(kept[len(context) + 1].get(context + (w,), 0) - 0.75, 0) / of
        return own + (of - taken[context]) / of * p(context[1:], w)

    def score(text):
        s = ["<s>"] + tokens(text)
        return sum(math.log10(p(tuple(s[max(0, i - 2):i]), s[i])) for i in range(1, len(s)))

    return [(d, score(t), len(tokens(t))) for _, d, t, _ in rows]


@pytest.mark.parametrize("bits,near", [(16, 2e-4), (8, 0.03)])
@pytest.mark.parametrize("how", [{}, SMALL, SMALL | {"common_share": 0.2}, SMALL | {"common_share": 0.01}])
def test_scores_against_plain_model(spark, how, bits, near):
    """Off by the codebook's steps at most, whatever the shards, chunks and contexts that are dealt out."""
    rows = corpus()
    got = sorted(((r.doc_id, r.score) for r in lm.score_texts(spark.createDataFrame(rows, SCHEMA).repartition(2), bits=bits, **how).collect()), key=key)
    want = sorted(plain_scores(rows), key=key)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(abs(g[1] - w[1]) <= near * w[2] for g, w in zip(got, want))


def test_scores_come_from_the_trie(spark, monkeypatch):
    def search(self, *_):
        raise RuntimeError("the trie was asked")

    monkeypatch.setattr(Level, "search", search)
    with pytest.raises(Exception, match="the trie was asked"):
        lm.score_texts(spark.createDataFrame(corpus(), SCHEMA)).collect()


def test_model_beats_unigrams_on_held_out_texts(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        w = rng.randrange(40)
        text = []
        for _ in range(40):
            text.append(f"w{w}")
            w = (w * 7 + rng.choice([1, 1, 1, 2])) % 40
        rows.append(("c", i, " ".join(text), 1))
    got = [r for r in lm.score_texts(spark.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    assert len(got) > 30 and sum(r.score for r in got) > 0.6 * sum(r.base_score for r in got)


def test_an_ngram_counts_the_same_in_a_large_corpus(spark):
    """Two million other tokens do not take an n-gram that stands twice out of the model."""
    train = [i for i in range(3000) if not held_out(i)]
    ask = next(i for i in range(5000, 6000) if held_out(i))
    rare = " ".join(f"rare{i}" for i in range(20))
    rows = [("c", i, rare, 1) for i in train[:2]] + [("c", ask, rare, 1)]
    rows += [("c", i, "a b c d e f g h " * 160, 1) for i in train[2:]]
    got = {r.doc_id: r for r in lm.score_texts(spark.createDataFrame(rows, SCHEMA)).collect()}[ask]
    assert got.train_tokens > 3_000_000 and got.score > 0.3 * got.base_score


def test_a_common_bigram_does_not_swell_a_shard(spark):
    """"the of" is a third of all bigrams, with another word after it each time: its successors go to all shards."""
    rows = [("c", i, " ".join(f"the of x{i}y{j}" for j in range(60)), 1) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text")
    n, _, common = lm.common_words(docs, 1e-3, 20_000)
    shared = spark.sparkContext.broadcast(common)
    sizes = Counter()
    for r in lm.packed_grams(docs, shared, 8, 20_000).collect():
        sizes[r.level, r.shard] += len(lm.unpack(r.pairs, np.uint64))
    own = [sizes[1, s] for s in range(8)]
    assert n > 20_000 and max(own) < 1.5 * np.mean(own)


def test_empty_tables(spark):
    assert lm.score_texts(spark.createDataFrame([], SCHEMA)).count() == 0
    ids = [i for i in range(50) if held_out(i)][:3]
    got = lm.score_texts(spark.createDataFrame([("c", i, "a b", 1) for i in ids], SCHEMA)).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in got] == [(0, 0, 0.0, 0.0)] * len(ids)


@pytest.mark.parametrize("n,bound", [(0, 1), (1, 1), (5, 3), (1000, 1 << 62), (1000, 900), (3000, 1 << 20)])
def test_elias_fano(n, bound):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, bound, n))
    ef = EliasFano.of(*EliasFano.build(values).parts())
    assert (ef.values() == values).all()
    probe = np.concatenate([values, rng.integers(0, bound, 200)])
    known = {}
    for i, v in enumerate(values.tolist()):
        known.setdefault(v, i)
    assert ef.find(probe).tolist() == [known.get(v, -1) for v in probe.tolist()]


def test_a_level_against_plain_lookups():
    rng = np.random.default_rng(3)
    contexts = np.unique(rng.integers(0, 1 << CONTEXT_BITS, 300))
    pairs = sorted({(int(rng.integers(300)), int(rng.integers(1 << 24))) for _ in range(900)})
    parent, word = (np.array(x) for x in zip(*pairs))
    parent = parent % len(contexts)
    order = np.lexsort((word, parent))
    parent, word = parent[order], word[order]
    totals, back, prob = rng.integers(1, 10 ** 9, len(contexts)), rng.random(len(contexts)), rng.random(len(parent))
    level = Level.mapped(Level.build(contexts, totals, back, parent, word, prob).to_bytes())
    asked = np.concatenate([contexts[::3], contexts[::3] + 1])
    ask_parent, ask_word = np.repeat(np.arange(len(asked)), 4), rng.choice(word, 4 * len(asked))
    total, b, p = level.search(asked, ask_parent, ask_word)
    where = {c: i for i, c in enumerate(contexts.tolist())}
    found = {(int(x), int(y)): i for i, (x, y) in enumerate(zip(parent, word))}
    assert total.tolist() == [int(totals[where[c]]) if c in where else 0 for c in asked.tolist()]
    assert b.tolist() == [int(codes(back, 8)[where[c]]) if c in where else 0 for c in asked.tolist()]
    hits = [found.get((where.get(int(asked[i]), -1), int(w)), -1) for i, w in zip(ask_parent, ask_word)]
    assert p.tolist() == [int(codes(prob, 8)[i]) if i >= 0 else 0 for i in hits]
    own = level.search(contexts, parent, word)[2]
    assert (own == codes(prob, 8)).all()
    assert Level.mapped(level.to_bytes()).to_bytes() == level.to_bytes()


@pytest.mark.parametrize("bits", [8, 16])
def test_the_codebook_is_near(bits):
    p = 10.0 ** -np.random.default_rng(1).uniform(0, 9.9, 5000)
    off = np.abs(np.log10(codebook(bits)[codes(p, bits)] / p))
    assert off.max() <= 10 / (2 ** bits - 2) / 2 + 1e-9 and codebook(bits)[0] == 0 and codes(np.array([1.0]), bits)[0] == 1


@pytest.mark.parametrize("kind", [np.uint8, np.uint16, np.uint32, np.uint64])
def test_packed_integers(kind):
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        values = rng.integers(0, np.iinfo(kind).max, n, dtype=kind, endpoint=True)
        assert (lm.unpack(lm.pack(values), kind) == values).all()


def test_chunks_do_not_depend_on_batches():
    texts = [None, "", "a" * 30, "b", "c" * 5, "", "d" * 100, "e"] * 5
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    want = None
    for step in (1, 3, 7, 40):
        batches = [rows.slice(i, step) for i in range(0, len(texts), step)]
        got = [(n, a.to_pylist(), b.to_pylist()) for n, a, b in lm.chunked(iter(batches), 50)]
        assert [x for _, a, _ in got for x in a] == list(range(len(texts)))
        want = want or got
        assert got == want
