"""Sparse suffix array dedup: every passage found stands in both texts; none of guaranteed length is missed."""

import random

import pytest

from wordlens.llm import suffixes

SCHEMA = "start string, doc_id bigint, text string, key int"


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É"]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    passages = [text(k) for k in (45, 49, 51, 60, 75, 90, 140, 300)]
    line = text(35)
    rows = []
    for i in range(70):
        ws = text(rng.choice([0, 5, 40, 120]))
        for _ in range(rng.randrange(3)):
            ws += rng.choice(passages) + (line if rng.random() < 0.5 else []) + text(rng.randrange(30))
        rows.append(("s", i, rng.choice([" ", "\n"]).join(ws), 1))
    return rows + [("s", 100, rows[3][2], 1), ("s", 101, rows[3][2], 1), ("s", 101, rows[4][2], 1), ("s", None, rows[5][2], 1), ("s", 102, None, 1),
                   ("s", 103, "", 1), ("s", 104, "same " * 400, 1), ("s", 105, "same " * 300, 1), rows[9], rows[9]]


def sure_places(a, b, least=73, free=23):
    """Places of a that a common run of at least least words with b has, but for the first ones of each."""
    grams = {tuple(b[i:i + least]) for i in range(len(b) - least + 1)}
    out = set()
    for i in range(len(a) - least + 1):
        if tuple(a[i:i + least]) in grams:
            out.update(range(i + free, i + least))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed):
    rows = corpus(seed)
    got = suffixes.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = {}
    for _, d, t, _ in rows:
        if d is not None:
            texts.setdefault(d, []).append((t or "").split())
    covered = {}
    for r in got:
        assert r.first_doc_id < r.doc_id and r.n_words >= 50
        own = {tuple(t[r.start:r.start + r.n_words]) for t in texts[r.doc_id]}
        other = {tuple(t[r.first_start:r.first_start + r.n_words]) for t in texts[r.first_doc_id]}
        assert any(len(x) == r.n_words for x in own & other)
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.n_words))
    for d, own in texts.items():
        if len(own) > 1 and any(x != own[0] for x in own):
            continue
        must = set()
        for e, others in texts.items():
            if e < d:
                for other in others:
                    must |= sure_places(own[0], other)
        assert must <= covered.get(d, set()), d


def test_documents_without_repeats_are_left_alone(spark):
    rng = random.Random(5)
    rows = [("s", i, " ".join(f"w{rng.randrange(10_000)}" for _ in range(300)), 1) for i in range(30)]
    assert suffixes.repeated_passages(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_empty_table(spark):
    assert suffixes.repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n_words", [50, 60, 80])
def test_every_window_of_an_earlier_document_is_covered(spark, n_words):
    """200 documents, one passage, random surroundings: more partners than a suffix has neighbours."""
    rng = random.Random(n_words)
    text = lambda k: [f"w{rng.randrange(1000)}" for _ in range(k)]
    passage = text(n_words)
    texts = [text(rng.randrange(30, 60)) + passage + text(rng.randrange(30, 60)) for _ in range(200)]
    texts[7] = texts[7] + texts[7]  # with the same surroundings twice
    rows = [("s", i, " ".join(t), 1) for i, t in enumerate(texts)]
    covered = {}
    for r in suffixes.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect():
        assert texts[r.doc_id][r.start:r.start + r.n_words] == texts[r.first_doc_id][r.first_start:r.first_start + r.n_words]
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.n_words))
    known, want = set(), {}
    for i, t in enumerate(texts):
        grams = [tuple(t[k:k + 50]) for k in range(len(t) - 49)]
        old = {p for k, g in enumerate(grams) if g in known for p in range(k, k + 50)}
        if old:
            want[i] = old
        known.update(grams)
    assert len(want) == 199 and covered == want
