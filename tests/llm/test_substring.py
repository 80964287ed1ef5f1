"""Substring dedup against a brute-force search of all windows."""

import hashlib
import random
import re

import pytest

from wordlens.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, n_chars bigint, id string, start int"


def brute(rows, window):
    last = (1 << 63) - 1
    parsed = [(d if d is not None else last, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, ws in parsed:
        for i in range(len(ws) - window + 1):
            k = tuple(ws[i:i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for (d, ws), (own, _) in zip(parsed, rows):
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((own, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["É", "x y"]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    passages = [text(rng.choice([48, 49, 50, 51, 60, 99, 130])) for _ in range(8)]
    line = text(30)
    rows = []
    for i in range(n):
        ws = text(rng.choice([0, 1, 10, 49, 80]))
        for _ in range(rng.randrange(4)):
            p = list(rng.choice(passages))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = "edited"
            ws += p + (line if rng.random() < 0.6 else []) + text(rng.randrange(30))
        rows.append((rng.randrange(10_000), rng.choice([" ", "\n", "  "]).join(ws)))
    rows += [rows[5], rows[5], (3, rows[7][1]), (rows[9][0], rows[8][1]), (None, rows[11][1]),
             (None, rows[11][1]), (None, None), (77, None), (78, ""), (79, " \n"), (80, "same " * 700), (81, "same " * 90)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, len(t or ""), "clash", 1) for d, t in rows], SCHEMA)


key = lambda t: tuple((x is None, x if x is not None else 0) for x in t)


@pytest.mark.parametrize("seed,hot", [(1, 1000), (2, 1000), (3, 3), (4, 0)])
def test_matches_brute_force(spark, seed, hot):
    rows = corpus(seed)
    got = substring.removal_digest(frame(spark, rows), hot_runs=hot).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 50), key=key)


def test_texts_that_stay(spark):
    rows = corpus(9)
    docs = frame(spark, rows)
    got = substring.remove_repeats(docs)
    assert got.columns == docs.columns
    want = {(d, h) for d, n, gone, h in brute(rows, 50) if not n or gone < n}
    kept = got.collect()
    digest = lambda t: hashlib.sha256(" ".join(WORD.findall(t or "")).encode()).hexdigest()
    assert {(r.doc_id, digest(r.text)) for r in kept} == want
    assert all(r.n_chars == len(r.text or "") for r in kept)


def test_automaton_matching_statistics():
    rng = random.Random(3)
    texts = [[rng.choice("abc") for _ in range(rng.randrange(25))] for _ in range(6)]
    automaton = substring.SuffixAutomaton()
    for t in texts:
        automaton.add(t)
    probe = [rng.choice("abcd") for _ in range(200)]
    inside = lambda s: any(t[i:i + len(s)] == s for t in texts for i in range(len(t) - len(s) + 1))
    want = [max(k for k in range(i + 2) if inside(probe[i + 1 - k:i + 1])) for i in range(len(probe))]
    assert automaton.matching_statistics(probe) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert substring.removal_digest(docs).count() == 0 and substring.remove_repeats(docs).count() == 0
