"""Quality classifier: held-out accuracy, ordered thresholds, odd rows."""

import random

import numpy as np
import pytest

from wordlens.llm import quality

DOCS = "keep string, doc_id bigint, text string, grade int"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def corpus(n=900):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        ws = [rng.choice(vocab) for _ in range(rng.choice([20, 60, 200]))]
        kind = rng.choice([0, 1, 2, 2])
        if kind == 0:
            ws = [w.upper() + "!!" for w in ws]
        elif kind == 1:
            for _ in range(3):
                ws.insert(rng.randrange(len(ws)), rng.choice(["vile", "nasty", "awful"]))
        docs.append(("x", i, " ".join(ws), None))
        labels.append((i, int(kind > 0), int(kind == 1), "clash"))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    known = [x for x in labels if x[0] % 3]
    got = {r.doc_id: r for r in quality.score_quality(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(known, LABELS)).collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    right = np.mean([got[i].keep == (q == 1 and t == 0) for i, q, t, _ in held])
    assert len(got) == len(docs) and right > 0.95
    mean = {g: np.mean([got[i].expected_grade for i, q, t, _ in held if (q + q * (1 - t)) == g]) for g in range(3)}
    assert mean[0] < mean[1] < mean[2]


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    n = 60
    row = np.repeat(np.arange(n), 3)
    grade = rng.integers(0, 3, n)
    feature = np.where(rng.random(3 * n) < 0.7, grade[row], rng.integers(0, 8, 3 * n))
    pair = np.unique(np.stack([row, feature]), axis=1)
    few = quality.train(pair[0], pair[1], np.ones(pair.shape[1]), grade, steps=1, rate=0.0)
    more = quality.train(pair[0], pair[1], np.ones(pair.shape[1]), grade, steps=200, rate=0.05)
    share = np.bincount(grade, minlength=3)

    def likelihood(model):
        tails = model.tails(model.score(pair[0], pair[1], np.ones(pair.shape[1]), n))
        p = np.concatenate([np.ones((n, 1)), tails, np.zeros((n, 1))], axis=1)
        return np.mean(np.log(p[np.arange(n), grade] - p[np.arange(n), grade + 1]) / np.sqrt(share[grade]))

    assert likelihood(more) > likelihood(few)
    assert more.thresholds[0] < more.thresholds[1]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0, "")], [(None, 1, 0, ""), (1, None, 0, "")]])
def test_without_usable_grades_all_stay(spark, labels):
    docs, _ = corpus(20)
    rows = docs + [(None, None, None, None), ("", 5, "", 1), docs[0], docs[0], ("", 6, "long " * 50_000, 1)]
    frame = spark.createDataFrame(rows, DOCS)
    got = quality.score_quality(frame, spark.createDataFrame(labels, LABELS))
    assert got.columns == ["doc_id", "expected_grade", "p_good", "keep"]
    assert [r.keep for r in got.collect()] == [True] * len(rows)
    kept = quality.keep_good(frame, spark.createDataFrame(labels, LABELS))
    assert kept.columns == frame.columns and sorted(map(str, kept.collect())) == sorted(map(str, frame.collect()))


def test_odd_rows_and_empty_table(spark):
    docs, labels = corpus(200)
    labels += [(None, 1, 1, ""), (3, 0, None, ""), (3, 1, 0, ""), (77, None, None, "")]
    rows = docs + [(None, None, None, None), docs[1], docs[1], (None, None, "", None)]
    known = spark.createDataFrame(labels, LABELS)
    got = quality.score_quality(spark.createDataFrame(rows, DOCS), known).collect()
    assert len(got) == len(rows) and all(0 <= r.expected_grade <= 2 and 0 <= r.p_good <= 1 for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert quality.score_quality(empty, known).count() == 0 and quality.keep_good(empty, known).count() == 0


def test_real_labels(spark):
    """Held-out folds of the given labels."""
    from conftest import SF_MID
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = {r.doc_id: r.keep for r in quality.score_quality(docs, labels.where("doc_id % 4 <> 0")).collect()}
    held = labels.where("doc_id % 4 = 0").collect()
    good = [got[r.doc_id] for r in held if r.quality == 1 and r.toxic == 0]
    bad = [got[r.doc_id] for r in held if r.quality == 0 or r.toxic == 1]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.25


def plain_score(text, model):
    """(expected grade, p_good) from the model's numbers, word by word."""
    import math
    import re
    from collections import Counter

    import plain_hashes as ph

    kind = lambda c: 97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c
    found, before, repeats = Counter(), None, 0
    ws = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    for w in ws:
        lowered = re.sub(rb"[A-Z]", lambda m: m[0].lower(), w)
        found[ph.of_bytes(lowered)] += 1
        for k in (4, 5):
            if len(w) > k:
                found[ph.mix(ph.of_bytes(lowered[:k]) + k)] += 1
        found[ph.mix((kind(w[0]) << 16) + (kind(w[max(len(w) - 2, 0)]) << 8) + kind(w[-1]) + (1 << 24))] += 1
        repeats += lowered == before
        before = lowered
    if repeats:
        found[ph.mix(8 * repeats // len(ws) + (1 << 32))] += 1
    by = Counter()
    for h, n in found.items():
        by[h % quality.DIMENSIONS] += n
    x = {f: (1 + math.log(n)) * model.idf[f] for f, n in by.items()}
    norm = max(math.sqrt(sum(v * v for v in x.values())), 1e-12)
    score = sum(v / norm * model.weights[f] for f, v in x.items())
    tails = [1 / (1 + math.exp(-max(-40, min(40, score - t)))) for t in model.thresholds]
    return sum(tails), tails[quality.KEEP_GRADE - 1]


def test_grades_and_tails_by_plain_rules(spark):
    docs, labels = corpus(300)
    docs += [("x", 1000, None, None), ("x", 1001, "", None), ("x", 1002, "Ünïcode VILE vile vile 99 x!", None), docs[5]]
    frame, known = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    model = quality.fit(frame, known)
    assert model.weights.any() and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in quality.score_quality(frame, known).collect()}
    for _, d, text, _ in docs:
        expected, good = plain_score(text, model)
        assert abs(got[d].expected_grade - expected) < 1e-9 and abs(got[d].p_good - good) < 1e-9
        assert got[d].keep == (good >= quality.KEEP_PROBABILITY)
