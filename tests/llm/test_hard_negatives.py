"""Hard negatives against all products; the cover tree's levels and how much it leaves out."""

import math

import numpy as np
import pytest

from wordlens.llm import hard_negatives as hn

SCHEMA = "shard int, vec_id bigint, label int, embedding array<float>, block int, score string"


def brute(rows, every=50):
    good = []
    for _, i, label, v, *_ in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, label, v in good:
        if i % every:
            continue
        score = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in good if j != i and len(w) == len(v)]
        ordered = sorted(score, key=lambda t: (-t[0], t[1]))
        for p, j, _ in [t for t in ordered if t[2] == label][:5]:
            inside = [t for t in ordered if t[2] != label and 50 * p <= 100 * t[0] <= 95 * p][:3]
            out += [(i, j, r + 1, t[1], p, t[0]) for r, t in enumerate(inside)]
    return out


def corpus(seed=1, n=900, d=12):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(10, d))
    rows = []
    for i in range(n):
        label = int(rng.integers(10))
        v = centre[label] + rng.normal(size=d) * rng.choice([0.1, 0.6, 1.5])
        v = v / np.linalg.norm(v) * rng.choice([0.05, 1.0, 1.0, 3.0])
        rows.append((0, i, label, [float(x) for x in v], 0, ""))
    same = rows[3][3]
    rows += [(0, 2000 + i, i % 3, same, 0, "") for i in range(250)]  # copies: ties everywhere
    rows += [(0, 3000 + i, 4, [round(x * 2) / 4 for x in rows[i][3]], 0, "") for i in range(100)]
    bad = [None, [], [float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [None] + [0.5] * (d - 1)]
    rows += [(0, 4000 + 50 * i, 1, v, 0, "") for i, v in enumerate(bad)]
    rows += [(0, None, 1, same, 0, ""), (0, 4500, None, same, 0, ""), (0, 4550, 1, [0.0] * d, 0, ""), (0, -50, 2, same, 0, ""),
             (0, 4600, 1, [1.0, 1.0], 0, ""), (0, 4601, 1, [1.0, 0.5], 0, ""), (0, 4602, 2, [0.7, 0.5], 0, ""), rows[7], rows[7]]
    return rows


@pytest.mark.parametrize("how", [{}, {"shard_rows": 100, "block_rows": 7}])
def test_equals_all_products(spark, how):
    rows = corpus()
    got = hn.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) > 100


def test_large_components(spark):
    """Products beyond what floats hold are Python integers."""
    rng = np.random.default_rng(3)
    rows = [(0, i, i % 3, [float(x) for x in rng.normal(size=4)], 0, "") for i in range(120)]
    rows += [(0, 200, 1, [1e6, 0.0, 0.0, 0.0], 0, "")]
    assert sorted(tuple(r) for r in hn.mine(spark.createDataFrame(rows, SCHEMA), every=5).collect()) == sorted(brute(rows, 5))
    x = np.array([[2.0 ** 31, 1.0]])
    assert hn.products(x, x)[0, 0] == (1 << 42) - 1
    assert hn.products(np.array([[3.0, 2.0 ** 30]]), np.array([[5.0, -1.0]]))[0, 0] == 15 - 2 ** 30


def test_empty_tables(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.mine(spark.createDataFrame([(0, 50, 1, [1.0], 0, "")], SCHEMA)).count() == 0


def clustered(n=3000, d=16):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(30, d))
    x = np.floor(256 * (centre[rng.integers(30, size=n)] + 0.05 * rng.normal(size=(n, d))))
    return rng.permutation(n), rng.integers(3, size=n), x


def test_levels_cover_and_separate():
    tree = hn.CoverTree(*clustered())
    p = np.concatenate([tree.x / tree.norm, np.sqrt(np.maximum(1 - (tree.x ** 2).sum(axis=1, keepdims=True) / tree.norm ** 2, 0))], axis=1)
    assert tree.first[0] == 0 and tree.last[0] == len(tree.ids)
    for n in np.flatnonzero(tree.children).tolist():
        kids = np.arange(tree.child[n], tree.child[n] + tree.children[n])
        assert tree.first[kids[0]] == tree.first[n] and tree.last[kids[-1]] == tree.last[n]
        assert (tree.first[kids[1:]] == tree.last[kids[:-1]]).all() and tree.centre[n] in tree.centre[kids]
        radius = tree.radii[tree.level[kids[0]]]
        centres = p[tree.centre[kids]]
        apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0)) + 10 * np.eye(len(kids))
        assert apart.min() > radius - 1e-9
        for k in kids.tolist():
            rows = p[tree.first[k]:tree.last[k]]
            assert np.linalg.norm(rows - p[tree.centre[k]], axis=1).max() <= radius + 1e-9


def test_bounds_hold_and_leave_out_most():
    ids, labels, x = clustered()
    tree = hn.CoverTree(ids, labels, x)
    q = x[:40]
    length = np.linalg.norm(q, axis=1)
    least, most = tree.bounds(q, length, np.arange(len(tree.first)))
    true = q @ tree.x.T
    for n in range(len(tree.first)):
        own = true[:, tree.first[n]:tree.last[n]]
        assert (own.max(axis=1) <= most[:, n]).all() and (own.min(axis=1) >= least[:, n]).all()
    every = np.full((1, 1), -(1 << 41)), np.full((1, 1), 1 << 41)
    visited = [tree.search(x[i:i + 1], ids[i:i + 1], labels[i:i + 1], True, 5, *every)[1] for i in range(40)]
    assert np.mean(visited) < 0.25 * len(ids)


def test_a_dumped_tree_is_the_same():
    tree = hn.CoverTree(*clustered(200))
    other = hn.CoverTree.load(tree.dump())
    assert all(np.array_equal(getattr(tree, f), getattr(other, f)) for f in tree.FIELDS)
