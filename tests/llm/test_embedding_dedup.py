"""Embedding near-dedup against all pairs; recall of the cells on pairs just above the threshold."""

import math

import numpy as np
import pytest

from wordlens.llm import embedding_dedup as dedup

SCHEMA = "key string, vec_id bigint, embedding array<double>, cells int, label int"
NAN, INF = float("nan"), float("inf")


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [("k", i, None if v is None else [None if x is None else float(x) for x in v], 1, 2) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors, ids, least=0.95):
    n = len(vectors)
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    unit = [None if not g else np.array(v, float) / np.abs(v).max() for v, g in zip(vectors, good)]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    link = [[j for j in range(n) if j != i and good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least]
            for i in range(n)]
    root = [None] * n
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        root[i] = min((ids[j] for j in seen if ids[j] is not None), default=None)
    return [(ids[i], len(link[i]), root[i], root[i] == ids[i]) for i in range(n)]


def near(rng, v, cosine):
    """A vector at this cosine of v."""
    v = v / np.linalg.norm(v)
    w = rng.normal(size=len(v))
    w -= (w @ v) * v
    return cosine * v + math.sqrt(1 - cosine ** 2) * w / np.linalg.norm(w)


def mixed(rng, n=300, d=16):
    """Random vectors, chains, tight and loose groups, copies, scaled copies and bad values."""
    base = rng.normal(size=(n, d))
    out = [*base]
    for i in range(30):
        out.append(near(rng, base[i], 0.96))
        out.append(near(rng, out[-1], 0.955))
    out += [near(rng, base[40], 0.995) for _ in range(60)] + [near(rng, base[41], 0.978) for _ in range(60)]
    out += [base[42]] * 40 + [base[42] * 3.0, base[42] * 1e-200, base[43] * 1e200, base[43]]
    out += [None, [], [0.0] * d, [NAN] + [1.0] * (d - 1), [INF] * d, [None] + [1.0] * (d - 1), [-0.0] * (d - 1) + [1.0], [0.0] * (d - 1) + [1.0]]
    out += [[1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 3.0], [-1.0]]
    return out


@pytest.mark.parametrize("how", [{}, {"block_rows": 16}, {"cell_rows": 20, "probes": 40}, {"cell_rows": 20, "probes": 40, "block_rows": 8},
                                 {"cell_rows": 8, "probes": 60, "flat_cells": 10}])
def test_equals_all_pairs(spark, how):
    """With as many probes as cells every pair meets, whatever the cells and blocks."""
    vectors = mixed(np.random.default_rng(1))
    ids = list(np.random.default_rng(2).permutation(len(vectors)).tolist())
    ids[-4], ids[-3], ids[60], ids[61], ids[5] = None, None, ids[62], ids[62], None
    got = [tuple(r) for r in dedup.near_duplicates(table(spark, vectors, ids).repartition(3), **how).collect()]
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(got, key=key) == sorted(brute(vectors, ids), key=key)


@pytest.mark.parametrize("how", [{}, {"flat_cells": 30}])
@pytest.mark.parametrize("cosine", [0.951, 0.97])
def test_recall_of_the_cells(spark, how, cosine):
    """Pairs of random directions in 64 dimensions, and a dense group of a third of the rows, in about 100 cells."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(2_000, 64))
    pairs = [near(rng, v, cosine) for v in base[:1000]]
    group = [near(rng, base[0], 0.993) for _ in range(1500)]
    got = {r.vec_id: r for r in dedup.near_duplicates(table(spark, [*base, *pairs, *group]), cell_rows=45, **how).collect()}
    found = sum(got[i].component_id == got[2000 + i].component_id for i in range(1, 1000))
    assert found >= 0.97 * 999
    x = np.array([v / np.linalg.norm(v) for v in [*base, *pairs, *group]])
    truth = (x @ x.T >= 0.95).sum(axis=1) - 1
    inside = np.array([got[i].n_links for i in range(len(x))])
    assert (inside <= truth).all() and inside[3000:].sum() >= 0.999 * truth[3000:].sum()


def test_pairs_below_the_threshold_do_not_link(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=64)
    got = dedup.near_duplicates(table(spark, [v, near(rng, v, 0.9499), near(rng, -v, 0.99)])).collect()
    assert [(r.n_links, r.kept) for r in got] == [(0, True)] * 3


def test_empty_and_all_bad(spark):
    assert dedup.near_duplicates(table(spark, [])).count() == 0
    got = dedup.near_duplicates(table(spark, [None, [0.0]])).collect()
    assert sorted(tuple(r) for r in got) == [(0, 0, 0, True), (1, 0, 1, True)]
