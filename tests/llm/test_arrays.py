"""Words, hashes and components."""

import random

import numpy as np
import pyarrow as pa
import pytest

from wordlens.llm import arrays
from wordlens.llm.components import components


@pytest.mark.parametrize("max_bytes", [1, 20, 1 << 20])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_rows(max_bytes, kind):
    rng = random.Random(1)
    rows = [None, "", " ", "one", " é\t漢  x", "a\x0bb\x0cc\rd\ne", "tail "] + [
        "".join(rng.choice("ab \n") for _ in range(rng.randrange(30))) for _ in range(50)]
    column = pa.array(["cut", *rows], kind).slice(1)
    got, hashes = [], {}
    for w in arrays.words(column, max_bytes=max_bytes):
        h = w.hashes()
        for r in range(w.n_rows):
            own = range(int(w.first[r]), int(w.first[r + 1]))
            got.append([w.text(i) for i in own])
            for i in own:
                assert hashes.setdefault(w.text(i), h[i]) == h[i]
        assert w.row().tolist() == [r for r in range(w.n_rows) for _ in range(int(w.counts()[r]))]
    assert got == [(x or "").encode().split() for x in rows]
    assert len(set(hashes.values())) == len(hashes)
    assert list(arrays.texts(column)) == [(x or "").encode() for x in rows]


def test_gram_and_span_hashes_depend_on_content_alone():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, 400).astype(np.uint64)
    for k in (1, 4, 50):
        seen = {}
        for i, h in enumerate(arrays.gram_hashes(words, k).tolist()):
            assert seen.setdefault(words[i:i + k].tobytes(), h) == h
        assert len(set(seen.values())) == len(seen)
    starts = rng.integers(0, 300, 500)
    ends = starts + rng.integers(1, 100, 500)
    seen = {}
    for a, b, h in zip(starts, ends, arrays.span_hashes(words, starts, ends).tolist()):
        assert seen.setdefault(words[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(120)] + [(5000, 2000 + i) for i in range(150)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
