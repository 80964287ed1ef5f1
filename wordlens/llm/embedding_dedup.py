"""Embedding near-duplicates: spherical k-means cells, blocked cosine products within cells, components of the links.

1. Equal vectors become one class (a digest of their bytes), so a vector that many rows share is compared once.
2. Spherical k-means on a bounded sample of classes gives centroids; their number grows with the table, up to
   ``MAX_CELLS``. Centroids closer than twice the linking angle are merged into one, so that a group of near copies
   has one cell and not a part of many.
3. A class goes to its nearest cell. Cells in which the sample has several classes within half the linking angle of the
   centroid are dense, and all classes that near are *core* there: any two core classes of a cell are linked without a comparison, and
   core classes of two cells never are. A class that is not core also goes to its next nearest cells, and every
   class goes to each dense cell whose centroid is within one and a half linking angles, where the core classes are
   that it may be linked to.
4. Within a cell, products of blocks of bounded size give the pairs at or above the threshold, counted for each
   class in the smallest cell that both are in. A block pair returns sums and a spanning forest, never its pairs. Cells beyond a block's size are
   split into blocks, and all block pairs are compared in tasks of their own (none of two core blocks).
5. The forests' components are the groups; the row with the smallest id of each is kept.

Pairs with a core class, equal vectors and tables of one cell are exact. Other pairs are found if the two share one
of their nearest cells (measured in the tests and README).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.components import components
from wordlens.llm.vectors import matrices, unit
from wordlens.llm.worker import receive, send
from wordlens.session import materialize

LEAST_COSINE = 0.95
#: Rows of the k-means sample at most, classes of a cell on average, cells at most, cells of a class that is not core.
TRAIN_ROWS, CELL_ROWS, MAX_CELLS, PROBES = 32_768, 512, 16_384, 3
#: Classes in a block of a cell (so a side of a product); top-level cells are used beyond so many cells.
BLOCK_ROWS, FLAT_CELLS = 2_048, 256
#: Lloyd rounds; classes of the sample that make a cell dense.
ROUNDS, DENSE = 8, 2


def keyed(table: DataFrame, vector: str, kind: str) -> DataFrame:
    """(vec_id, key, vector): each row's digest of its vector, and its floats (NumPy type ``kind``); null if it has no direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key: list = [None] * batch.num_rows
            raw: list = [None] * batch.num_rows
            for rows, x in matrices(batch.column("vector")):
                some = x.any(axis=1)
                for r, own in zip(rows[some].tolist(), (x[some] + 0.0).astype(kind)):  # + 0.0: no negative zeros
                    raw[r] = own.tobytes()
                    key[r] = hashlib.blake2b(raw[r], digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(key, pa.binary()), pa.array(raw, pa.binary())],
                                             ["vec_id", "key", "vector"])

    own = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector).alias("vector"))
    return own.mapInArrow(run, "vec_id bigint, key binary, vector binary")


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """At most k unit centroids of the unit vectors x (spherical k-means from a random start)."""
    if k >= len(x):
        return x
    centre = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, centre, 1)[0][:, 0]
        order = np.argsort(near, kind="stable")
        used, first = np.unique(near[order], return_index=True)
        total = np.add.reduceat(x[order], first, axis=0)
        size = np.linalg.norm(total, axis=1)
        centre = total[size > 1e-9] / size[size > 1e-9, None]
    return centre


def nearest(x: np.ndarray, centre: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n nearest centroids of each row, nearest first, and their cosines."""
    n, step = min(n, len(centre)), max(1, (1 << 22) // len(centre))
    which, cosine = [np.empty((0, n), np.int64)], [np.empty((0, n))]
    for at in range(0, len(x), step):
        s = x[at:at + step] @ centre.T
        top = np.argpartition(-s, n - 1, axis=1)[:, :n]
        value = np.take_along_axis(s, top, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        which.append(np.take_along_axis(top, order, axis=1))
        cosine.append(np.take_along_axis(value, order, axis=1))
    return np.concatenate(which), np.concatenate(cosine)


def merged(centre: np.ndarray, weight: np.ndarray, least_cosine: float) -> np.ndarray:
    """Centroids with those of a cosine above least_cosine merged, heaviest first, until none is left."""
    while True:
        order = np.argsort(-weight, kind="stable")
        centre, weight = centre[order], weight[order]
        owner = np.full(len(centre), -1)
        for i in range(len(centre)):
            if owner[i] < 0:
                owner[(centre @ centre[i] > least_cosine) & (owner < 0)] = i
                owner[i] = i
        heads = np.unique(owner)
        if len(heads) == len(centre):
            return centre
        total, own = np.zeros_like(centre), np.zeros(len(centre))
        np.add.at(total, owner, centre * weight[:, None])
        np.add.at(own, owner, weight)
        centre, weight = total[heads], own[heads]
        size = np.linalg.norm(centre, axis=1)
        centre, weight = centre[size > 1e-9] / size[size > 1e-9, None], weight[size > 1e-9]


class Cells:
    """Centroids in one level or two: with many, those of the nearest top-level cells are looked at."""

    def __init__(self, sample: np.ndarray, k: int, theta: float, flat: int = FLAT_CELLS):
        apart = math.cos(min(2 * theta + 1e-6, math.pi))
        leaves, top = self._fit(sample, k, flat)
        weight = np.bincount(nearest(sample, leaves, 1)[0][:, 0], minlength=len(leaves)).astype(float)
        self.leaves = merged(leaves, weight, apart)
        which, cosine = nearest(sample, self.leaves, 1)
        inside = which[cosine >= math.cos(theta / 2)]
        self.dense = np.flatnonzero(np.bincount(inside, minlength=len(self.leaves)) >= DENSE)
        self.top = top if len(self.leaves) > flat else None
        if self.top is not None:
            self.owner = nearest(self.leaves, self.top, 1)[0][:, 0]

    @staticmethod
    def _fit(x: np.ndarray, k: int, flat: int) -> tuple[np.ndarray, np.ndarray | None]:
        if k <= flat:
            return kmeans(x, k), None
        top = kmeans(x, math.ceil(math.sqrt(k)))
        near = nearest(x, top, 1)[0][:, 0]
        parts = [kmeans(x[near == i], max(1, round(k * np.count_nonzero(near == i) / len(x)))) for i in np.unique(near)]
        return np.concatenate(parts), top

    def near(self, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The n nearest cells of each row and their cosines; padded with -1 and -2."""
        if self.top is None:
            which, cosine = nearest(x, self.leaves, n)
            pad = ((0, 0), (0, n - which.shape[1]))
            return np.pad(which, pad, constant_values=-1), np.pad(cosine, pad, constant_values=-2.0)
        best, value = np.full((len(x), n), -1), np.full((len(x), n), -2.0)
        tops = nearest(x, self.top, n + 2)[0]
        for t in np.unique(tops).tolist():
            own = np.flatnonzero(self.owner == t)
            rows = np.flatnonzero((tops == t).any(axis=1))
            if len(own):
                which, cosine = nearest(x[rows], self.leaves[own], n)
                which = np.concatenate([best[rows], own[which]], axis=1)
                cosine = np.concatenate([value[rows], cosine], axis=1)
                order = np.argsort(-cosine, axis=1, kind="stable")[:, :n]
                best[rows], value[rows] = np.take_along_axis(which, order, axis=1), np.take_along_axis(cosine, order, axis=1)
        return best, value


def assign(classes: DataFrame, cells: Cells | None, dim: int, theta: float, probes: int, kind: str) -> DataFrame:
    """Adds cells (home first) and core. Vectors of another length than ``dim`` are in one cell for each length, -length."""
    shared = send(classes.sparkSession, cells)
    half, wide = math.cos(theta / 2 - 1e-9), math.cos(min(1.5 * theta + 1e-6, math.pi))
    size = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = receive(shared)
        for batch in batches:
            own: list = [None] * batch.num_rows
            core = np.zeros(batch.num_rows, bool)
            raw = batch.column("vector").to_pylist()
            length = np.array([len(x) // size for x in raw], np.int64)
            for r in np.flatnonzero(length != dim).tolist():
                own[r] = [-int(length[r])]
            rows = np.flatnonzero(length == dim)
            if len(rows):
                x = unit(np.frombuffer(b"".join(raw[r] for r in rows.tolist()), kind).reshape(-1, dim).astype(float))
                which, cosine = known.near(x, probes)
                core[rows] = np.isin(which[:, 0], known.dense) & (cosine[:, 0] >= half)
                reach = x @ known.leaves[known.dense].T >= wide
                for i, r in enumerate(rows.tolist()):
                    near = which[i][:1] if core[r] else which[i][which[i] >= 0]
                    own[r] = list(dict.fromkeys(near.tolist() + known.dense[reach[i]].tolist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.list_(pa.int32())), pa.array(core)],
                                             [*batch.schema.names, "cells", "core"])

    return classes.mapInArrow(run, "key binary, least bigint, copies bigint, vector binary, cells array<int>, core boolean")


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of n nodes reaches over the links a-b."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(table: pa.Table, least_cosine: float, step: int, kind: str) -> pa.Table:
    """Links within one cell (or between two of its blocks): (id, links, root) of each class that has any."""
    cell, lo, hi = (table.column(c)[0].as_py() for c in ("cell", "lo", "hi"))
    ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
    core = table.column("core").to_numpy().astype(bool)
    raw = table.column("vector").to_pylist()
    x = unit(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(float))
    lists = table.column("cells").to_pylist()
    width = max(map(len, lists))
    own_cells = np.array([(sorted(c) + [1 << 30] * width)[:width] for c in lists])
    home = np.array([c[0] for c in lists])
    part = table.column("part").to_numpy()
    left, right = (np.arange(len(ids)),) * 2 if lo == hi else (np.flatnonzero(part == lo), np.flatnonzero(part == hi))
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    links = np.zeros(len(ids), np.int64)
    for at in range(0, len(left), step):
        rows = left[at:at + step]
        i, j = np.nonzero(x[rows] @ x[right].T >= least_cosine)
        a, b = rows[i], right[j]
        keep = a < b if lo == hi else np.ones(len(a), bool)
        keep &= ~(core[a] & core[b] & (home[a] == home[b]))  # linked without a comparison
        a, b = a[keep], b[keep]
        first = np.full(len(a), 1 << 30)
        for p in range(width):
            mine = own_cells[a, p]
            shared = (own_cells[b] == mine[:, None]).any(axis=1)
            first = np.minimum(first, np.where(shared, mine, 1 << 30))
        a, b = a[first == cell], b[first == cell]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        tree = _forest(len(ids), np.concatenate([*found_a, a]), np.concatenate([*found_b, b]))
        child = np.flatnonzero(tree != np.arange(len(ids)))
        found_a, found_b = [child], [tree[child]]
    tree = _forest(len(ids), found_a[0], found_b[0])
    some = np.flatnonzero(links)
    return pa.table({"id": ids[some], "links": links[some], "root": ids[tree[some]]})


def links_of(classes: DataFrame, least_cosine: float, block_rows: int, kind: str, max_cells: int) -> DataFrame:
    """(id, links, root) parts of classes(id, copies, vector, cells, core); sums of links and components of (id, root) are the whole."""
    spread = classes.select("id", "copies", "vector", "cells", "core", F.explode("cells").alias("cell"))
    sizes = classes.select("core", F.explode("cells").alias("cell")).groupBy("cell").agg(
        F.ceil(F.count_if("core") / block_rows).cast("int").alias("n_core"),
        F.ceil(F.count_if(~F.col("core")) / block_rows).cast("int").alias("n_other"), F.count("*").alias("n"))
    sizes = materialize(sizes.where("n > 1").withColumn("whole", F.col("n") <= block_rows), "embedding_cells")
    if sizes.count() <= 2 * max_cells:  # always, but for a table of vectors of very many lengths
        sizes = F.broadcast(sizes)
    dealt = spread.join(sizes, "cell")
    number = F.xxhash64("id")
    part = (F.when(F.col("whole"), 0).when(F.col("core"), F.pmod(number, F.col("n_core")))
            .otherwise(F.col("n_core") + F.pmod(number, F.greatest("n_other", F.lit(1))))).cast("int")
    dealt = dealt.withColumn("part", part)
    others = F.when(F.col("n_other") > 0, F.sequence(F.col("n_core"), F.col("n_core") + F.col("n_other") - 1))
    every = F.sequence(F.lit(0), F.col("n_core") + F.col("n_other") - 1)
    to = (F.when(F.col("whole"), F.array(F.lit(0))).when(F.col("core"), others).otherwise(every)).cast("array<int>")
    dealt = dealt.withColumn("to", F.explode(to))
    pairs = dealt.select("cell", F.least("part", "to").alias("lo"), F.greatest("part", "to").alias("hi"), "part", "id",
                         "copies", "vector", "cells", "core")
    compared = pairs.groupBy("cell", "lo", "hi").applyInArrow(
        lambda t: _compare(t, least_cosine, max(1, block_rows // 4), kind), "id bigint, links bigint, root bigint")
    home = F.element_at("cells", 1)
    core = classes.where("core").select("id", "copies", home.alias("home"))
    groups = core.groupBy("home").agg(F.sum("copies").alias("total"), F.min("id").alias("root"), F.count("*").alias("n"))
    certain = core.join(groups.where("n > 1"), "home").select("id", (F.col("total") - F.col("copies")).alias("links"), "root")
    return compared.unionByName(certain)


def near_duplicates(table: DataFrame, vector: str = "embedding", least_cosine: float = LEAST_COSINE,
                    train_rows: int = TRAIN_ROWS, cell_rows: int = CELL_ROWS, max_cells: int = MAX_CELLS,
                    probes: int = PROBES, block_rows: int = BLOCK_ROWS, flat_cells: int = FLAT_CELLS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of table(vec_id, vector).

    n_links counts the other rows with a cosine of at least least_cosine (double precision) that were found;
    component_id is the smallest vec_id reachable over such links, the row's own included; kept tells whether that is its own.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Vectors of different
    lengths do not link. Repeated rows link with one another; a null vec_id is no minimum (a component of such rows alone
    has a null id and all its rows are kept). Other columns are ignored; an empty table gives an empty one.

    Only vectors of the sample's most common length are in k-means cells; those of other lengths are all compared.
    """
    theta = math.acos(least_cosine)
    kind = "<f4" if dict(table.dtypes)[vector] == "array<float>" else "<f8"
    size = np.dtype(kind).itemsize
    rows = keyed(table, vector, kind)
    own = materialize(rows.select("vec_id", "key"), "embedding_keys")
    n = own.count()
    # keys are digests, so their hash is a fair draw; about 1.5 times the sample's size pass the first test
    rate = min(1.0, 1.5 * train_rows / max(n, 1))
    drawn = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1_000_000))
    sample = (rows.where(F.col("key").isNotNull() & (drawn < math.ceil(rate * 1_000_000))).dropDuplicates(["key"])
              .orderBy("key").limit(train_rows).select("vector").toArrow().column("vector").to_pylist())
    lengths = np.array([len(x) // size for x in sample] or [0], np.int64)
    dim = int(np.bincount(lengths).argmax())
    points = [x for x in sample if len(x) == size * dim]
    cells = None
    if points:
        k = min(max_cells, max(1, n // cell_rows))
        cells = Cells(unit(np.frombuffer(b"".join(points), kind).reshape(-1, dim).astype(float)), k, theta, flat_cells)
    classes = rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    placed = materialize(assign(classes, cells, dim, theta, probes, kind).withColumn("id", F.monotonically_increasing_id()),
                         "embedding_classes")
    found = materialize(links_of(placed, least_cosine, block_rows, kind, max_cells), "embedding_links")
    parts = components(found.select("id", "root"), "id", "root")
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    rooted = (placed.select("key", "id", "least", "copies").join(parts.withColumnRenamed("node", "id"), "id", "left")
              .join(counted, "id", "left").withColumn("root", F.coalesce("root", "id")))
    rooted = materialize(rooted, "embedding_roots")
    # a table of its own: a join right above an aggregation can't split a large component's rows
    least = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "embedding_components")
    result = materialize(rooted.join(least, "root").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "embedding_groups")
    joined = own.join(result.withColumn("linked", F.lit(True)), "key", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                         component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
