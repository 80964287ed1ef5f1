"""Hard negatives by integer inner product, searched in cover trees.

Vectors are quantised (component x becomes floor(256 x)) and get one more component, sqrt(M^2 - |x|^2) with M the largest
norm of a shard, so that all candidates lie on a sphere and inner products with a query follow from angles. A cover
tree over a shard has levels of covering radii that shrink by ``BASE``: a node's children are centres that are further apart than
the next radius, and each row below it is within that radius of its child. Each node keeps the largest angle of its rows to its
centre, which bounds their inner products with any query from both sides.

Candidates are dealt out by hash to shards of about ``SHARD_ROWS`` rows, whose trees are built once and written. Anchors, a
stated set of queries, are dealt out in blocks to every shard. A search takes the node with the best bound first; queries
for which a node is outside their window, or cannot beat what they have, leave it; leaves are verified exactly.

1. Every shard returns its best rows of an anchor's label; the first over all shards are the positives.
2. The positives' scores give windows; every shard returns its best rows of other labels inside each, and the first over
   all shards are the negatives.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordlens.llm.vectors import matrices
from wordlens.session import materialize

SCALE = 256.0
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Rows of a shard and anchors of a block on average; rows of a leaf; how much the radii shrink from level to level.
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS, BASE = 4_096, 1_024, 24, 1.3
#: Bits of a row's place in its shard beside its score in one 64-bit key.
PLACE_BITS = 20
NOTHING = np.iinfo(np.int64).min


def quantised(table: DataFrame, vector: str) -> DataFrame:
    """(vec_id, label, dim, q): q holds floor(256 x) of each component as 64-bit floats. Only rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw: list = [None] * batch.num_rows
            dim = np.zeros(batch.num_rows, np.int32)
            for rows, x in matrices(batch.column("vector")):
                with np.errstate(over="ignore"):
                    own = np.floor(x * SCALE) + 0.0
                for r, v in zip(rows[np.isfinite(own).all(axis=1)].tolist(), own[np.isfinite(own).all(axis=1)]):
                    raw[r], dim[r] = v.tobytes(), len(v)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(dim), pa.array(raw, pa.binary())],
                                             ["vec_id", "label", "dim", "q"])

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    own = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
                       F.col(vector).alias("vector")).withColumn("label", moved)
    return (own.where("vec_id is not null and label is not null")
            .mapInArrow(run, "vec_id bigint, label bigint, dim int, q binary").where("q is not null"))


def _rows(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("q").to_pylist())).reshape(table.num_rows, -1)


def exact(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether 64-bit floats hold all inner products of x and y and the sums they are made of."""
    most = lambda m: float(np.abs(m).max(initial=0))
    return x.shape[1] * most(x) * most(y) < 2.0 ** (62 - PLACE_BITS)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of the rows of x and y as integers; Python's, clipped to 42 bits, where floats can't hold them."""
    if exact(x, y):
        return (x @ y.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    limit = (1 << (62 - PLACE_BITS)) - 1
    return np.clip(whole(x) @ whole(y).T, -limit, limit).astype(np.int64)


class CoverTree:
    """Rows in the order of the tree's leaves, and nodes in the order of its levels.

    Node n has rows first[n] to last[n] - 1, children child[n] to child[n] + children[n] - 1 (none: a leaf),
    the row at its centre and the largest angle of its rows to that. ``radii`` are the levels' covering radii (chords).
    """

    FIELDS = "ids labels x centre angle first last child children level radii norm".split()

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf_rows: int = LEAF_ROWS, base: float = BASE):
        by_id = np.lexsort((labels, ids))
        ids, labels, x = ids[by_id], labels[by_id], x[by_id]
        self.norm = np.sqrt((x * x).sum(axis=1).max(initial=0.0))
        on_sphere = x / self.norm if self.norm else x
        rest = np.sqrt(np.maximum(1.0 - (on_sphere * on_sphere).sum(axis=1), 0.0)) if self.norm else np.ones(len(x))
        p = np.concatenate([on_sphere, rest[:, None]], axis=1)
        nodes: list[list] = []
        order: list[np.ndarray] = []
        radii = [2.0]
        todo = [(np.arange(len(x)), 0, 0, None)] if len(x) else []  # rows, centre's place among them, level, parent
        placed = 0
        members: list[np.ndarray] = []
        while todo:  # a level after another, so that the children of a node are neighbours
            below = []
            for rows, at, level, parent in todo:
                number = len(nodes)
                cosine = np.clip(p[rows] @ p[rows[at]], -1.0, 1.0)
                nodes.append([rows[at], float(np.arccos(cosine.min())), 0, 0, 0, 0, level])
                members.append(rows)
                if parent is not None:
                    if not nodes[parent][5]:
                        nodes[parent][4] = number
                    nodes[parent][5] += 1
                chord = np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))
                if len(rows) <= leaf_rows or chord.max() < 1e-7:  # rounding makes equal points up to 2e-8 apart
                    continue
                radius = radii[level]
                deeper = level
                while radius >= chord.max():
                    radius /= base
                    deeper += 1
                while len(radii) <= deeper:
                    radii.append(radii[-1] / base)
                centres, owner, near = [at], np.zeros(len(rows), np.int64), chord
                while near.max() > radii[deeper]:
                    far = int(near.argmax())
                    other = np.sqrt(np.maximum(2.0 - 2.0 * (p[rows] @ p[rows[far]]), 0.0))
                    closer = other < near
                    owner[closer], near = len(centres), np.minimum(near, other)
                    centres.append(far)
                for i, c in enumerate(centres):
                    own = np.flatnonzero(owner == i)
                    below.append((rows[own], int(np.searchsorted(own, c)), deeper, number))
            todo = below
        first, last = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        stack = [(0, False)] if nodes else []
        while stack:
            n, done = stack.pop()
            if done:
                last[n] = placed
                continue
            first[n] = placed
            if not nodes[n][5]:
                order.append(members[n])
                placed += len(members[n])
                last[n] = placed
                continue
            stack.append((n, True))
            stack += [(c, False) for c in range(nodes[n][4] + nodes[n][5] - 1, nodes[n][4] - 1, -1)]
        order_all = np.concatenate(order) if order else np.empty(0, np.int64)
        place = np.empty(len(order_all), np.int64)
        place[order_all] = np.arange(len(order_all))
        column = lambda i, kind: np.array([n[i] for n in nodes], kind)
        self.ids, self.labels, self.x = ids[order_all], labels[order_all], x[order_all]
        self.centre, self.angle = place[column(0, np.int64)], column(1, float)
        self.first, self.last, self.child, self.children, self.level = first, last, column(4, np.int64), column(5, np.int64), column(6, np.int64)
        self.radii, self.norm = np.array(radii), np.array(self.norm)

    def dump(self) -> bytes:
        out = io.BytesIO()
        small = {"x": self.x.astype(np.int16)} if (np.abs(self.x).max(initial=0) < 1 << 15) else {}
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS} | small)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as held:
            for f in cls.FIELDS:
                setattr(tree, f, held[f])
        tree.x = tree.x.astype(float)
        return tree

    def bounds(self, q: np.ndarray, length: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) inner product of each query with any row below each node, with room for rounding."""
        norm = float(self.norm)
        size = length[:, None] * norm
        cosine = np.divide(q @ self.x[self.centre[nodes]].T, size, out=np.zeros((len(q), len(nodes))), where=size > 0)
        angle = np.arccos(np.clip(cosine, -1.0, 1.0))
        room = 1e-7 * size + 1e-6
        most = size * np.cos(np.maximum(angle - self.angle[nodes], 0.0)) + room
        least = size * np.cos(np.minimum(angle + self.angle[nodes], np.pi)) - room
        return least, most

    def search(self, q: np.ndarray, own_id: np.ndarray, own_label: np.ndarray, same: bool, k: int, low: np.ndarray,
               high: np.ndarray) -> tuple[np.ndarray, int]:
        """The k best rows of each query and window, as sorted keys (score * 2**PLACE_BITS + places left; NOTHING: none),
        and how many rows were verified.

        Rows have the query's label (``same``) or another, another id than the query's, and a score from low to high
        (queries x windows). Better is a higher score, then a smaller id.
        """
        n, windows = low.shape
        best = np.full((n, windows, k), NOTHING)
        if not len(self.ids) or not n:
            return best, 0
        safe = exact(q, self.x)
        length = np.sqrt((q * q).sum(axis=1))
        rank = np.empty(len(self.ids), np.int64)
        rank[np.lexsort((self.labels, self.ids))] = np.arange(len(self.ids))[::-1]
        floor = low.astype(float)  # what a row must have at least to matter to a window
        verified, tick = 0, 0
        queue: list[tuple] = []

        def push(nodes: np.ndarray, active: np.ndarray) -> None:
            nonlocal tick
            least, most = self.bounds(q[active], length[active], nodes) if safe else (
                np.full((len(active), len(nodes)), -np.inf), np.full((len(active), len(nodes)), np.inf))
            for j, node in enumerate(nodes.tolist()):
                wanted = ((most[:, j, None] >= floor[active]) & (least[:, j, None] <= high[active])).any(axis=1)
                if wanted.any():
                    heapq.heappush(queue, (-most[wanted, j].max(), tick, node, active[wanted], least[wanted, j], most[wanted, j]))
                    tick += 1

        push(np.array([0]), np.flatnonzero((low <= high).any(axis=1)))
        while queue:
            _, _, node, active, least, most = heapq.heappop(queue)
            wanted = ((most[:, None] >= floor[active]) & (least[:, None] <= high[active])).any(axis=1)
            active = active[wanted]
            if not len(active):
                continue
            if self.children[node]:
                push(np.arange(self.child[node], self.child[node] + self.children[node]), active)
                continue
            a, b = int(self.first[node]), int(self.last[node])
            score = products(q[active], self.x[a:b])
            verified += score.size
            fits = (own_label[active][:, None] == self.labels[a:b]) == same
            fits &= own_id[active][:, None] != self.ids[a:b]
            key = (score << PLACE_BITS) + rank[a:b]
            for w in range(windows):
                inside = fits & (score >= low[active, w][:, None]) & (score <= high[active, w][:, None])
                some = np.flatnonzero(inside.any(axis=1))
                if not len(some):
                    continue
                rows = active[some]
                both = np.concatenate([best[rows, w], np.where(inside[some], key[some], NOTHING)], axis=1)
                best[rows, w] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                kth = best[rows, w].min(axis=1)
                floor[rows, w] = np.where(kth == NOTHING, floor[rows, w], np.maximum(kth >> PLACE_BITS, low[rows, w]))
        return -np.sort(-best, axis=2), verified

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        """Ids of found keys."""
        return np.sort(self.ids)[len(self.ids) - 1 - (keys & ((1 << PLACE_BITS) - 1))]


def trees(candidates: DataFrame, shards: int) -> DataFrame:
    """(dim, shard, tree): a cover tree for each shard of candidates(vec_id, label, dim, q)."""

    def build(table: pa.Table) -> pa.Table:
        tree = CoverTree(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), _rows(table))
        return pa.table({"dim": table.column("dim")[:1], "shard": table.column("shard")[:1], "tree": pa.array([tree.dump()], pa.binary())})

    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64("vec_id", "q"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, tree binary")


def _search(queries: DataFrame, index: DataFrame, blocks: int, same: bool, k: int) -> DataFrame:
    """(number, window, found_id, score): the k best rows of each shard for each window of queries(number, vec_id, label,
    dim, q, lows, highs)."""

    def run(anchors: pa.Table, shard: pa.Table) -> pa.Table:
        none = pa.table({c: pa.array([], t) for c, t in (("number", pa.int64()), ("window", pa.int32()), ("found_id", pa.int64()), ("score", pa.int64()))})
        if not anchors.num_rows or not shard.num_rows:
            return none
        tree = CoverTree.load(shard.column("tree")[0].as_py())
        lows, highs = anchors.column("lows").to_pylist(), anchors.column("highs").to_pylist()
        windows = max(map(len, lows))
        low, high = np.ones((len(lows), windows), np.int64), np.zeros((len(lows), windows), np.int64)
        for r, (x, y) in enumerate(zip(lows, highs)):
            low[r, :len(x)], high[r, :len(y)] = x, y
        best, _ = tree.search(_rows(anchors), anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy(), same, k, low, high)
        row, window, place = np.nonzero(best != NOTHING)
        keys = best[row, window, place]
        return pa.table({"number": anchors.column("number").to_numpy()[row], "window": window.astype(np.int32),
                         "found_id": tree.rows_of(keys), "score": keys >> PLACE_BITS})

    block = F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int").alias("block")
    # every block of the stated queries meets every shard of its vectors' length
    places = index.select(F.col("dim").alias("of"), F.col("shard").alias("at"))
    dealt = queries.withColumn("block", block).join(places, F.col("dim") == F.col("of")).withColumnRenamed("at", "shard").drop("of")
    shards = index.select(*[F.col(c).alias(c) for c in ("dim", "shard", "tree")],
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    return dealt.groupBy("dim", "shard", "block").cogroup(shards.groupBy("dim", "shard", "block")).applyInArrow(
        run, "number bigint, window int, found_id bigint, score bigint")


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("found_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(table: DataFrame, vector: str = "embedding", every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for table(vec_id, label, vector).

    Anchors are rows whose vec_id is divisible by ``every``; their first ``positives`` other rows of the same label (by
    inner product of floor(256 x), then smaller vec_id) are positives, and for each of those the first ``negatives`` rows of another label with
    low * positive_score <= 100 * score <= high * positive_score are returned. Labels of rows with vec_id divisible by 7
    become (label + 1) % 10 first.

    Rows with a null id, label or vector, an empty vector, or a component that is null, not finite, or not finite times 256
    take no part. Vectors of different lengths have no product and are not compared. A row's own id is never among its others;
    repeated rows are rows of their own. Scores beyond 41 bits count as that much. Other columns are ignored; an
    empty table gives an empty one.
    """
    if shard_rows > 1 << (PLACE_BITS - 2):
        raise ValueError("a shard's rows must fit their places' bits")
    rows = materialize(quantised(table, vector), "negatives_rows")
    n = rows.count()
    index = materialize(trees(rows, max(1, -(-n // shard_rows))), "negatives_trees")
    anchors = materialize(rows.where(F.col("vec_id") % every == 0).withColumn("number", F.monotonically_increasing_id()),
                          "negatives_anchors")
    blocks = max(1, -(-anchors.count() // block_rows))
    limit = (1 << (62 - PLACE_BITS)) - 1
    asked = anchors.withColumns({"lows": F.array(F.lit(-limit).cast("bigint")), "highs": F.array(F.lit(limit).cast("bigint"))})
    kept = _first(_search(asked, index, blocks, True, positives), positives, "number")
    kept = materialize(kept.select("number", (F.col("rank") - 1).alias("window"), F.col("found_id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), "negatives_positives")
    # low * p <= 100 * s <= high * p for integer s
    least = -F.floor(F.col("positive_score") * -low / F.lit(100).cast("decimal(3,0)"))
    most = F.floor(F.col("positive_score") * high / F.lit(100).cast("decimal(3,0)"))
    windows = kept.select("number", "window", least.cast("bigint").alias("least"), most.cast("bigint").alias("most"))
    windows = windows.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("window", "least", "most"))).alias("w"))
    asked = anchors.join(windows, "number").select("number", "vec_id", "label", "dim", "q", F.col("w.least").alias("lows"),
                                                   F.col("w.most").alias("highs"))
    found = _first(_search(asked, index, blocks, False, negatives), negatives, "number", "window")
    return (found.join(kept, ["number", "window"]).join(anchors.select("number", F.col("vec_id").alias("anchor_id")), "number")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
