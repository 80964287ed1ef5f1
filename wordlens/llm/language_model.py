"""Language-model scoring of whole texts by a trigram model of the whole corpus, in shards of an Elias-Fano trie.

Counts cover all training documents. Texts are read in chunks; a chunk's distinct bigrams and trigrams, as (context, word)
pairs of hashes, go to the shard of their context, sorted and packed, so an n-gram costs some bytes a chunk however often it
stands there.

1. ``common_words``: the tokens' number, and words that are a large share of them. Contexts of such words alone have too many
   successors for one shard, and are dealt out by successor.
2. ``packed_grams``: every chunk's pairs with training counts, by level and shard.
3. ``answers``: a shard sums the counts, keeps every n-gram that stands ``LEAST`` times (at any size), smooths by interpolated
   absolute discounting, builds its part of the trie's level, and looks up the pairs of each chunk in it. Answers are 8-bit numbers in
   the order of the chunk's pairs.
4. ``score_texts``: each chunk's texts meet its answers; probabilities of its distinct pairs are put together and summed by text.

Smoothing needs a context's own counts only, so no n-grams are joined with one another: p(w | u v) = q3 + g(u v) p(w | v) and
p(w | v) = q2 + g(v) p(w), with q the discounted share of a kept n-gram and g what the discounts leave. For contexts that were dealt
out, the sums of counts and discounts come as a table of (common word, or pair of common words), which their share bounds.

Contexts are known by 39-bit hashes and words within one by 24 bits, so about one n-gram in 10^5 meets another's numbers at
0.1 GB, and one context in 300 at 30 GB. Word counts (base_score) go by the contexts' hashes too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.arrays import mix, words
from wordlens.llm.ngram_trie import CONTEXT_BITS, WORD_BITS, Level, codebook
from wordlens.llm.worker import receive, send
from wordlens.session import materialize

FOLDS, HELD_OUT = 7, 2
LEAST, DISCOUNT = 2, 0.75
#: Bytes of text in a chunk, tokens of a shard, and the share of all tokens from which a word is common.
CHUNK_BYTES, SHARD_TOKENS, COMMON_SHARE = 5 << 20, 1_000_000, 1e-3
#: Bits of a probability.
BITS = 8
#: Stand for the end and the start of a text among word hashes.
END_HASH, START_HASH = np.uint64(0x9D39247E33776D41), np.uint64(0x2545F4914F6CDD1D)
#: Marks a context that is dealt out by successor.
DEALT = np.uint64(1 << (CONTEXT_BITS - 1))


def is_held_out(doc_id) -> bool:
    """By crc32 of the id as text; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


# --------------------------------------------------------------------------- packed integers

def pack(values: np.ndarray) -> bytes:
    """Integers as compressed planes of their bytes."""
    size = values.dtype.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), size).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else bytes(8)


def unpack(data: bytes, kind) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


# --------------------------------------------------------------------------- chunks of texts

def _context_id(hashes: np.ndarray, dealt: np.ndarray) -> np.ndarray:
    return (mix(hashes) & (DEALT - np.uint64(1))) | np.where(dealt, DEALT, np.uint64(0))


def _word_bits(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - WORD_BITS)


@dataclass
class Pairs:
    """The distinct (context, word) pairs of a level in a chunk, ascending; which of them each event is; their shards."""

    pairs: np.ndarray
    event: np.ndarray
    shard: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, context: np.ndarray, word: np.ndarray, shards: int) -> Pairs:
        pairs, event = np.unique((context << np.uint64(WORD_BITS)) | word, return_inverse=True)
        own = pairs >> np.uint64(WORD_BITS)
        spread = np.where(own & DEALT > 0, pairs, own)  # a dealt context's pairs go by themselves
        shard = (mix(spread * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)).astype(np.int64)
        return cls(pairs, event, shard, np.argsort(shard, kind="stable"))

    def by_shard(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each shard and the places of its pairs, ascending."""
        own = self.shard[self.order]
        cuts = np.flatnonzero(np.diff(own)) + 1
        for part in np.split(self.order, cuts):
            if len(part):
                yield int(self.shard[part[0]]), part


def _split(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, the context of each pair by place, words) of ascending pairs."""
    contexts, parent = np.unique(pairs >> np.uint64(WORD_BITS), return_inverse=True)
    return contexts.astype(np.int64), parent, (pairs & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)


class Chunk:
    """Texts as one sequence of word hashes, each text with START before and END after it, and its pairs of both levels."""

    def __init__(self, texts: pa.Array, common: np.ndarray, shards: int):
        hashes, rows, done = [], [], 0
        for w in words(texts, lower=True):
            seq = np.full(len(w.starts) + 2 * w.n_rows, END_HASH)
            seq[np.arange(len(w.starts)) + 2 * w.row() + 1] = w.hashes()
            seq[w.first[:-1] + 2 * np.arange(w.n_rows)] = START_HASH
            hashes.append(seq)
            rows.append(np.repeat(np.arange(w.n_rows) + done, w.counts() + 2))
            done += w.n_rows
        self.n = done
        self.seq = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.row = np.concatenate(rows) if rows else np.empty(0, np.int64)
        frequent = np.isin(self.seq, common)
        self.two = np.flatnonzero(self.row[1:] == self.row[:-1]) + 1
        self.three = np.flatnonzero(self.row[2:] == self.row[:-2]) + 2
        before, word = self.seq[self.two - 1], _word_bits(self.seq)
        self.context2 = _context_id(before, frequent[self.two - 1])
        u, v = self.seq[self.three - 2], self.seq[self.three - 1]
        self.context3 = _context_id(mix(u * np.uint64(0xD6E8FEB86659FD93)) + v, frequent[self.three - 2] & frequent[self.three - 1])
        self.levels = [Pairs.of(self.context2, word[self.two], shards), Pairs.of(self.context3, word[self.three], shards)]

    def events(self, level: int) -> np.ndarray:
        """Places in the sequence of a level's events."""
        return self.two if level == 0 else self.three


def chunked(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[int, pa.Array, pa.Array]]:
    """(chunk, doc ids, texts) of runs of rows of about chunk_bytes of text; the same rows give the same chunks in any pass."""
    from pyspark import TaskContext

    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    ids, texts, held = [], [], 0
    for batch in batches:
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0)).astype(np.int64))
        at, before = 0, 0
        while at < batch.num_rows:
            to = min(int(np.searchsorted(sizes, before + chunk_bytes - held)) + 1, batch.num_rows)
            ids.append(batch.column("doc_id").slice(at, to - at))
            texts.append(batch.column("text").slice(at, to - at))
            held += int(sizes[to - 1]) - before
            at, before = to, int(sizes[to - 1])
            if held >= chunk_bytes:
                yield number, pa.concat_arrays(ids), pa.concat_arrays(texts)
                number, ids, texts, held = number + 1, [], [], 0
    if ids:
        yield number, pa.concat_arrays(ids), pa.concat_arrays(texts)


def _fingerprint(ids: pa.Array, texts: pa.Array) -> int:
    """Tells apart the rows of chunks, should a second reading not give the same ones."""
    total = pc.sum(pc.fill_null(pc.binary_length(texts), 0)).as_py() or 0
    ends = "".join(str(x) for x in (len(ids), total, *ids.slice(0, 5).to_pylist(), *ids.slice(max(len(ids) - 5, 0)).to_pylist()))
    return zlib.crc32(ends.encode())


# --------------------------------------------------------------------------- passes over the corpus

def common_words(docs: DataFrame, share: float = COMMON_SHARE, chunk_bytes: int = CHUNK_BYTES) -> tuple[int, int, np.ndarray]:
    """(training tokens, training texts, hashes of common words, START among them).

    A chunk lists the words that are ``share`` of its own tokens, so a word with that share of all is listed somewhere; those whose
    listed counts come to a quarter of it are taken, 4 / share at most. The list only decides where pairs are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, texts in chunked(batches, chunk_bytes):
            train = pa.array([not is_held_out(d) for d in ids.to_pylist()], pa.bool_())
            found = [w.hashes() for w in words(texts.filter(train), lower=True)]
            known, n = np.unique(np.concatenate([*found, np.empty(0, np.uint64)]), return_counts=True)
            n_texts = pc.sum(train).as_py() or 0
            often = n >= share * max(n.sum(), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *known[often].view(np.int64).tolist()], pa.int64()), pa.array([int(n.sum()) + n_texts, *n[often].tolist()], pa.int64()),
                 pa.array([n_texts] + [0] * int(often.sum()), pa.int64())], ["word", "n", "texts"])

    listed = docs.mapInArrow(run, "word bigint, n bigint, texts bigint").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    listed = materialize(listed, "lm_common")
    total = listed.where("word is null").first()
    tokens, n_texts = (int(total.n), int(total.texts)) if total else (0, 0)
    found = listed.where(F.col("word").isNotNull() & (F.col("n") >= share / 4 * tokens)).select("word").toArrow().column("word").to_numpy()
    return tokens, n_texts, np.append(found.astype(np.int64).view(np.uint64), START_HASH)


def packed_grams(docs: DataFrame, common, shards: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(level, shard, chunk, print, pairs, counts): each chunk's distinct pairs, as differences, and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, texts in chunked(batches, chunk_bytes):
            chunk, seal = Chunk(texts, common.value, shards), _fingerprint(ids, texts)
            train = np.array([not is_held_out(d) for d in ids.to_pylist()], float)
            rows: list[tuple] = []
            for level, own in enumerate(chunk.levels):
                counts = np.bincount(own.event, train[chunk.row[chunk.events(level)]], len(own.pairs)).astype(np.uint32)
                rows += [(level, shard, number, seal, pack(np.diff(own.pairs[part], prepend=np.uint64(0))), pack(counts[part]))
                         for shard, part in own.by_shard()]
            if rows:
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)],
                                                 ["level", "shard", "chunk", "print", "pairs", "counts"])

    return docs.mapInArrow(run, "level int, shard int, chunk bigint, print bigint, pairs binary, counts binary")


def build_level(pairs: np.ndarray, counts: np.ndarray, scale: float, least: int, bits: int = BITS) -> tuple[Level, np.ndarray, np.ndarray, np.ndarray]:
    """The trie's level for a shard's distinct pairs and their counts, and (contexts, totals, discounts) of its dealt contexts.

    Contexts are in it from ``least`` occurrences on. Probabilities of a dealt context's successors are shares of ``scale``,
    as its own total is not known here.
    """
    contexts, parent, word = _split(pairs)
    totals = np.bincount(parent, counts, len(contexts)).astype(np.int64)
    kept = counts >= LEAST
    taken = np.bincount(parent[kept], counts[kept] - DISCOUNT, len(contexts))
    dealt = contexts & int(DEALT) > 0
    some, there = totals >= least, dealt & (totals > 0)
    place = np.cumsum(some) - 1
    of = np.where(dealt, scale, np.maximum(totals, 1))
    backoff = (totals - taken) / np.maximum(totals, 1)
    level = Level.build(contexts[some], totals[some], backoff[some], place[parent[kept]], word[kept],
                        (counts[kept] - DISCOUNT) / of[parent[kept]], bits)
    return level, contexts[there], totals[there], taken[there]


ANSWERS = ("level int, shard int, chunk bigint, print bigint, totals binary, backoff binary, prob binary, contexts array<bigint>, "
           "sums array<bigint>, taken array<double>, words bigint")


def answers(packed: DataFrame, scale: float, bits: int = BITS) -> DataFrame:
    """A row (level, shard, chunk, ...) for each packed row, with what the shard's level of the trie knows of its pairs; and one a
    shard (chunk null) with its dealt contexts' sums and how many other contexts training has."""

    def run(table: pa.Table) -> pa.Table:
        level, shard = (table.column(c)[0].as_py() for c in ("level", "shard"))
        lists = [np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in table.column("pairs").to_pylist()]
        pairs, place = np.unique(np.concatenate(lists), return_inverse=True)
        counts = np.bincount(place, np.concatenate([unpack(x, np.uint32) for x in table.column("counts").to_pylist()])).astype(np.int64)
        # words count from one occurrence on, pairs as contexts from those that are in the model
        built, contexts, sums, taken = build_level(pairs, counts, scale, LEAST if level else 1, bits)
        trie = Level.mapped(built.to_bytes())
        out: list[list] = [[], [], []]
        for own in lists:
            asked, parent, word = _split(own)
            total, backoff, prob = trie.search(asked, parent, word)
            for x, y in zip(out, (pack(total[:0 if level else None].astype(np.uint32)), pack(backoff), pack(prob))):
                x.append(y)
        n = len(lists)
        column = lambda x, kind: pa.array([*x, None], kind)
        nothing = [None] * n
        return pa.table({
            "level": pa.array([level] * (n + 1), pa.int32()), "shard": pa.array([shard] * (n + 1), pa.int32()),
            "chunk": column(table.column("chunk").to_pylist(), pa.int64()), "print": column(table.column("print").to_pylist(), pa.int64()),
            "totals": column(out[0], pa.binary()), "backoff": column(out[1], pa.binary()), "prob": column(out[2], pa.binary()),
            "contexts": pa.array([*nothing, contexts.tolist()], pa.list_(pa.int64())), "sums": pa.array([*nothing, sums.tolist()], pa.list_(pa.int64())),
            "taken": pa.array([*nothing, taken.tolist()], pa.list_(pa.float64())),
            "words": pa.array([*nothing, built.contexts.n - len(contexts)], pa.int64())})

    return packed.groupBy("level", "shard").applyInArrow(run, ANSWERS)


@dataclass
class Model:
    """Numbers that all chunks need: totals of training, and the sums of dealt contexts by level (ascending contexts)."""

    tokens: int
    types: int
    texts: int
    scale: float
    dealt: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    bits: int = BITS

    @classmethod
    def of(cls, found: DataFrame, tokens: int, n_texts: int, scale: float, bits: int) -> Model:
        per_shard = found.where("chunk is null")
        sums = per_shard.select("level", F.inline(F.arrays_zip("contexts", "sums", "taken"))).groupBy("level", "contexts").agg(
            F.sum("sums").alias("sums"), F.sum("taken").alias("taken")).toArrow()
        dealt = []
        for level in range(2):
            own = sums.filter(pc.equal(sums.column("level"), level))
            order = np.argsort(own.column("contexts").to_numpy())
            dealt.append(tuple(own.column(c).to_numpy()[order] for c in ("contexts", "sums", "taken")))
        words = per_shard.where("level = 0").agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
        # a common word is one dealt context, START is no word, END is one and no context
        types = int(words) + len(dealt[0][0]) - (n_texts > 0) + (n_texts > 0)
        return cls(tokens, types, n_texts, scale, dealt, bits)

    def sums(self, level: int, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(is dealt, total, discounts) of contexts."""
        known, sums, taken = self.dealt[level]
        at = np.minimum(np.searchsorted(known, contexts), max(len(known) - 1, 0))
        hit = (known[at] == contexts) if len(known) else np.zeros(len(contexts), bool)
        pick = lambda x: np.where(hit, x[at], 0) if len(known) else np.zeros(len(contexts))
        return hit, pick(sums), pick(taken)


def score_chunk(chunk: Chunk, model: Model, answered: dict[tuple[int, int], tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, ...]:
    """(tokens, known tokens, base score, score) of each text of a chunk, from the answers by (level, shard)."""
    kind, book = (np.uint8 if model.bits == 8 else np.uint16), codebook(model.bits)
    pair_of, parent_of, total_of, back_of = [], [], [], []
    for level, own in enumerate(chunk.levels):
        contexts, parent, _ = _split(own.pairs)
        total, back, prob = np.zeros(len(contexts)), np.zeros(len(contexts)), np.zeros(len(own.pairs))
        for shard, part in own.by_shard():
            totals, backoff, probs = answered[level, shard]
            asked = np.unique(parent[part])
            back[asked] = book[unpack(backoff, kind)]
            if not level:
                total[asked] = unpack(totals, np.uint32)
            prob[part] = book[unpack(probs, kind)]
        hit, sums, taken = model.sums(level, contexts)
        least = 1 if not level else LEAST
        total[hit] = sums[hit]
        back[hit] = np.where(sums[hit] >= least, (sums[hit] - taken[hit]) / np.maximum(sums[hit], 1), 0.0)
        scaled = hit[parent]
        prob[scaled] *= model.scale / np.maximum(sums[parent[scaled]], 1)
        pair_of.append(prob[own.event])
        parent_of.append(parent[own.event])
        total_of.append(total)
        back_of.append(back)
    # counts of tokens: a word's is its total as a context, which it is wherever it stands; an end's is the texts'
    now = chunk.two
    count = np.full(len(chunk.seq), float(model.texts))
    count[now - 1] = total_of[0][parent_of[0]]
    c, denominator = count[now], model.tokens + model.types + 1.0
    p1 = (c + 1.0) / denominator
    of = parent_of[0]
    p2 = pair_of[0] + np.where(total_of[0][of] > 0, back_of[0][of], 1.0) * p1
    p = np.zeros(len(chunk.seq))
    p[now] = p2
    g3 = back_of[1][parent_of[1]]
    p[chunk.three] = np.where(g3 > 0, pair_of[1] + g3 * p[chunk.three], p[chunk.three])
    row = chunk.row[now]
    sums = lambda x: np.bincount(row, x, chunk.n)
    return (np.bincount(row, minlength=chunk.n).astype(np.int64), sums(c > 0).astype(np.int64), sums(np.log10(p1)),
            sums(np.log10(np.minimum(p[now], 1.0))))


def score_texts(docs: DataFrame, shard_tokens: int = SHARD_TOKENS, chunk_bytes: int = CHUNK_BYTES,
                common_share: float = COMMON_SHARE, bits: int = BITS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs(doc_id, text).

    Tokens are the words (maximal runs of non-white-space, A-Z lower-cased) and one end. base_score
    sums log10((c + 1) / (N + V + 1)) over them; score is the trie's log10 probability of the text, with probabilities of ``bits``
    (8 or 16) each. A null text is empty (its end is its one token); a null doc_id counts as the empty text in
    the fold rule. Repeated rows count as often as they stand and give repeated rows; other
    columns are ignored. An empty table gives an empty one; without training rows N = V = 0.

    docs is read three times and must give the same rows in the same partitions each time, as files do; a chunk that
    comes out otherwise raises.
    """
    kind = dict(docs.dtypes)["doc_id"]
    own = docs.select("doc_id", "text")
    tokens, n_texts, common = common_words(own, common_share, chunk_bytes)
    shards, scale = tokens // shard_tokens + 1, float(max(tokens, 1))
    shared = docs.sparkSession.sparkContext.broadcast(common)
    found = materialize(answers(packed_grams(own, shared, shards, chunk_bytes), scale, bits), "lm_answers")
    model = send(docs.sparkSession, Model.of(found, tokens, n_texts, scale, bits))

    def stow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, texts in chunked(batches, chunk_bytes):
            held = pa.BufferOutputStream()
            batch = pa.RecordBatch.from_arrays([ids, texts], ["doc_id", "text"])
            with pa.ipc.new_stream(held, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([_fingerprint(ids, texts)]), pa.array([held.getvalue().to_pybytes()])],
                                             ["chunk", "print", "rows"])

    def score(stowed: pa.Table, answered: pa.Table) -> pa.Table:
        parts = []
        for rows, seal in zip(stowed.column("rows").to_pylist(), stowed.column("print").to_pylist()):
            batch = pa.ipc.open_stream(rows).read_all().combine_chunks()
            if set(answered.column("print").to_pylist()) != {seal}:
                raise RuntimeError("docs gave other rows when it was read again; write it to a table first")
            by = {(x["level"], x["shard"]): (x["totals"], x["backoff"], x["prob"]) for x in
                  answered.select(["level", "shard", "totals", "backoff", "prob"]).to_pylist()}
            ids = batch.column("doc_id")
            texts = batch.column("text").combine_chunks()
            n, known, base, whole = score_chunk(Chunk(texts, shared.value, shards), receive(model), by)
            parts.append(pa.table({"doc_id": ids, "held_out": pa.array([is_held_out(d) for d in ids.to_pylist()], pa.bool_()), "n_tokens": n,
                                   "n_known": known, "train_tokens": np.full(len(n), tokens), "base_score": base, "score": whole}))
        return pa.concat_tables(parts)

    texts = own.mapInArrow(stow, "chunk bigint, print bigint, rows binary").groupBy("chunk")
    return texts.cogroup(found.where("chunk is not null").groupBy("chunk")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
