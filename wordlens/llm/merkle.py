"""Merkle fingerprints of documents: pieces, paragraphs, sections, root.

A text is cut into pieces: after every line feed, and before each word whose hash is a multiple of
``PIECE`` (so cuts depend on content and an edit moves no other cut). A paragraph is the
pieces up to a line feed; a section ends after a blank paragraph or one whose digest is a multiple
of ``SECTION``. Each level's digest is a hash of its children's. The fingerprint is the tree as text:

    <root, 16 hex digits>|<section, 8 digits>:<paragraph>;<paragraph>/<section>:...

A paragraph is its pieces, joined by commas, each 8 hex digits of its digest and then its length in code
points. Equal roots mean equal texts; where roots differ, ``differing`` compares section by section
and names the paragraphs in which the texts differ. The likeness of two fingerprints is
the share of code points in pieces that both have (with multiplicity), 2 * common / (a + b).
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.arrays import _byte_powers, mix, raw, span_hashes, words
from wordlens.session import scratch_path

PIECE, SECTION = 16, 8


def _grouped(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs of values that end before each place of ends."""
    return span_hashes(values, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64))


def trees(column: pa.Array) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(fingerprint, piece digests, piece lengths in code points) of each text of a string column."""
    out: list[tuple[str, np.ndarray, np.ndarray]] = []
    for w in words(column):
        data = w.data
        edge = np.zeros(len(data) + 1, bool)
        edge[np.flatnonzero(data == 10) + 1] = True
        edge[w.starts[w.hashes() % np.uint64(PIECE) == 0]] = True
        size = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=size[1:])  # code points: bytes that continue none
        up, down = _byte_powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        bounds = _row_bounds(column, w)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if a == b:
                out.append(("0" * 16 + "|", np.empty(0, np.uint64), np.empty(0, np.int64)))
                continue
            cuts = np.concatenate([[a], np.flatnonzero(edge[a + 1:b]) + a + 1, [b]])
            start, end = cuts[:-1], cuts[1:]
            piece = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
            points = size[end] - size[start]
            last = data[end - 1] == 10
            last[-1] = True
            ends = np.flatnonzero(last) + 1
            paragraph = _grouped(piece, ends)
            begins = np.concatenate([[0], ends[:-1]])
            blank = (end[ends - 1] - start[begins] == 1) & (data[end[ends - 1] - 1] == 10)
            closes = blank | (paragraph % np.uint64(SECTION) == 0)
            closes[-1] = True
            section_ends = np.flatnonzero(closes) + 1
            section = _grouped(paragraph, section_ends)
            root = int(_grouped(section, np.array([len(section)]))[0])
            texts = [f"{h & 0xFFFFFFFF:08x}{n}" for h, n in zip(piece.tolist(), points.tolist())]
            paragraphs = [",".join(texts[i:j]) for i, j in zip(begins.tolist(), ends.tolist())]
            sections, at = [], 0
            for digest, to in zip(section.tolist(), section_ends.tolist()):
                sections.append(f"{digest & 0xFFFFFFFF:08x}:" + ";".join(paragraphs[at:to]))
                at = to
            out.append((f"{root:016x}|" + "/".join(sections), piece & np.uint64(0xFFFFFFFF), points))
    return out


def _row_bounds(column: pa.Array, w) -> np.ndarray:
    offsets, _ = raw(column.slice(w.first_row, w.n_rows))
    return offsets - offsets[0]


def likeness(a: tuple, b: tuple) -> float:
    """Of two trees: 1 if the roots are equal, else the share of code points in common pieces."""
    if a[0][:16] == b[0][:16]:
        return 1.0
    whole = int(a[2].sum() + b[2].sum())
    left = Counter(a[1].tolist())
    size = dict(zip(a[1].tolist(), a[2].tolist()))
    common = 0
    for h, n in zip(b[1].tolist(), b[2].tolist()):
        if left.get(h, 0) > 0 and size[h] == n:
            left[h] -= 1
            common += n
    return 2 * common / whole


def parse(fingerprint: str) -> list[tuple[str, list[str]]]:
    """(section digest, paragraphs) of a fingerprint."""
    body = fingerprint.partition("|")[2]
    return [(s[:8], s[9:].split(";")) for s in body.split("/")] if body else []


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) places in fingerprint b of paragraphs that its section's counterpart
    in a does not have: none if the roots are equal; only differing sections are opened."""
    if a[:16] == b[:16]:
        return []
    known = Counter(s for s, _ in parse(a))
    rest = Counter(p for s, ps in parse(a) for p in ps)
    out, opened = [], []
    for i, (digest, paragraphs) in enumerate(parse(b)):
        if known[digest] > 0:
            known[digest] -= 1
            rest.subtract(paragraphs)
        else:
            opened.append((i, paragraphs))
    for i, paragraphs in opened:
        for j, p in enumerate(paragraphs):
            if rest[p] > 0:
                rest[p] -= 1
            else:
                out.append((i, j))
    return out


def _compare(ids: list, texts: list[str], own: list, following: list[str], following_trees: list, kind: pa.DataType) -> pa.RecordBatch:
    """Result rows of texts and the documents that follow them."""
    edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for t, n in zip(texts, following)]
    other = trees(pa.array(edited, pa.large_string()))
    return pa.RecordBatch.from_arrays([
        pa.array(ids, kind), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
        pa.array([t[0] for t in own]), pa.array([t[0] for t in other]),
        pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, following_trees)], pa.float64())],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


RESULT = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
#: Documents that are compared at once, in bytes of text.
GROUP_BYTES = 1 << 21


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a sorted partition; its first and its last document go out as they are (role 1
    and 2), as the documents beside them are in other partitions."""
    partition = TaskContext.get().partitionId()
    waiting: list[tuple] = []  # one document: (id, text, tree)
    names, kind = None, None

    def edge(role: int, doc: tuple) -> pa.RecordBatch:
        fixed = [pa.array([role], pa.int32()), pa.array([partition], pa.int32()), pa.array([doc[1]], pa.string())]
        empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array([doc[0]], kind), *empty, *fixed], names)

    for batch in batches:
        kind = batch.column("doc_id").type
        text = batch.column("text").fill_null("")
        at = 0
        sizes = raw(text)[0]
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + GROUP_BYTES, "right")) - 1)
            part = text.slice(at, to - at)
            docs = waiting + list(zip(batch.column("doc_id").slice(at, to - at).to_pylist(), part.to_pylist(), trees(part)))
            at = to
            if names is None:
                names = ["doc_id", *[c.split()[0] for c in RESULT.split(", ")], "role", "partition", "text"]
                yield edge(1, docs[0])
            if len(docs) > 1:
                ids, texts, own = (list(x) for x in zip(*docs))
                found = _compare(ids[:-1], texts[:-1], own[:-1], texts[1:], own[1:], kind)
                n = found.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*found.columns, pa.array([0] * n, pa.int32()), pa.array([partition] * n, pa.int32()),
                     pa.nulls(n, pa.string())], names)
            waiting = docs[-1:]
    if waiting:
        yield edge(2, waiting[0])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            one = batch.slice(at, 1)
            text, following = one.column("text").fill_null(""), one.column("following").fill_null("")
            yield _compare(one.column("doc_id").to_pylist(), text.to_pylist(), trees(text), following.to_pylist(),
                           trees(following), one.column("doc_id").type)


def edited_likeness(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of
    docs(doc_id, text).

    The edited text is the text whose last floor(n_chars / 2) code points are replaced by the first as many
    (or all) of the next document's, in ascending doc_id; after the last comes the first (a document alone
    follows itself). Null doc_ids come after all others; rows of one doc_id follow one another by a
    hash of the text. A null text is empty. Empty texts are alike (likeness 1). Other columns are ignored;
    an empty table gives an empty one.

    One shuffle deals the texts out by ranges of doc_id. The documents at a range's edges meet
    in a second, small join; the driver sees the numbers of the ranges that have rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    spark = docs.sparkSession
    keys = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = scratch_path(spark, "merkle")
    # fingerprints are hexadecimal digits, which this codec halves
    dealt.mapInArrow(_in_order, f"doc_id {kind}, {RESULT}, role int, partition int, text string").write.option(
        "compression", "zstd").parquet(path)
    found = spark.read.parquet(path)
    heads = found.where("role = 1").select(F.col("partition").alias("next"), F.col("text").alias("following"))
    tails = found.where("role = 2").select("doc_id", "partition", "text")
    full = sorted(r.partition for r in found.where("role = 1").select("partition").collect())
    turn = spark.createDataFrame(list(zip(full, full[1:] + full[:1])), "partition int, next int")
    at_edges = (tails.join(F.broadcast(turn), "partition").join(heads, "next").select("doc_id", "text", "following")
                .mapInArrow(_edges, f"doc_id {kind}, {RESULT}"))
    return found.where("role = 0").drop("role", "partition", "text").unionByName(at_edges)
