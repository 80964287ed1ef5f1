"""Cross-tokenizer alignment: which tokens of two tokenizers overlap, in every text and over the corpus.

A chunk holds the tokens of both sides of some documents, each with its document and its first byte. ``pandas.merge_asof``,
keyed by document, finds for every token start the other side's token that covers it; the union of both directions is
all overlapping pairs (a pair's overlap begins where one of the two begins, so equal starts are found twice and kept
once). Places where tokens of both sides end cut the tokens into groups.

An id pair's count needs the whole corpus. Chunks list their distinct pairs, which Spark sums; each chunk gets the sums of
its own pairs back and adds them up by document. So one row for each pair and chunk is shuffled, however often the pair
occurs, and no table of pairs is broadcast.

Tokens come from a store of segments (a word with the white space before it), encoded once each. A segment ends only where no
token of either side can cross: before a space, or a line feed, that follows a character that is not white space.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.worker import kept
from wordlens.session import materialize

#: Bytes of text that are aligned at once, and segments and tokens that a worker's store holds at most.
CHUNK_BYTES, KNOWN_SEGMENTS, KNOWN_TOKENS = 1 << 20, 600_000, 8_000_000
#: New segments that are encoded as one text.
RUN = 1_000
#: A place before a space and after a character that is no white space.
BREAK = re.compile(r"(?<=\S)(?= )")
#: White space that str.split(" ") with line feeds marked does not cut as BREAK does.
ODD = re.compile(r"[^\S \n]|\s[ \n]|^[ \n]|[ \n]$")


def regular(text: str) -> bool:
    """Whether all white space in the text is single spaces and line feeds, each between two other characters."""
    if not text.replace("\n", "").isprintable():  # then it may hold white space of other kinds
        return not ODD.search(text)
    pairs = ("  ", "\n\n", " \n", "\n ")
    return text[0] not in " \n" and text[-1] not in " \n" and not any(x in text for x in pairs)


def byte_level_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the 256 bytes: printable Latin-1 stands for itself, the
    other bytes take the characters from U+0100 on, in turn."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class _Numbers(dict):
    """Numbers of segments in turn of their first look-up; ``new`` lists those not encoded yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, segment: str) -> int:
        number = self[segment] = len(self)
        self.new.append(segment)
        return number


class Segments:
    """Token ids of both sides by segment, as flat arrays; cleared when full."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        alphabet = byte_level_alphabet()
        n = max(self.a.get_vocab().values()) + 1
        names = [self.a.id_to_token(i) or "" for i in range(n)]
        self.a_bytes = [bytes(alphabet[c] for c in x) if all(c in alphabet for c in x) else x.encode() for x in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.space = self.b.piece_to_id("▁")
        # no piece goes on with a space after another character, or holds a line feed: then such places part segments
        self.parted = not any("▁" in p.lstrip("▁") for p in pieces)
        self.lines = self.parted and not any("\n" in p for p in pieces)
        self.clear()

    def clear(self) -> None:
        self.known = _Numbers()
        self.a_ids, self.b_ids, self.a_end, self.b_end = array("i"), array("i"), array("q", [0]), array("q", [0])
        self.size, self.right = array("q"), array("b")  # bytes; 1 where the tokens' bytes are the segment's

    def full(self) -> bool:
        return len(self.known) > KNOWN_SEGMENTS or len(self.a_ids) + len(self.b_ids) > KNOWN_TOKENS

    def parts(self, text: str) -> list[str]:
        """Segments of space + text. A word after a single space is given without it, all others whole."""
        if self.lines and regular(text):
            return text.replace("\n", " \n").split(" ")
        return BREAK.split(" " + text) if self.parted else [" " + text]

    def add(self) -> None:
        """Encode the segments that are new: some at once as one text, in which they are parted as in any other, or one by one."""
        new, self.known.new = self.known.new, []
        for at in range(0, len(new), RUN):
            whole = [x if x[0] in " \n" else " " + x for x in new[at:at + RUN]]
            raw = [x.encode() for x in whole]
            size = np.fromiter(map(len, raw), np.int64, len(raw))
            a, b, right = self._at_once(whole, b"".join(raw), np.cumsum(size)) or self._one_by_one(whole, raw)
            self.size.frombytes(size.tobytes())
            self.right.frombytes(right.astype(np.int8).tobytes())
            for (own, counts), ids, end in ((a, self.a_ids, self.a_end), (b, self.b_ids, self.b_end)):
                end.frombytes((len(ids) + np.cumsum(counts)).tobytes())
                ids.extend(own)

    def _at_once(self, whole: list[str], raw: bytes, ends: np.ndarray):
        if not self.parted or any(x[-1].isspace() for x in whole):
            return None
        text = "".join(whole)
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text)[1:] if text[0] == "\n" else self.b.encode(text[1:])
        out = []
        for ids, names, lengths in ((a, self.a_bytes, self.a_length), (b, self.b_bytes, self.b_length)):
            stops = np.cumsum(lengths[np.array(ids, np.int64)])
            at = np.searchsorted(stops, ends)
            if b"".join([names[i] for i in ids]) != raw or (stops[at] != ends).any():
                return None
            out.append((ids, np.diff(at + 1, prepend=0)))
        return *out, np.ones(len(whole), bool)

    def _one_by_one(self, whole: list[str], raw: list[bytes]):
        a = [e.ids for e in self.a.encode_batch(whole, add_special_tokens=False)]
        b = self.b.encode([x.removeprefix(" ") for x in whole], num_threads=1)
        for i, text in enumerate(whole):
            if text[0] == "\n":
                del b[i][0]  # the space that the encoder puts first
            elif text == " ":
                b[i] = [self.space]
        same = lambda ids, names: [b"".join([names[i] for i in own]) == x for own, x in zip(ids, raw)]
        right = np.array(same(a, self.a_bytes)) & np.array(same(b, self.b_bytes))
        return *[(list(chain.from_iterable(x)), [len(y) for y in x]) for x in (a, b)], right

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        """Each text's segments as numbers in the store; none for texts that are empty or whose tokens have other bytes."""
        parts = [self.parts(x) if x else [] for x in texts]
        if self.full():
            self.clear()
        flat = list(map(self.known.__getitem__, chain.from_iterable(parts)))
        if self.known.new:
            self.add()
        cuts = np.cumsum([len(x) for x in parts])[:-1]
        right = np.array(self.right, bool)
        return [x if right[x].all() else x[:0] for x in np.split(np.array(flat, np.int64), cuts)]

    def tokens(self, side: str, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, tokens of each segment) of a run of segments."""
        ids, end = (self.a_ids, self.a_end) if side == "a" else (self.b_ids, self.b_end)
        ends = np.frombuffer(end, np.int64)
        first, n = ends[numbers], ends[numbers + 1] - ends[numbers]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return (np.frombuffer(ids, np.int32)[at] if len(at) else at).astype(np.int64), n


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Pairs (doc, a, b) of overlapping tokens of a(doc, start, id) and b(doc, start, id), and which of a and b end together.

    Both are sorted by start, which counts bytes over all documents; each document's tokens cover the same bytes.
    """
    by_a = pd.merge_asof(a[["doc", "start"]], b, on="start", by="doc")
    by_b = pd.merge_asof(b[["doc", "start"]], a.assign(other=a["start"]), on="start", by="doc")
    apart = (by_b["other"] != by_b["start"]).to_numpy()  # a pair whose tokens begin together is in by_a
    links = pd.DataFrame({"doc": np.concatenate([a["doc"], b["doc"].to_numpy()[apart]]),
                          "a": np.concatenate([a["id"], by_b["id"].to_numpy()[apart]]),
                          "b": np.concatenate([by_a["id"], b["id"].to_numpy()[apart]])})

    def last(x: pd.DataFrame) -> np.ndarray:  # of a group: the next token of both sides begins together, or none follows
        other = b if x is a else a
        begins = np.isin(x["start"].to_numpy()[1:], other["start"].to_numpy(), assume_unique=True)
        return np.append(begins, True)[:len(x)]

    return links, last(a), last(b)


def _digits(most: int) -> np.ndarray:
    """Decimal digits of 0 to most, one row each, with zero bytes before them."""
    width = len(str(most))
    n = np.arange(most + 1)
    out = np.stack([n // 10 ** (width - 1 - i) % 10 for i in range(width)], axis=1).astype(np.uint8) + 48
    for i in range(width - 1):
        out[n < 10 ** (width - 1 - i), i] = 0
    return out


def group_strings(a: pd.DataFrame, b: pd.DataFrame, last_a: np.ndarray, last_b: np.ndarray, ends: np.ndarray,
                  digits: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3`` for all tokens in turn, and each token's document beside its length in bytes.
    ``ends`` marks tokens of b after which nothing follows in their document."""
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    n_groups = int(last_a.sum())
    a_before = np.concatenate([[0], np.cumsum(np.bincount(group_a, minlength=n_groups))])
    b_before = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n_groups))])
    place_a = np.arange(len(a)) + b_before[group_a]
    place_b = np.arange(len(b)) + a_before[group_b + 1]
    total = len(a) + len(b)
    ids, marks, docs = np.empty(total, np.int64), np.empty(total, np.uint8), np.empty(total, np.int64)
    ids[place_a], ids[place_b] = a["id"], b["id"]
    marks[place_a] = np.where(last_a, ord("|"), ord(","))
    marks[place_b] = np.where(ends, 0, np.where(last_b, ord(";"), ord(",")))
    docs[place_a], docs[place_b] = a["doc"], b["doc"]
    table = np.empty((total, digits.shape[1] + 1), np.uint8)
    np.take(digits, ids, axis=0, out=table[:, :-1], mode="clip")
    table[:, -1] = marks
    size = widths[ids] + (marks > 0)
    return table[table != 0], np.bincount(docs, weights=size).astype(np.int64)


SCHEMA = ("chunk bigint, row bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
          "groups_sha256 string, pairs array<bigint>, times array<int>")


class _Aligner:
    """Rows of one chunk after another. A text beyond a chunk's size is aligned in parts, its digest going on."""

    def __init__(self, store: Segments, partition: int, chunk_bytes: int):
        self.store, self.next_chunk, self.chunk_bytes = store, partition << 32, chunk_bytes
        self.digits = _digits(max(len(store.a_length), len(store.b_length)))
        self.widths = np.count_nonzero(self.digits, axis=1)
        self.open: dict[int, object] = {}  # digests of texts that go on

    def batch(self, rows: np.ndarray, texts: list[str | None], ids: pa.Array) -> Iterator[pa.RecordBatch]:
        numbers = self.store.numbers(texts)
        parts: list[tuple[int, np.ndarray, bool]] = []
        held = 0
        sizes = np.array(self.store.size, np.int64)
        for r, own in enumerate(numbers):
            size = np.cumsum(sizes[own]) if len(own) else np.zeros(1, np.int64)
            cuts = np.searchsorted(size, np.arange(self.chunk_bytes, size[-1] + 1, self.chunk_bytes))
            cuts = np.unique(np.concatenate([[0], cuts[cuts < len(own)], [len(own)]]))
            pieces = list(zip(cuts[:-1], cuts[1:])) or [(0, 0)]
            for k, (x, y) in enumerate(pieces):
                parts.append((r, own[x:y], k == len(pieces) - 1))
                held += int(size[y - 1] - (size[x - 1] if x else 0)) if y else 0
                if held >= self.chunk_bytes:
                    yield self.chunk(parts, rows, ids)
                    parts, held = [], 0
        if parts:
            yield self.chunk(parts, rows, ids)

    def chunk(self, parts: list, rows: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
        n = len(parts)
        numbers = np.concatenate([p[1] for p in parts])
        segment_doc = np.repeat(np.arange(n), [len(p[1]) for p in parts])
        sides = []
        for side, length in (("a", self.store.a_length), ("b", self.store.b_length)):
            token, per = self.store.tokens(side, numbers)
            size = length[token]
            sides.append(pd.DataFrame({"doc": np.repeat(segment_doc, per), "start": np.cumsum(size) - size, "id": token}))
        a, b = sides
        links, last_a, last_b = overlaps(a, b)
        count = lambda docs: np.bincount(docs, minlength=n).astype(np.int64)
        goes_on = np.array([not p[2] for p in parts])
        b_doc = b["doc"].to_numpy()
        final = np.append(b_doc[1:] != b_doc[:-1], True)[:len(b)] & ~goes_on[b_doc]
        text, size = group_strings(a, b, last_a, last_b, final, self.digits, self.widths)
        size = np.concatenate([size, np.zeros(n - len(size), np.int64)])
        at = np.concatenate([[0], np.cumsum(size)])
        digests = []
        view = memoryview(np.ascontiguousarray(text))
        for i, (r, _, ends) in enumerate(parts):
            row = int(rows[r])
            digest = self.open.pop(row, None) or hashlib.sha256()
            digest.update(view[at[i]:at[i + 1]])
            some = size[i] > 0 or digest.digest() != hashlib.sha256().digest()
            if not ends:
                self.open[row] = digest
            digests.append(digest.hexdigest() if ends and some else "")
        pair = links["a"].to_numpy(np.int64) * len(self.store.b_length) + links["b"].to_numpy(np.int64)
        code, distinct = pd.factorize(pair)
        key, times = np.unique(links["doc"].to_numpy() * max(len(distinct), 1) + code, return_counts=True)
        own_doc, own_code = key // max(len(distinct), 1), key % max(len(distinct), 1)
        offsets = np.concatenate([[0], np.cumsum(count(own_doc))]).astype(np.int32)
        lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(kind)))
        chunk, self.next_chunk = self.next_chunk, self.next_chunk + 1
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, chunk)), pa.array(rows[[p[0] for p in parts]]), ids.take(pa.array([p[0] for p in parts])),
             pa.array(count(a["doc"])), pa.array(count(b_doc)), pa.array(count(a["doc"].to_numpy()[last_a])),
             pa.array(count(links["doc"])), pa.array(digests, pa.string()), lists(distinct[own_code], np.int64), lists(times, np.int32)],
            ["chunk", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def chunks(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row for each text, or part of a long one: its counts, its digest (on its last part), and its distinct id pairs
    (a * vocabulary of B + b) with how many of its links hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        store = kept(("segments", a_path, b_path), lambda: Segments(a_path, b_path))
        aligner, seen = _Aligner(store, partition, chunk_bytes), 0
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
            group = np.cumsum(sizes) // chunk_bytes
            cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]]))
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                rows = np.arange(seen + x, seen + y) + (partition << 40)
                yield from aligner.batch(rows, texts.slice(x, y - x).to_pylist(), ids.slice(x, y - x))
            seen += len(group)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.format(kind=dict(docs.dtypes)["doc_id"]))


def align(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of docs(doc_id, text).

    A is a byte-level file of the tokenizers library and reads space + text, special names as plain text; B is a
    sentencepiece model with byte fallback that puts a space first itself. A text that is null or empty, or whose tokens'
    bytes on either side are not those of space + text, has no tokens: zeros and ''. n_best counts links whose pair's
    corpus-wide count is its B id's highest, ties included; count_sum adds the counts of all links. Repeated rows are
    texts of their own and null ids are carried; other columns are ignored; an empty table gives an empty one.
    """
    found = materialize(chunks(docs, a_path, b_path, chunk_bytes), "alignment")
    own = materialize(found.select("chunk", F.inline(F.arrays_zip("pairs", "times")))
                      .groupBy("chunk", "pairs").agg(F.sum("times").alias("n")), "alignment_pairs")
    totals = materialize(own.groupBy("pairs").agg(F.sum("n").alias("total")), "alignment_totals")
    vocabulary = F.lit(_vocabulary(b_path))
    highest = totals.groupBy(F.pmod("pairs", vocabulary).alias("b")).agg(F.max("total").alias("most"))
    ranked = materialize(totals.withColumn("b", F.pmod("pairs", vocabulary)).join(highest, "b")
                         .select("pairs", "total", (F.col("total") == F.col("most")).alias("best")), "alignment_ranked")
    scores = own.join(ranked, "pairs").select("chunk", "pairs", "total", "best")

    def add_up(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        key = pairs.column("pairs").to_numpy()
        order = np.argsort(key)
        total = pairs.column("total").to_numpy()[order]
        best = pairs.column("best").to_numpy()[order].astype(np.int64)
        lists = texts.column("pairs").combine_chunks()
        counts = np.diff(np.asarray(lists.offsets))
        times = np.asarray(texts.column("times").combine_chunks().flatten())
        at = np.searchsorted(key[order], np.asarray(lists.flatten()))
        ends = np.cumsum(counts)
        by_text = lambda x: (t := np.concatenate([[0], np.cumsum(x)]))[ends] - t[ends - counts]
        n_best, count_sum = by_text(times * best[at]), by_text(times * total[at])
        kept_columns = texts.select(["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
        return kept_columns.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))

    scored = found.groupBy("chunk").cogroup(scores.groupBy("chunk")).applyInArrow(
        add_up, f"row bigint, doc_id {dict(docs.dtypes)['doc_id']}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                "groups_sha256 string, n_best bigint, count_sum bigint")
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return scored.groupBy("row", "doc_id").agg(*sums, F.max("groups_sha256").alias("groups_sha256")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _vocabulary(b_path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=b_path).vocab_size()
