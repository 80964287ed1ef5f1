"""Vector best-fit packing of token sequences.

Every piece has a demand vector (tokens, 1 document, attention cost = tokens squared) and every
sequence a residual vector of the three capacities. Pieces go, longest first, to the
open sequence that can take them under every constraint and whose weighted residual norm
afterwards is smallest (``rule="norm"``), or whose residual has the largest weighted dot
product with the demand (``rule="dot"``).

Tokenizing is one scan that writes the pieces (no shuffle); only lengths are then dealt out
in blocks of about ``BLOCK_PIECES`` pieces, so that a task's memory is bounded. A block leaves
a few sequences part-filled, which is about one in ten thousand.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.arrays import raw, row_chunks, texts
from wordlens.llm.worker import kept
from wordlens.session import materialize

MAX_TOKENS, MAX_DOCUMENTS, MAX_COST = 2048, 2048, 2048 * 2048
END_ID = 0
BLOCK_PIECES = 20_000
#: Weights of tokens, documents and attention cost in the norm and the dot product.
WEIGHTS = (1.0, 1e-3, 1e-3)
#: Words whose ids a worker remembers at most, and new ones that are encoded as one text.
KNOWN_WORDS, RUN = 700_000, 200
#: ASCII punctuation but the apostrophe, which may begin a token that goes on with letters.
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'")


class WordTokenizer:
    """Ids of texts from a tokenizers file, remembered by white-space-separated word.

    Right only for tokenizers whose tokens never span or depend on white space, that lower-case, that part letters
    from punctuation, and that mark a word's last token by a suffix (as the one in use), so a text's ids are its words' ids in
    turn. A text that holds the name of a special token is encoded whole, as the file has it. Ids are
    little-endian unsigned 32-bit integers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.known: dict[bytes, bytes] = {}
        self.whole, self.words = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.words.encode_special_tokens = True
        self.names = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        suffix = self.words.model.end_of_word_suffix
        size = max(self.words.get_vocab().values()) + 1
        self.last = np.array([bool(suffix) and (self.words.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        # lower-case ASCII words are what the model itself sees
        self.model, sample = self.words.model, "abcdefghijklmnopqrstuvwxyz"
        self.plain = array("I").itemsize == 4 and sys.byteorder == "little" and all(
            [t.id for t in self.model.tokenize(x)] == self._ids(self.words, x.encode()).tolist() for x in (sample, sample[::-1], "the"))

    @staticmethod
    def _ids(tokenizer, text: bytes) -> np.ndarray:
        return np.array(tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4")

    def learn(self, words: set[bytes]) -> None:
        """Add the ids of words. One that ends in punctuation after a letter has the ids of the two parts; words of lower-case
        ASCII letters go to the model itself; others of letters alone are encoded many at once, as each ends with a last token."""
        ended, letters, others, known = [], [], [], self.known
        for w in words:
            if w[-1] in PUNCTUATION:
                x = w.rstrip(PUNCTUATION)
                if x and (x[-1:].isalpha() or x[-1] > 127 and x.decode("utf-8", "replace")[-1].isalpha()):
                    ended.append((w, x, w[len(x):]))
                    continue
            others.append(w)
        parts = {x for _, x, _ in ended}.union(e for _, _, e in ended).difference(known, others)
        new, others = [*others, *parts], []
        for w in new:
            if w.isalpha() and w.islower() and self.plain:
                known[w] = array("I", [t.id for t in self.model.tokenize(w.decode())]).tobytes()
            else:
                (letters if w.decode("utf-8", "replace").isalpha() else others).append(w)
        runs = [letters[at:at + RUN] for at in range(0, len(letters), RUN)]
        encoded = self.words.encode_batch([b" ".join(x).decode("utf-8", "replace") for x in runs], add_special_tokens=False)
        for run, found in zip(runs, encoded):
            ids = np.array(found.ids, "<u4")
            stops = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(stops) != len(run):
                others += run
                continue
            flat = ids.tobytes()
            known.update(zip(run, [flat[x:y] for x, y in zip([0, *stops], stops)]))
        for w in others:
            known[w] = self._ids(self.words, w).tobytes()
        for w, x, end in ended:
            known[w] = known[x] + known[end]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids."""
        whole = {i: t for i, t in enumerate(texts) if any(x in t for x in self.names)}
        # combining marks (lead bytes 0xCC, 0xCD) may compose with a lower-case letter only; leave those texts' case
        parts = [[] if i in whole else (t if b"\xcc" in t or b"\xcd" in t else t.lower()).split() for i, t in enumerate(texts)]
        words = set().union(*parts)
        missing = words.difference(self.known)
        if len(self.known) + len(missing) > KNOWN_WORDS:
            self.known.clear()
            missing = words
        self.learn(missing)
        out = [b"".join(map(self.known.__getitem__, own)) for own in parts]
        for i, t in whole.items():
            out[i] = self._ids(self.whole, t).tobytes()
        return out


def pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
           end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) per piece of docs(doc_id, text)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = kept(("word tokenizer", tokenizer_path), lambda: WordTokenizer(tokenizer_path))
        end, step = np.array([end_id], "<u4").tobytes(), 4 * max_tokens
        for batch in batches:
            row, piece, length, crc = [], [], [], []
            column = batch.column("text")
            for first, last in row_chunks(raw(column)[0]):
                for r, ids in enumerate(tokenizer.ids(list(texts(column.slice(first, last - first)))), first):
                    ids += end
                    for i, at in enumerate(range(0, len(ids), step)):
                        own = ids[at:at + step]
                        row.append(r)
                        piece.append(i)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
            number = np.array(piece, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number.astype(np.int32)),
                 pa.array(number * max_tokens), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: np.ndarray, capacity=(MAX_TOKENS, MAX_DOCUMENTS, MAX_COST), weights=WEIGHTS,
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length by vector best-fit, longest first (ties: as given)."""
    lengths = np.asarray(lengths, np.int64)
    demand = np.stack([lengths, np.ones_like(lengths), lengths ** 2], axis=1).astype(np.float64)
    size = np.asarray(capacity, np.float64)
    if len(lengths) and (demand.max(axis=0) > size).any():
        raise ValueError("a piece is larger than a sequence")
    scale = np.asarray(weights) / size
    order = np.argsort(-lengths, kind="stable")
    least = demand.min(axis=0) if len(lengths) else size
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins, residual, n_open, made = np.empty(64, np.int64), np.empty((64, 3)), 0, 0
    for i in order.tolist():
        d = demand[i]
        left = residual[:n_open]
        fits = np.flatnonzero((left >= d).all(axis=1))
        if len(fits):
            rest = left[fits] - d
            if rule == "dot":
                pick = fits[np.argmax(left[fits] @ (d * scale ** 2))]
            else:
                pick = fits[np.argmin(((rest * scale) ** 2).sum(axis=1))]
        else:
            if n_open == len(open_bins):
                open_bins = np.concatenate([open_bins, np.empty_like(open_bins)])
                residual = np.concatenate([residual, np.empty_like(residual)])
            pick, open_bins[n_open], residual[n_open] = n_open, made, size
            n_open, made = n_open + 1, made + 1
        bins[i] = open_bins[pick]
        offsets[i] = int(size[0] - residual[pick, 0])
        residual[pick] -= d
        if (residual[pick] < least).any():  # nothing fits any more: close it
            n_open -= 1
            open_bins[pick], residual[pick] = open_bins[n_open], residual[n_open]
    return bins, offsets


def pack(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
         max_documents: int = MAX_DOCUMENTS, max_cost: int = MAX_COST, weights=WEIGHTS,
         rule: str = "norm", block_pieces: int = BLOCK_PIECES, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    A document is its ids and then the end id; only longer ones than max_tokens are cut.
    A null text is empty: one piece with the end id. Null and repeated doc_ids are packed row
    by row. Other columns are ignored; an empty table gives an empty one.
    """
    cut = materialize(pieces(docs, tokenizer_path, max_tokens, end_id)
                      .withColumn("at", F.monotonically_increasing_id()), "pieces")
    blocks = max(1, -(-cut.count() // block_pieces))
    capacity = (max_tokens, max_documents, max_cost)
    dealt = cut.withColumn("block", F.pmod(F.xxhash64("at"), F.lit(blocks)))

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at", kind="stable")
        own, offset = best_fit(block["length"].to_numpy(), capacity, weights, rule)
        block["sequence_id"] = (block["block"].to_numpy(np.int64) << 32) + own
        block["offset"] = offset
        return block[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    kind = dict(docs.dtypes)["doc_id"]
    nullable = dealt.withColumn("doc_id", F.col("doc_id").cast("string"))
    packed = nullable.groupBy("block").applyInPandas(
        run, "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint, "
             "sequence_id bigint, offset bigint")
    return packed.withColumn("doc_id", F.col("doc_id").cast(kind))
