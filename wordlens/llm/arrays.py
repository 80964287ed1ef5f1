"""Words of whole Arrow text columns as NumPy arrays, a bounded chunk at a time.

A chunk holds whole rows of about ``CHUNK_BYTES`` of text (one row at least), so a task
needs memory in proportion to a chunk or to its longest text, whatever its batch holds.
Word and k-gram hashes are 64-bit polynomial hashes from prefix sums (arithmetic modulo
2**64), finished by a bit mixer; equal byte sequences have equal hashes everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

#: ASCII white space, space and the bytes 9 to 13.
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Odd multipliers of the two polynomial hashes (bytes in a word, words in a k-gram).
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse power modulo 2**64, for i below n."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(max(n, 1), b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class _Powers:
    """Powers of a base, kept and grown on demand (once per Python worker)."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.empty(0, np.uint64), np.empty(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = powers(self.base, max(n, CHUNK_BYTES))
        return self.up[:n], self.down[:n]

    def __reduce__(self):
        return _Powers, (self.base,)


_byte_powers, _word_powers = _Powers(BYTE_BASE), _Powers(WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of rows ``first_row`` to ``first_row + n_rows - 1`` of a column.

    ``first[r]`` is the index of row r's first word; ``first[n_rows]`` their number.
    """

    first_row: int
    n_rows: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        """Each word's row, from 0."""
        return np.repeat(np.arange(self.n_rows), self.counts())

    def position(self) -> np.ndarray:
        """Each word's place in its row, from 0."""
        return np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.counts())

    def hashes(self) -> np.ndarray:
        up, down = _byte_powers(len(self.data))
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
        if not len(self.starts):
            return np.empty(0, np.uint64)
        return mix((total[self.ends] - total[self.starts]) * down[self.starts]
                   + (self.ends - self.starts).astype(np.uint64))

    def text(self, word: int) -> bytes:
        return self.data[self.starts[word]:self.ends[word]].tobytes()


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on (len - k + 1 of them; rows not heeded)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _word_powers(len(hashes))
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up, out=total[1:])
    return mix((total[k:] - total[:-k]) * down[:n] + np.uint64(k))


def span_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the words from starts[i] to ends[i] - 1, for each i."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _word_powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of the w values from each place on (len - w + 1 of them)."""
    done, out = 1, x
    while done < w:
        step = min(done, w - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(n + 1, np.int64), np.empty(0, np.uint8)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def row_chunks(offsets: np.ndarray, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, row after the last) of chunks of about max_bytes, a row at least."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def words(column: pa.Array, separators: np.ndarray = WHITE_SPACE, lower: bool = False,
          max_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words (maximal runs of bytes that are no separators) of each chunk of rows."""
    offsets, data = raw(column)
    for at, to in row_chunks(offsets, max_bytes):
        own = offsets[at:to + 1] - offsets[at]
        part = data[offsets[at]:offsets[to]]
        if lower:
            part = LOWER[part]
        inside = ~separators[part]
        starts_here, ends_here = inside.copy(), inside.copy()
        starts_here[1:] &= ~inside[:-1]
        ends_here[:-1] &= ~inside[1:]
        edges = np.unique(own[(own > 0) & (own < len(part))])
        starts_here[edges] = inside[edges]
        ends_here[edges - 1] = inside[edges - 1]
        starts = np.flatnonzero(starts_here)
        yield Words(at, to - at, part, starts, np.flatnonzero(ends_here) + 1,
                    np.searchsorted(starts, own))


def texts(column: pa.Array) -> Iterator[bytes]:
    """The bytes of each row's text; a null counts as empty."""
    offsets, data = raw(column)
    view = memoryview(data)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield bytes(view[a:b])
