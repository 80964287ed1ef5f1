"""Elias-Fano n-gram trie: levels of contexts and their successors in compact, memory-mapped arrays.

A level holds the contexts of one length (hashes, ascending) and, for each in turn, the words that follow it. All of its integers
are monotone sequences in Elias-Fano form (low bits packed, high bits in unary): the contexts, the pointers to each one's
first successor, and the successors, each written relative to its context (the context's place, then the word), so
that a look-up is a successor search within the context's own range. Smoothed probabilities and back-off weights
are numbers of a codebook whose steps are equal in the logarithm; it follows from the number of bits alone.

``to_bytes`` lays all arrays end to end; ``mapped`` copies them once to a memory map, and the level's arrays are views of it.
"""

from __future__ import annotations

import json
import mmap

import numpy as np

#: Bits of a word within its context, and of a context.
WORD_BITS, CONTEXT_BITS = 24, 40
#: The codebook reaches down to 10 to minus this.
DECADES = 10.0


def codes(p: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of probabilities in the codebook, from 1 on; 0 is kept for what isn't there."""
    steps = (1 << bits) - 2
    found = np.rint(-np.log10(np.maximum(p, 1e-300)) * (steps / DECADES))
    return (np.clip(found, 0, steps) + 1).astype(np.uint8 if bits == 8 else np.uint16)


def codebook(bits: int) -> np.ndarray:
    """The probability of each number; 0 for number 0."""
    steps = (1 << bits) - 2
    return np.append(0.0, 10.0 ** (-np.arange(steps + 1) * (DECADES / steps)))


class EliasFano:
    """A non-decreasing sequence of integers below 2**63, with access and search."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.bits, self.low, self.high = n, bits, low, high
        self._plain: np.ndarray | None = None

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values).astype(np.uint64)
        n = len(values)
        bound = int(values[-1]) + 1 if n else 1
        bits = max(0, (bound // max(n, 1)).bit_length() - 1)
        part = (values & np.uint64((1 << bits) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)
        low = np.packbits(np.unpackbits(part, axis=1, count=bits, bitorder="little"), bitorder="little") if bits and n else np.empty(0, np.uint8)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, bits, low, np.packbits(high, bitorder="little"))

    def values(self) -> np.ndarray:
        """All values, laid out once for many searches."""
        if self._plain is None:
            ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
            plain = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)
            if self.bits and self.n:
                part = np.unpackbits(self.low, count=self.n * self.bits, bitorder="little").reshape(self.n, self.bits)
                whole = np.zeros((self.n, 64), np.uint8)
                whole[:, :self.bits] = part
                plain |= np.packbits(whole, axis=1, bitorder="little").view("<u8").ravel()
            self._plain = plain.astype(np.int64)
        return self._plain

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each value (the first of equal ones), -1 if it isn't there."""
        wanted = np.asarray(wanted, np.int64)
        if not self.n or not len(wanted):
            return np.full(len(wanted), -1, np.int64)
        plain = self.values()
        at = np.searchsorted(plain, wanted)
        return np.where(plain[np.minimum(at, self.n - 1)] == wanted, at, -1)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits], np.int64), self.low, self.high]

    @classmethod
    def of(cls, head: np.ndarray, low: np.ndarray, high: np.ndarray) -> EliasFano:
        return cls(int(head[0]), int(head[1]), low, high)


class Level:
    """One level of the trie: contexts with totals and back-off weights, and their successors with probabilities."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, totals: np.ndarray, backoff: np.ndarray,
                 prob: np.ndarray):
        self.contexts, self.pointers, self.successors = contexts, pointers, successors
        self.totals, self.backoff, self.prob = totals, backoff, prob

    @classmethod
    def build(cls, contexts: np.ndarray, totals: np.ndarray, backoff: np.ndarray, parent: np.ndarray, words: np.ndarray,
              prob: np.ndarray, bits: int = 8) -> Level:
        """contexts ascend; parent (each successor's context, by place) and then words ascend. backoff and prob are probabilities."""
        pointers = np.searchsorted(parent, np.arange(len(contexts) + 1))
        relative = (parent.astype(np.int64) << WORD_BITS) | words.astype(np.int64)
        return cls(EliasFano.build(contexts), EliasFano.build(pointers), EliasFano.build(relative),
                   totals.astype(np.int64), codes(backoff, bits), codes(prob, bits))

    def search(self, contexts: np.ndarray, parent: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(total, code of the back-off weight) of each context and the code of each successor (parent: its context among
        those asked for); 0 where the level has none."""
        node = self.contexts.find(contexts)
        there = node >= 0
        total, backoff = np.zeros(len(node), np.int64), np.zeros(len(node), self.backoff.dtype)
        total[there], backoff[there] = self.totals[node[there]], self.backoff[node[there]]
        first = self.pointers.values()
        full = np.zeros(len(node), bool)
        full[there] = first[node[there] + 1] > first[node[there]]
        prob = np.zeros(len(parent), self.prob.dtype)
        ask = np.flatnonzero(full[parent])  # contexts without successors are not searched
        place = self.successors.find((node[parent[ask]] << WORD_BITS) | words[ask].astype(np.int64))
        prob[ask[place >= 0]] = self.prob[place[place >= 0]]
        return total, backoff, prob

    def to_bytes(self) -> bytes:
        parts = [*self.contexts.parts(), *self.pointers.parts(), *self.successors.parts(), self.totals, self.backoff, self.prob]
        head = json.dumps([[p.dtype.str, len(p)] for p in parts]).encode()
        body = b"".join(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)
        return len(head).to_bytes(8, "little") + head + b"\0" * (-len(head) % 8) + body

    @classmethod
    def from_buffer(cls, buffer) -> Level:
        size = int.from_bytes(bytes(buffer[:8]), "little")
        at, parts = 8 + size + -size % 8, []
        for kind, n in json.loads(bytes(buffer[8:8 + size])):
            parts.append(np.frombuffer(buffer, kind, n, at))
            at += parts[-1].nbytes + -parts[-1].nbytes % 8
        return cls(*[EliasFano.of(*parts[i:i + 3]) for i in (0, 3, 6)], *parts[9:])

    @classmethod
    def mapped(cls, data: bytes) -> Level:
        """The level over a memory map of the bytes."""
        held = mmap.mmap(-1, len(data))
        held.write(data)
        return cls.from_buffer(held)
