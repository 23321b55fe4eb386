"""Words, lines and hashed n-grams of many texts at once, as arrays.

A word is a run of bytes other than space and 0x09 to 0x0D.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd

from wanewatch.llm.bpe import distinct_slices

GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@dataclass
class Words:
    """All words of a batch; ``doc`` is the text's index, ``code`` numbers the distinct words."""

    raw: bytes
    data: np.ndarray
    doc_begin: np.ndarray
    doc_end: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    code: np.ndarray
    pieces: list[bytes]

    @property
    def n_docs(self) -> int:
        return len(self.doc_begin)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte flag over every text."""
        total = np.append(0, np.cumsum(flags, dtype=np.int64))
        return total[self.doc_end] - total[self.doc_begin]

    def count(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)


def words_of(texts: list[bytes], codes: bool = True) -> Words:
    raw = b"\n".join(texts) + b"\n"
    data = np.frombuffer(raw, np.uint8)
    stop = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
    start = stop - np.array([len(t) for t in texts], np.int64)
    gap = GAP[data]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    begin, end = edge[::2], edge[1::2]
    doc = np.searchsorted(stop, begin)
    code, pieces = distinct_slices(raw, begin, end) if codes else (np.zeros(0, np.int64), [])
    return Words(raw, data, start, stop, begin, end, doc, code, pieces)


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of every word."""
    if not w.pieces:
        return np.zeros(0, np.uint64)
    one = np.array([zlib.crc32(p) for p in w.pieces], np.uint64)
    return mixed(one)[w.code]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    return x ^ (x >> np.uint64(32))


def repeated_in_windows(w: Words, size: int = 3) -> np.ndarray:
    """True for words within a window of ``size`` words that its text has more than once."""
    n = len(w.code)
    hit = np.zeros(n, bool)
    if n < size:
        return hit
    at = np.flatnonzero(w.doc[: n - size + 1] == w.doc[size - 1 :])
    key = w.doc[at]
    for k in range(size):  # numbering after every step keeps keys far below 64 bits
        key = pd.factorize(key * np.int64(len(w.pieces)) + w.code[at + k])[0]
    again = at[np.bincount(key)[key] > 1] if len(at) else at
    for k in range(size):
        hit[again + k] = True
    return hit


def duplicate_lines(w: Words) -> np.ndarray:
    """Lines of every text that hold a word and equal an earlier line of the text."""
    newline = np.flatnonzero(w.data == 10)
    begin, end = np.append(0, newline[:-1] + 1), newline
    has = np.searchsorted(w.begin, end) > np.searchsorted(w.begin, begin)
    begin, end = begin[has], end[has]
    code, _ = distinct_slices(w.raw, begin, end)
    doc = np.searchsorted(w.doc_end, begin)
    lines = np.bincount(doc, minlength=w.n_docs)
    firsts = np.unique(doc * np.int64(len(begin) + 1) + code) // (len(begin) + 1)
    return lines - np.bincount(firsts.astype(np.int64), minlength=w.n_docs)


def char_grams(w: Words, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every run of ``size`` bytes (at most 8) inside a text."""
    n = len(w.data) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    view = np.ndarray((n,), "<u8", w.raw + b"\0" * 8, 0, (1,))
    count = np.maximum(w.doc_end - w.doc_begin - size + 1, 0)
    doc = np.repeat(np.arange(w.n_docs), count)
    at = np.repeat(w.doc_begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
    gram = (view & np.uint64((1 << 8 * size) - 1 if size < 8 else 2**64 - 1))[at]
    return ((gram * MIX[size & 3]) >> np.uint64(64 - bits)).astype(np.int64), doc


def word_grams(w: Words, hashes: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words, and pairs of neighbours; a word that follows itself is one common pair."""
    top = np.uint64(64 - bits)
    single = ((hashes * MIX[2]) >> top).astype(np.int64), w.doc
    same_doc = np.flatnonzero(w.doc[:-1] == w.doc[1:]) if len(w.doc) else np.zeros(0, np.int64)
    a, b = hashes[same_doc], hashes[same_doc + 1] if len(same_doc) else hashes[:0]
    pair = np.where(a == b, np.uint64(1), a * MIX[1] + b) * MIX[3]
    return [single, ((pair >> top).astype(np.int64), w.doc[same_doc])]
