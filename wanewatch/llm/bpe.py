"""Byte-level BPE without regex: class arrays, a state-function scan, cached pair merging.

Pre-tokenisation. Every code point maps to a class. Eight states say what the character before
allows (a letter run, a joining space, the rest of a contraction ...), so one character is a
function from state to state. Rows of characters are composed to one function each, the row
functions are combined by an associative doubling scan, and a second pass from the known start
states yields the boundaries.

Merging. Slices of up to 15 bytes become two integers, are factorised per batch, and every
distinct slice is merged once. Merges of slices with equal length run as array operations over
all of them; slices over ``LONG`` bytes use a heap. Results stay in a bounded worker cache.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import unicodedata
from itertools import repeat

import numpy as np
import pandas as pd

from wanewatch.llm.common import kept

# Code points with the White_Space property, and the contraction endings.
WHITE = [
    9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
]
ONE_LETTER, TWO_LETTERS = "stmd", ["re", "ve", "ll"]

LETTER, NUMBER, OTHER, SHORT, LONGER, SPACE, BLANK, LAST_SPACE, LAST_BLANK, BREAK = range(10)
FRESH, IN_LETTER, IN_NUMBER, IN_OTHER, IN_WHITE, JOINING, ONE_LEFT, TWO_LEFT = range(8)
START = 8
ROW = 256  # characters per row of the scan
LONG = 32  # bytes; longer slices are merged with a heap
CACHE = 200_000  # slices remembered per worker and vocabulary
CHUNK = 1_000_000  # characters encoded at once, unless one text is longer
NONE = np.int32(2**31 - 1)


def class_table() -> np.ndarray:
    """Class of every code point."""
    first = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = np.array(first)
    table[kinds == "L"] = LETTER
    table[kinds == "N"] = NUMBER
    table[WHITE] = BLANK
    table[32] = SPACE
    return table


def transitions() -> np.ndarray:
    """``symbol * 8 + state`` to the next state, plus START if a slice begins here."""
    t = np.zeros((10, 8), np.uint8)
    for symbol, state in ((LETTER, IN_LETTER), (NUMBER, IN_NUMBER), (OTHER, IN_OTHER)):
        t[symbol] = state | START
        t[symbol, [state, JOINING]] = state
    t[LETTER, ONE_LEFT], t[LETTER, TWO_LEFT] = FRESH, ONE_LEFT
    for symbol, state in ((SHORT, ONE_LEFT), (LONGER, TWO_LEFT)):
        t[symbol] = state | START
        t[symbol, [IN_OTHER, JOINING]] = IN_OTHER
    t[[SPACE, BLANK]] = IN_WHITE | START
    t[[SPACE, BLANK], IN_WHITE] = IN_WHITE
    t[LAST_SPACE], t[LAST_BLANK], t[BREAK] = JOINING | START, FRESH | START, FRESH
    return t.ravel()


def symbols(points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Symbol of every code point, with the little lookahead that the pattern needs."""
    sym = kept("bpe-classes", class_table)[points]
    sym[breaks] = BREAK
    white = (sym == SPACE) | (sym == BLANK)
    last = np.zeros(len(sym), bool)
    last[:-1] = white[:-1] & ~white[1:] & (sym[1:] != BREAK)
    sym[last] += LAST_SPACE - SPACE
    at = np.flatnonzero(points == 39)
    if at.size:
        ahead = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = ahead[at + 1], ahead[at + 2]
        sym[at[np.isin(one, [ord(c) for c in ONE_LETTER])]] = SHORT
        for a, b in TWO_LETTERS:
            sym[at[(one == ord(a)) & (two == ord(b))]] = LONGER
    return sym


def scan(sym: np.ndarray) -> np.ndarray:
    """True where a slice begins. Blocked scan over composed state functions."""
    step = transitions()
    n = len(sym)
    rows = max(1, -(-n // ROW))
    cells = np.full(rows * ROW, BREAK, np.uint8)
    cells[:n] = sym
    cells = np.ascontiguousarray((cells * 8).reshape(rows, ROW).T)
    pure = step & 7
    maps = np.repeat(np.arange(8, dtype=np.uint8)[:, None], rows, 1)
    for column in cells:
        maps = pure[column + maps]
    prefix = np.ascontiguousarray(maps.T)  # row -> its function, then of all rows up to it
    gap = 1
    while gap < rows:
        prefix[gap:] = np.take_along_axis(prefix[gap:], prefix[:-gap], 1)
        gap *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = prefix[:-1, FRESH]
    flags = np.empty((ROW, rows), bool)
    for j, column in enumerate(cells):
        state = step[column + state]
        flags[j] = state >= START
        state &= 7
    return flags.T.ravel()[:n]


class Ranks:
    """Merge table of a vocabulary: (left id, right id) to merge rank and merged id."""

    def __init__(self, tokens: dict[int, bytes], pairs: np.ndarray, ranks: np.ndarray, made, added: dict[str, int] | None = None):
        # texts of fixed ids, found before anything else is cut; of two at one place the longer
        self.added = added or {}
        longest = sorted(self.added, key=len, reverse=True)
        self.added_at = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        self.byte_id = np.zeros(256, np.int32)
        for i, b in tokens.items():
            if len(b) == 1:
                self.byte_id[b[0]] = i
        self.made = np.append(np.asarray(made, np.int32), 0)
        size = 1 << max(4, int(4 * len(pairs)).bit_length())
        self.mask, self.shift = size - 1, np.uint64(64 - size.bit_length() + 1)
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NONE, np.int32)
        self.probes = 0
        keys, ranks = np.asarray(pairs, np.int64), np.asarray(ranks, np.int32)
        while len(keys):
            at = (self._home(keys) + self.probes) & self.mask
            free = np.flatnonzero(self.keys[at] == -1)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.rank[at[put]] = keys[put], ranks[put]
            keys, ranks = np.delete(keys, put), np.delete(ranks, put)
            self.probes += 1
        size = max(tokens) + 1 if tokens else 0
        lens = np.zeros(size + 1, np.int64)
        for i, b in tokens.items():
            lens[i + 1] = len(b)
        self.token_at = np.cumsum(lens)
        self.token_bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)
        pair = np.arange(65536)
        self.first_ranks = self.lookup(self.byte_id[pair >> 8], self.byte_id[pair & 255])
        # remembered slices: their number, and where the ids of a number are
        self.cache: dict[bytes, int] = {}
        self.flat, self.start, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    @classmethod
    def from_ranks(cls, data: bytes) -> Ranks:
        """A rank file: base64 token and rank per line; a pair merges if its bytes are a token."""
        ids = {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}
        pairs, ranks = [], []
        for token, i in ids.items():
            for cut in range(1, len(token)):
                a, b = ids.get(token[:cut]), ids.get(token[cut:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    ranks.append(i)
        made = np.arange(max(ids.values(), default=0) + 1)
        return cls({i: t for t, i in ids.items()}, pairs, ranks, made)

    @classmethod
    def from_merges(cls, data: bytes) -> Ranks:
        """A tokenizers file of the byte-level kind: its merge list in order, its added tokens."""
        file = json.loads(data)
        model, added = file["model"], {}
        for t in file.get("added_tokens") or []:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError(f"added token {t['content']!r}: only plain matches are known")
            added[t["content"]] = t["id"]
        # printable bytes stand for themselves, the others for the code points from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in set(plain)]
        back = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        ids, vocab = {}, model["vocab"]
        for token, i in vocab.items():
            if all(c in back for c in token):
                ids[i] = bytes(back[c] for c in token)
        ids |= {i: content.encode() for content, i in added.items()}
        pairs, made = [], []
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pairs.append(vocab[a] << 32 | vocab[b])
            made.append(vocab[a + b])
        return cls(ids, pairs, np.arange(len(pairs)), made, added)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of id pairs, NONE where there is none (ids below 0 never merge)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        home = self._home(keys)
        out = np.full(len(keys), NONE, np.int32)
        open_ = np.arange(len(keys))
        for probe in range(self.probes):
            at = (home[open_] + probe) & self.mask
            got = self.keys[at]
            hit = got == keys[open_]
            out[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit & (got != -1)]
            if not open_.size:
                break
        return out

    def merge_block(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number per slice) of slices of one length, a row of bytes each.

        Lowest rank first, leftmost on ties.
        """
        n, width = block.shape
        ids = self.byte_id[block]
        rows, ended = np.arange(n), []
        rank = np.full((n, width), NONE, np.int32)
        rank[:, :-1] = self.first_ranks[block[:, :-1].astype(np.int64) << 8 | block[:, 1:]]
        for size in range(width, 0, -1):  # every row left merges one pair, so all stay equally long
            best = rank.argmin(1)
            every = np.arange(len(rows))
            low = rank[every, best]
            go = low != NONE
            if not go.all():
                ended.append((rows[~go], ids[~go]))
                rows, ids, rank, best, low = rows[go], ids[go], rank[go], best[go], low[go]
                every = np.arange(len(rows))
            if not len(rows):
                break
            stay = np.ones((len(rows), size), bool)
            stay[every, best] = False
            rank = rank[stay].reshape(len(rows), size - 1)
            stay[every, best], stay[every, best + 1] = True, False
            ids[every, best] = self.made[low]
            ids = ids[stay].reshape(len(rows), size - 1)
            rank[:, -1] = NONE
            right, left = np.flatnonzero(best < size - 2), np.flatnonzero(best > 0)
            r, b = np.concatenate([right, left]), np.concatenate([best[right], best[left] - 1])
            rank[r, b] = self.lookup(ids[r, b], ids[r, b + 1])
        counts = np.zeros(n, np.int64)
        for at, made in ended:
            counts[at] = made.shape[1]
        start = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.uint32)
        for at, made in ended:
            flat[start[at][:, None] + np.arange(made.shape[1])] = made
        return flat, counts

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one long slice: linked list and heap, n log n."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i, r in enumerate(self.lookup(ids[:-1], ids[1:]).tolist()) if r != NONE]
        heapq.heapify(heap)
        ids, alive = ids.tolist(), [True] * n
        known: dict[tuple[int, int], int] = {}

        def rank_of(i: int, j: int) -> int:
            pair = ids[i], ids[j]
            if pair not in known:
                known[pair] = int(self.lookup(np.array(pair[:1]), np.array(pair[1:]))[0])
            return known[pair]

        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or (j := after[i]) >= n or rank_of(i, j) != r:
                continue
            ids[i], alive[j], after[i] = int(self.made[r]), False, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (x := rank_of(i, after[i])) != NONE:
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0 and (x := rank_of(h, i)) != NONE:
                heapq.heappush(heap, (x, h))
        return np.array([v for v, a in zip(ids, alive, strict=True) if a], np.uint32)

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, count) of every slice; known slices come from the cache."""
        number = np.fromiter(map(self.cache.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(number < 0)
        length = np.fromiter((len(pieces[k]) for k in missing.tolist()), np.int64, len(missing))
        missing = missing[np.argsort(length, kind="stable")]
        length.sort()
        mine = [pieces[k] for k in missing.tolist()]
        flats, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        edges = np.flatnonzero(np.diff(length, prepend=-1, append=-1)).tolist()
        for a, b in zip(edges, edges[1:], strict=False):
            if length[a] > LONG:
                made = [self.merge_long(p) for p in mine[a:b]]
                flats += made
                counts.append(np.array([len(m) for m in made], np.int64))
            else:
                block = np.frombuffer(b"".join(mine[a:b]), np.uint8).reshape(b - a, -1)
                flat, count = self.merge_block(block)
                flats.append(flat)
                counts.append(count)
        flat, count = np.concatenate(flats), np.concatenate(counts)
        start = len(self.flat) + np.cumsum(count) - count
        number[missing] = len(self.start) + np.arange(len(missing))
        every = tuple(np.concatenate(x) for x in ((self.flat, flat), (self.start, start), (self.count, count)))
        room = min(CACHE - len(self.start), int(np.searchsorted(length, LONG, "right")))
        if room > 0:
            self.cache.update(zip(mine[:room], number[missing[:room]].tolist(), strict=True))
            ids = int(count[:room].sum())
            self.flat, self.start, self.count = (
                x[: len(old) + n].copy()
                for x, old, n in zip(every, (self.flat, self.start, self.count), (ids, room, room), strict=True)
            )
        return every[0], every[1][number], every[2][number]


def _chunks(texts: list[str]):
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > CHUNK:
            yield texts[start:i]
            start, total = i, 0
        total += len(text) + 1
    if start < len(texts):
        yield texts[start:]


def encode(texts: list[str], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, number of ids per text)."""
    if ranks.added and any(token in text for token in ranks.added for text in texts):
        return _encode_around(texts, ranks)
    return _encode_plain(texts, ranks)


def _encode_around(texts: list[str], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """``encode`` where added tokens cut texts: what lies between them is encoded like a text."""
    split = [ranks.added_at.split(t) for t in texts]
    ids, counts = _encode_plain([part for parts in split for part in parts[::2]], ranks)
    fixed = [[ranks.added[token] for token in parts[1::2]] for parts in split]
    number = np.array([len(f) for f in fixed], np.int64)
    last = np.cumsum(number + 1) - 1  # the last part of a text has no added token behind it
    behind = np.delete(np.cumsum(counts), last)
    ids = np.insert(ids, behind, np.array([i for f in fixed for i in f], np.uint32))
    return ids, np.add.reduceat(counts, last - number) + number


def _encode_plain(texts: list[str], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    parts = [_encode(chunk, ranks) for chunk in _chunks(texts)]
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _encode(texts: list[str], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    breaks = np.cumsum([len(t) + 1 for t in texts]) - 1
    edge = scan(symbols(points, breaks))
    edge[breaks] = True
    bounds = np.flatnonzero(edge)
    is_break = np.zeros(len(points), bool)
    is_break[breaks] = True
    real = ~is_break[bounds]
    raw = joined.encode("utf-8")
    if len(raw) == len(points):
        byte_at = bounds
    else:
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        byte_at = (np.cumsum(width, dtype=np.int64) - width)[bounds]
    begin = byte_at[real]
    end = np.append(byte_at, len(raw))[1:][real]
    codes, pieces = distinct_slices(raw, begin, end)
    flat, first, sizes = ranks.merged(pieces)
    counts = sizes[codes]
    ids = gather(flat, first[codes], counts)
    # slices before each break, hence ids before it
    upto = np.cumsum(real)[np.searchsorted(bounds, breaks)]
    ids_upto = np.append(0, np.cumsum(counts))[upto]
    return ids, np.diff(ids_upto, prepend=0)


def gather(flat: np.ndarray, start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[start : start + count]``."""
    total = int(counts.sum())
    shift = start - (np.cumsum(counts) - counts)
    return flat[np.repeat(shift, counts) + np.arange(total)]


def distinct_slices(raw: bytes, begin: np.ndarray, end: np.ndarray):
    """(code of every slice, the distinct slices). Exact: short slices compare as two integers."""
    padded = raw + b"\0" * 16
    words = np.ndarray((len(raw) + 9,), "<u8", padded, 0, (1,))
    size = end - begin
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    short = np.flatnonzero(size < 16)
    length, at = size[short], begin[short]
    low = words[at] & mask[np.minimum(length, 8)]
    high = words[np.minimum(at + 8, len(raw))] & mask[np.clip(length - 8, 0, 7)]
    high |= length.astype(np.uint64) << np.uint64(56)
    mixed = low * np.uint64(0x9E3779B97F4A7C15) ^ (high + (low >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    part, uniques = pd.factorize(mixed)
    first = np.zeros(len(uniques), np.int64)
    first[part[::-1]] = np.arange(len(part))[::-1]
    same = (low[first[part]] == low) & (high[first[part]] == high)
    codes = np.zeros(len(begin), np.int64)
    codes[short] = part
    pieces = [raw[a:b] for a, b in zip(at[first].tolist(), end[short][first].tolist(), strict=True)]
    others = np.flatnonzero(size >= 16)
    if not same.all():
        others = np.concatenate([others, short[~same]])
    number: dict[bytes, int] = {}
    for k in others.tolist():
        piece = raw[begin[k] : end[k]]
        code = number.setdefault(piece, len(pieces))
        if code == len(pieces):
            pieces.append(piece)
        codes[k] = code
    return codes, pieces


def decode(ids: np.ndarray, ranks: Ranks) -> tuple[bytes, np.ndarray]:
    """(bytes of the ids in a row, byte offset behind each id)."""
    start = ranks.token_at[ids]
    counts = ranks.token_at[ids + 1] - start
    return gather(ranks.token_bytes, start, counts).tobytes(), np.cumsum(counts)
