"""Fill-in-the-middle transformation with word-parallel (SWAR) search of unit ends.

A text is cut into units, left to right: a run of ASCII letters, or any other single code point.
The UTF-8 bytes are read as 64-bit words. Eight bytes at a time, arithmetic marks the bytes that
end a unit: a letter before a letter ends none, nor does a byte before a continuation byte. One
bit count per word gives running totals; the word of the k-th end is found by binary search in
them and the byte inside the word by comparing its eight running lane counts at once.

Two hashed draws cut the units into prefix, middle and suffix. Forms: ``psm`` is prefix, suffix,
middle, ``spm`` is suffix, prefix, middle, each behind its mark; ``plain`` leaves the text alone.
``restored`` rebuilds the text from output and form alone, as texts that hold a mark stay plain.

Cases: a null or empty text is plain with no units; a text with a mark is plain; a null id draws
from the empty text; repeated rows (same id) draw alike; an empty table gives an empty one; only
``keep`` columns pass through, helper columns are prefixed, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanewatch.llm.common import bounded_groups, spread, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PLAIN_FROM = 90  # draws of a hundred from which a text stays plain
SPM_BELOW = 20  # draws of a hundred below which the suffix comes first
BATCH_BYTES = 1_000_000
ONES, HIGH = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
FORMS = [("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string")]


def lanes(value: int) -> np.uint64:
    """``value`` in each of the eight bytes of a word."""
    return np.uint64(value) * ONES


def unit_ends(words: np.ndarray) -> np.ndarray:
    """Words with the high bit of every byte that ends a unit; zero bytes end one each."""
    low = (words | lanes(0x20)) & ~HIGH
    # adding 0x1F carries into the high bit from 'a' on, adding 0x05 from the byte after 'z' on
    letter = (low + lanes(0x80 - ord("a"))) & ~(low + lanes(0x7F - ord("z"))) & ~words & HIGH
    tail = words & ~(words << np.uint64(1)) & HIGH  # 10xxxxxx
    return ~((letter & following(letter)) | following(tail)) & HIGH


def following(marks: np.ndarray) -> np.ndarray:
    """The mark of the next byte, for every byte."""
    out = marks >> np.uint64(8)
    out[:-1] |= marks[1:] << np.uint64(56)
    return out


def select(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Byte (0 to 7) of the ``rank``-th mark (from 1) of every word."""
    running = (word >> np.uint64(7)) * ONES  # a byte holds the marks up to itself
    reached = ((running | HIGH) - rank.astype(np.uint64) * ONES) & HIGH
    return 8 - np.bitwise_count(reached).astype(np.int64)


class Units:
    """Unit ends of several texts; every text starts a new word and ends in a zero byte."""

    def __init__(self, texts: list[bytes]):
        size = np.array([len(t) for t in texts], np.int64)
        stop = np.cumsum(size // 8 + 1)
        self.first = stop - size // 8 - 1
        raw = b"".join(t.ljust((len(t) // 8 + 1) * 8, b"\0") for t in texts)
        self.ends = unit_ends(np.frombuffer(raw, "<u8").astype(np.uint64))
        # padding ends no unit
        self.ends[stop - 1] &= (np.uint64(1) << (8 * (size % 8)).astype(np.uint64)) - np.uint64(1)
        self.running = np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)
        self.before = np.where(self.first > 0, self.running[self.first - 1], 0)
        self.n = self.running[stop - 1] - self.before

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Bytes of every text that its first ``units`` units take."""
        rank = self.before + units
        at = np.searchsorted(self.running, rank)  # first word that reaches the rank
        at = np.minimum(at, len(self.ends) - 1)
        inside = rank - np.where(at > 0, self.running[at - 1], 0)
        return np.where(units > 0, (at - self.first) * 8 + select(self.ends[at], inside) + 1, 0)


def draws(doc_id, seed: int) -> list[int]:
    """Four 32-bit draws of an id."""
    name = "" if doc_id is None or pd.isna(doc_id) else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def transformed(texts: list[bytes], ids: list, seed: int = SEED) -> pd.DataFrame:
    """The ``FORMS`` columns of some texts."""
    units = Units(texts)
    drawn = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    one, two = (drawn[:, k] % (units.n + 1) for k in (0, 1))
    left, right = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
    out = []
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    for k, text in enumerate(texts):
        n, a, b = int(units.n[k]), int(left[k]), int(right[k])
        if not text or any(m in text for m in marks) or drawn[k, 2] % 100 >= PLAIN_FROM:
            out.append((n, "plain", None, None, text.decode()))
            continue
        prefix, middle, suffix = text[:a].decode(), text[a:b].decode(), text[b:].decode()
        if drawn[k, 3] % 100 < SPM_BELOW:
            form, body = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        else:
            form, body = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
        out.append((n, form, len(prefix), len(middle), body))
    made = pd.DataFrame(out, columns=[name for name, _ in FORMS])
    return made.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})


def fill_in_middle(
    df: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", seed: int = SEED
) -> DataFrame:
    """``keep`` columns of every row plus ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``."""
    source = spread(df).select(
        *keep, F.col(doc_id).cast("string").alias("__id"), F.col(text).alias("__text")
    )
    fields = [source.schema[c] for c in keep]
    fields += T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in FORMS)).fields

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = [text_bytes(t) for t in batch["__text"].tolist()], batch["__id"].tolist()
            for a, b in bounded_groups([len(t) for t in texts], BATCH_BYTES):
                rest = batch.iloc[a:b].drop(columns=["__id", "__text"]).reset_index(drop=True)
                yield pd.concat([rest, transformed(texts[a:b], ids[a:b], seed)], axis=1)

    return source.mapInPandas(run, T.StructType(fields))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text again, from output and form."""
    part = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(F.col(form) == "psm", F.concat(part[1], part[3], part[2]))
        .when(F.col(form) == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(F.col(output))
    )
