"""Token-id files in Simple-8b: varying counts of ids per 64-bit word.

A word's top four bits select how many values of which width its other 60 bits hold. Values are
ids plus one; 0 marks an escape, whose id stands in the block's list: rare wide ids would widen
all their neighbours otherwise. A page (one row) holds whole documents in ascending order as
blocks of ``BLOCK`` ids; the word offset of every block is kept, so any block can be decoded on
its own, selector by selector, as array operations. Pages are written by Spark's Parquet writer:
commits are atomic and any store works.

Cases: a document without text is its end id; a null doc_id sorts first; repeated doc_ids follow
each other by text; an empty table gives files without pages; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.llm import bpe
from wanewatch.llm.common import bounded_groups, prefix_sums, text_list
from wanewatch.llm.tokens import GPT_FILE, ranks_of, vocabulary

# Values per word and bits per value of selectors 0 to 15.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
BLOCK = 8192
ENCODE_CHARS = 1_000_000  # characters encoded at once
PAGE_IDS = 150_000
WIDTH_OF = np.frexp(np.arange(1 << 17).astype(np.float64))[1].astype(np.int8)  # bits of small values
BROADCAST_ROWS = 200_000
ESCAPE_SHARE = 1 / 128  # ids escaped at most, as a share of a block
PAGES = (
    "part long, page long, doc_ids array<{kind}>, counts array<long>, n long, "
    "block_words array<int>, words binary, escape_counts array<int>, escape_at binary, escapes binary"
)


def choices(width: np.ndarray, n: int) -> np.ndarray:
    """The selector that holds most values from each of the first ``n`` places.

    A selector has fewer and wider values than the one before, so a place that one selector
    fits all later ones fit as well: only places that still fit are tested for the next, on
    maxima of windows by doubling, and the search ends where nothing fits.
    """
    out, fit = np.full(n, 15, np.int64), np.arange(n)
    maxima, size = width, 1
    levels = {1: width}
    for s in range(14, -1, -1):
        count = int(COUNTS[s])
        while size * 2 <= count:
            maxima, size = np.maximum(maxima[:-size], maxima[size:]), size * 2
            levels[size] = maxima
        most = np.maximum(levels[size][fit], levels[size][fit + count - size])
        fit = fit[most <= WIDTHS[s]]
        if not len(fit):
            break
        out[fit] = s
    return out


def encode_block(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, escaped positions, escaped ids) of up to BLOCK ids."""
    n = len(ids)
    value = ids.astype(np.uint64) + np.uint64(1)
    if n and value.max() < len(WIDTH_OF):
        width = WIDTH_OF[value]
    else:
        width = np.frexp(value.astype(np.float64))[1].astype(np.int8)
    tally = np.cumsum(np.bincount(width, minlength=61)[::-1])[::-1]  # ids at least so wide
    for limit in WIDTHS[2:]:
        if limit == 60 or tally[limit + 1] <= n * ESCAPE_SHARE:
            break
    at = np.flatnonzero(width > limit)
    value[at], width[at] = 0, 0
    value = np.append(value, np.zeros(COUNTS[0], np.uint64))
    choice = choices(np.append(width, np.zeros(COUNTS[0], np.int8)), n)
    step, i, starts = COUNTS[choice].tolist(), 0, []
    while i < n:
        starts.append(i)
        i += step[i]
    starts = np.array(starts, np.int64)
    chosen = choice[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        if s < 2:
            continue
        rows = np.flatnonzero(chosen == s)
        lane = np.arange(COUNTS[s])
        cells = value[starts[rows][:, None] + lane] << (lane * WIDTHS[s]).astype(np.uint64)
        words[rows] |= np.bitwise_or.reduce(cells, 1)
    return words, at, ids[at]


def decode_block(words: np.ndarray, n: int, at: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    """The ids again."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    begin = np.cumsum(counts) - counts
    value = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(chosen):
        if s < 2:
            continue
        rows = np.flatnonzero(chosen == s)
        lane = np.arange(COUNTS[s])
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        value[begin[rows][:, None] + lane] = (words[rows][:, None] >> (lane * WIDTHS[s]).astype(np.uint64)) & mask
    ids = (value[:n] - np.uint64(1)).astype("<u4")
    ids[at] = escaped
    return ids


def encode_page(ids: np.ndarray) -> dict:
    """Columns of a page for the ids of whole documents in a row."""
    parts = [encode_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    none = [np.zeros(0, np.uint64)]
    return {
        "n": len(ids),
        "block_words": np.cumsum([0] + [len(p[0]) for p in parts]).astype(np.int32),
        "words": np.concatenate(none + [p[0] for p in parts]).astype("<u8").tobytes(),
        "escape_counts": np.array([len(p[1]) for p in parts], np.int32),
        "escape_at": np.concatenate(none + [p[1] for p in parts]).astype("<u4").tobytes(),
        "escapes": np.concatenate(none + [p[2] for p in parts]).astype("<u4").tobytes(),
    }


def decode_page(n: int, block_words, words: bytes, escape_counts, escape_at: bytes, escapes: bytes):
    """All ids of a page."""
    words, at = np.frombuffer(words, "<u8"), np.frombuffer(escape_at, "<u4")
    escaped, e, out = np.frombuffer(escapes, "<u4"), 0, [np.zeros(0, "<u4")]
    for k, (a, b) in enumerate(zip(block_words[:-1], block_words[1:], strict=True)):
        f = e + int(escape_counts[k])
        out.append(decode_block(words[a:b], min(BLOCK, n - k * BLOCK), at[e:f], escaped[e:f]))
        e = f
    return np.concatenate(out)


def write_tokens(
    df: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = GPT_FILE,
    end_id: int = 2,
) -> None:
    """Write all documents in ascending ``doc_id`` order to token files below ``path``."""
    shared = vocabulary(df.sparkSession, tokenizer)
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = PAGES.format(kind=docs.schema["doc_id"].dataType.simpleString())
    docs = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    tail = np.array([end_id], np.uint32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks, part, page = ranks_of(shared), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, keys = text_list(batch["text"]), batch["doc_id"].astype(object).tolist()
            for a, b in bounded_groups([len(t) for t in texts], ENCODE_CHARS):
                ids, counts = bpe.encode(texts[a:b], ranks)
                ids, counts = np.insert(ids, np.cumsum(counts), tail), counts + 1
                ends = np.append(0, np.cumsum(counts))
                for c, d in bounded_groups(counts.tolist(), PAGE_IDS):
                    row = {"part": part, "page": page, "counts": counts[c:d]} | encode_page(ids[ends[c] : ends[d]])
                    row["doc_ids"] = [None if pd.isna(k) else k for k in keys[a + c : a + d]]
                    yield pd.DataFrame([row])[[c.split()[0] for c in schema.split(", ")]]
                    page += 1

    docs.mapInPandas(run, schema).write.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files alone."""
    pages = spark.read.parquet(path)
    parts = pages.groupBy("part").agg(F.sum("n").alias("n"))
    base = prefix_sums(parts, [], "part", "n", "base").select("part", "base")
    heads = pages.select("part", "page", "n")
    before = Window.partitionBy("part").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("inside", F.coalesce(F.sum("n").over(before), F.lit(0))).join(base, "part")
    first = heads.select("part", "page", (F.col("inside") + F.col("base")).alias("first"))
    few = first.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # else pages are shuffled
    rows = pages.join(F.broadcast(first) if few else first, ["part", "page"])
    kind = pages.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids = decode_page(r.n, r.block_words, r.words, r.escape_counts, r.escape_at, r.escapes)
                counts = np.asarray(r.counts, np.int64)
                stop = np.cumsum(counts)
                raw, cuts = ids.tobytes(), np.append(0, stop).tolist()
                out = pd.DataFrame({"doc_id": pd.Series(list(r.doc_ids), dtype=object)})
                out["start"], out["n_tokens"] = r.first + stop - counts, counts
                out["ids"] = [raw[4 * x : 4 * y] for x, y in zip(cuts, cuts[1:], strict=False)]
                yield out

    return rows.mapInPandas(run, f"doc_id {kind}, start long, n_tokens long, ids binary")
