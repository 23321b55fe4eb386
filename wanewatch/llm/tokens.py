"""Byte-level BPE over a DataFrame: ids, byte offsets behind every id, and the way back.

Cases: a null or empty text has no ids of its own (only ``end_id``, if given); a null id column
stays null; rows that repeat are encoded each on its own; an empty table gives an empty one.
Only ``keep`` columns pass through, so extra columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanewatch.llm import bpe
from wanewatch.llm.common import bounded_groups, kept, spread, text_list

GPT_FILE = public_tokenizers.path("byte_bpe_50k.json")
MULTI_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BATCH_CHARS = 1_000_000  # characters of texts encoded before rows are handed on


def vocabulary(spark, path: str):
    """The file's bytes as a broadcast (a vocabulary file has a few MB at most) and its kind."""
    with open(path, "rb") as file:
        data = file.read()
    return spark.sparkContext.broadcast((path.endswith(".json"), data))


def ranks_of(shared) -> bpe.Ranks:
    """Merge table of a broadcast vocabulary, built once per worker."""
    merges, data = shared.value
    make = bpe.Ranks.from_merges if merges else bpe.Ranks.from_ranks
    return kept(("bpe", zlib.crc32(data), len(data)), lambda: make(data))


def encoded(
    df: DataFrame,
    path: str,
    keep: list[str],
    text: str = "text",
    end_id: int | None = None,
    offsets: bool = False,
    queue: str | None = None,
) -> DataFrame:
    """``keep`` columns, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit).

    ``offsets`` adds ``ends``: the byte offset behind every id, same layout. ``queue`` names a
    string column; then ``block`` (the task) and ``before`` (ids of that queue earlier in the
    block) are added. Texts never cross; a text is encoded whole.
    """
    spark = df.sparkSession
    shared = vocabulary(spark, path)
    source = spread(df).select(*keep, F.col(text).alias("__text"))
    fields = [source.schema[c] for c in keep]
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if offsets:
        fields.append(T.StructField("ends", T.BinaryType()))
    if queue:
        fields += [T.StructField("block", T.LongType()), T.StructField("before", T.LongType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks, seen = ranks_of(shared), {}
        for batch in batches:
            texts = text_list(batch["__text"])
            for a, b in bounded_groups([len(t) for t in texts], BATCH_CHARS):
                ids, counts = bpe.encode(texts[a:b], ranks)
                stop = np.cumsum(counts)
                start = stop - counts
                tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
                raw = ids.astype("<u4").tobytes()
                out = batch.iloc[a:b].drop(columns="__text").copy()
                more = len(tail) // 4
                out["n_tokens"] = counts + more
                out["ids"] = [
                    raw[4 * x : 4 * y] + tail for x, y in zip(start.tolist(), stop.tolist(), strict=True)
                ]
                if offsets:
                    ends = np.cumsum(ranks.token_at[ids + 1] - ranks.token_at[ids])
                    out["ends"] = [
                        (ends[x:y] - (ends[x - 1] if x else 0)).astype("<u4").tobytes()
                        for x, y in zip(start.tolist(), stop.tolist(), strict=True)
                    ]
                if queue:
                    before = []
                    for q, n in zip(out[queue].tolist(), (counts + more).tolist(), strict=True):
                        before.append(seen.get(q, 0))
                        seen[q] = before[-1] + n
                    out["block"] = TaskContext.get().partitionId()
                    out["before"] = before
                yield out

    return source.mapInPandas(run, T.StructType(fields))


def decoded(df: DataFrame, path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """``keep`` columns and ``decoded``: the bytes that the ids stand for (null ids: empty)."""
    shared = vocabulary(df.sparkSession, path)
    source = df.select(*keep, F.col(ids).alias("__ids"))
    fields = [source.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = ranks_of(shared)
        for batch in batches:
            rows = [v or b"" for v in batch["__ids"].tolist()]
            for a, b in bounded_groups([len(r) for r in rows], BATCH_CHARS):
                ids = np.frombuffer(b"".join(rows[a:b]), "<u4")
                raw, ends = bpe.decode(ids, ranks)
                ends = np.append(0, ends)
                cuts = ends[np.cumsum([0] + [len(r) // 4 for r in rows[a:b]])].tolist()
                out = batch.iloc[a:b].drop(columns="__ids").copy()
                out["decoded"] = [raw[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]
                yield out

    return source.mapInPandas(run, T.StructType(fields))
