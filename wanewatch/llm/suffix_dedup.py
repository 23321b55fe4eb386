"""Exact repeats of ``SPAN`` bytes, by longest previous factors over sampled suffixes.

A byte goes if it lies in a string of ``SPAN`` bytes that also starts earlier in the order of
(doc_id, start). Sorting all suffixes would cost many times the corpus, so suffixes are sampled
without losing a repeat:

1. Every window of ``SPAN`` bytes contains the seeds (``SEED`` bytes each) at ``WINDOW``
   positions; those with the smallest hash of a window are its anchors. Equal windows have equal
   anchors, so a repeat shows as a repeated anchor. About 3 of 100 positions are anchors.
2. Anchors whose seed occurs once are dropped. The others get their context: all bytes that a
   window around the seed can reach.
3. Occurrences of a seed are put in suffix order of what follows and, mirrored, of what stands
   before. Previous and next smaller positions in that order give the longest match with an
   earlier occurrence (LPF) to the right and to the left; where both reach far enough, the two
   orders' classes decide for every offset whether one earlier occurrence matches all of it.

A seed that very many places share is refined by the bytes to its left or right half a reach
long (a window covers one of the two), and if that is shared by very many too, its windows are
counted by 128-bit hash with partial aggregation. Whole-text copies are settled before by
128-bit hash: all their bytes start earlier. No task ever holds an unbounded group.

Cases: a null or empty text has no bytes; texts below ``SPAN`` bytes never lose any; rows with
the same id and text are one document and judged alike; a null id comes first in the order; an
empty table gives no rows. Output: the ``keep`` columns, ``kept`` (bytes), ``n_bytes``,
``n_removed`` and ``spans`` (start and end of every removed run). Ids are integers; ``keep`` may
hold any names but these four.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanewatch.llm.common import bounded_groups, spread, stored, text_bytes

SPAN, SEED = 100, 32
WINDOW = SPAN - SEED + 1
REACH = SPAN - SEED  # bytes a window can hold on either side of the seed
HALF = REACH // 2
HOT = 10_000  # occurrences of a key (about 3 MB of context) beyond which it is refined
LOCAL_HOT = 64  # occurrences within one task that mark a key as hot at once
BATCH_BYTES = 1_000_000
BROADCAST_BYTES = 24 << 20
TOP = np.uint64(2**64 - 1)
FIRST = -(1 << 63)


def seed_hashes(raw: bytes) -> np.ndarray:
    """Hash of the SEED bytes from every position (the last ones see zeros)."""
    n = len(raw)
    view = np.ndarray((n + SEED,), "<u8", raw + b"\0" * (SEED + 8), 0, (1,))
    a = view * np.uint64(0x9E3779B97F4A7C15)
    a ^= a >> np.uint64(32)
    b = a[:-8] * np.uint64(0xC2B2AE3D27D4EB4F) + a[8:]
    b ^= b >> np.uint64(29)
    c = b[:-16] * np.uint64(0x165667B19E3779F9) + b[16:]
    c = (c ^ (c >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (c ^ (c >> np.uint64(32)))[:n]


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, position, 48-bit seed hash) of all anchors."""
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = b"".join(texts)
    if len(raw) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    stop = np.cumsum(sizes)
    start = stop - sizes
    h = seed_hashes(raw)
    for k in range(1, SEED):  # seeds that cross into the next text
        at = stop - k
        h[at[at >= start]] = TOP
    low = _slide(h, WINDOW, np.minimum)
    edge = np.zeros(WINDOW - 1, np.uint64)
    chosen = _slide(np.concatenate([edge, low, edge]), WINDOW, np.maximum) == h
    at = np.flatnonzero(chosen & (h != TOP))
    doc = np.searchsorted(stop, at, "right")
    long = sizes[doc] >= SPAN
    doc, at = doc[long], at[long]
    return doc, at - start[doc], (h[at] >> np.uint64(16)).astype(np.int64)


def lpf(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, lcp, longest previous factor) of rows whose index is their place in the text order.

    ``words`` holds a row's bytes. ``lcp[k]`` is the common prefix of the k-th row in suffix
    order with the one before; rows of different groups have none (-1).
    """
    n, width = words.shape
    pad = -width % 8
    digits = np.ascontiguousarray(np.pad(words, ((0, 0), (0, pad)))).view(">u8").astype(np.uint64)
    order = np.lexsort((*digits.T[::-1], group))
    near = words[order]
    differs = near[1:] != near[:-1]
    lcp = np.full(n + 1, -1, np.int64)
    lcp[1:n] = np.where(differs.any(1), differs.argmax(1), width)
    ranked = group[order]
    lcp[1:n][ranked[1:] != ranked[:-1]] = -1
    best = [-1] * n
    stack: list[tuple[int, int]] = []  # (row, lcp with the entry below), rows growing
    for row, common in zip(order.tolist(), lcp[:n].tolist(), strict=True):
        reach = common
        while stack and stack[-1][0] > row:
            top, below = stack.pop()
            # the popped row's next smaller row is this one; its previous smaller was below it
            best[top] = max(best[top], reach)
            reach = min(reach, below)
        if stack:
            best[row] = max(best[row], reach)
        stack.append((row, reach))
    return order, lcp, np.array(best, np.int64)


def _classes(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """Number of the class of rows that agree in their group and first ``depth`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp[: len(order)] < depth)
    return out


def repeated(key, place, left_size, right_size, left, right, low, high):
    """(smallest, largest) offset of the seed in a repeated window; -1 where there is none.

    Rows come in text order within their key; ``place`` grows along it and is equal for rows
    of which none is earlier. ``left`` is mirrored. Only offsets from ``low`` to ``high`` are
    asked for.
    """
    n = len(key)
    least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    if not n:
        return least, most
    r_order, r_lcp, r_lpf = lpf(key, right)
    l_order, l_lcp, l_lpf = lpf(key, left)
    r_lpf, l_lpf = np.minimum(r_lpf, right_size), np.minimum(l_lpf, left_size)
    for i in range(REACH + 1):
        j = REACH - i
        asked = (low <= i) & (i <= high) & (l_lpf >= i) & (r_lpf >= j)
        if not asked.any():
            continue
        inside = np.flatnonzero((left_size >= i) & (right_size >= j))
        pair = _classes(r_order, r_lcp, j)[inside] * np.int64(n + 1) + _classes(l_order, l_lcp, i)[inside]
        _, first, which = np.unique(pair, return_index=True, return_inverse=True)
        hit = inside[place[inside] > place[inside[first[which]]]]
        hit = hit[asked[hit]]
        least[hit[least[hit] < 0]] = i
        most[hit] = i
    return least, most


def _matrix(parts: list[bytes], width: int) -> np.ndarray:
    out = b"".join(p.ljust(width, b"\0") for p in parts)
    return np.frombuffer(out, np.uint8).reshape(len(parts), width)


def _whole(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """All rows of a partition: rows of bounded size, as many as a shuffle partition has."""
    parts = [b for b in batches if len(b)]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()


def recurring(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of keys that a partition (all rows of its keys) has more than once, with the count."""
    rows = _whole(batches)
    if len(rows):
        _, which, count = np.unique(rows["key"].to_numpy(), return_inverse=True, return_counts=True)
        rows["n"] = count[which]
        rows = rows[rows["n"] > 1]
        for a in range(0, len(rows), 10_000):
            yield rows.iloc[a : a + 10_000]


PLACE = "pos long, tag long, at int"
CONTEXT = f"key long, low int, high int, {PLACE}, before binary, after binary"


def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Removed runs (pos, tag, start, stop) of a partition that has all rows of its keys."""
    rows = _whole(batches)
    if not len(rows):
        return
    rows = rows.sort_values(["key", "pos", "at"], kind="stable").reset_index(drop=True)
    edge = np.flatnonzero(np.diff(rows["key"].to_numpy(), prepend=np.nan, append=np.nan) != 0)
    sizes = np.diff(edge).tolist()
    for x, y in bounded_groups(sizes, 50_000):
        part = rows.iloc[edge[x] : edge[y]]
        before, after = part["before"].tolist(), part["after"].tolist()
        place = np.cumsum((part[["pos", "at"]].diff() != 0).any(axis=1).to_numpy())
        least, most = repeated(
            part["key"].to_numpy(), place, np.array([len(b) for b in before]), np.array([len(a) for a in after]),
            _matrix(before, REACH), _matrix(after, REACH),
            part["low"].to_numpy(), part["high"].to_numpy(),
        )
        hit = most >= 0
        at = part["at"].to_numpy()[hit].astype(np.int64)
        yield pd.DataFrame(
            {"pos": part["pos"].to_numpy()[hit], "tag": part["tag"].to_numpy()[hit],
             "start": at - most[hit], "stop": at - least[hit] + SPAN}
        )


def refine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keys of seed and half a reach on either side; a window covers one of the two."""
    for batch in batches:
        for side, low, high in (("before", HALF, REACH), ("after", 0, HALF)):
            part = batch[batch[side].map(len) >= HALF].copy()
            part["key"] = [
                xxhash.xxh64_intdigest(b[:HALF], seed=k & 0xFFFFFFFF) - (1 << 63)
                for k, b in zip((part["key"] * 2 + (side == "after")).tolist(), part[side].tolist(), strict=True)
            ]
            part["low"], part["high"] = low, high
            yield part


def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every asked window of a row as a 128-bit hash."""
    for batch in batches:
        for a in range(0, len(batch), 500):
            out = []
            for r in batch.iloc[a : a + 500].itertuples(index=False):
                whole = r.before[::-1] + r.seed + r.after
                for i in range(max(r.low, REACH - len(r.after)), min(r.high, len(r.before)) + 1):
                    x = len(r.before) - i
                    d = xxhash.xxh3_128_intdigest(whole[x : x + SPAN])
                    out.append(((d >> 64) - (1 << 63), (d & (2**64 - 1)) - (1 << 63), r.pos, r.tag, r.at - i))
            yield pd.DataFrame(out, columns=["w1", "w2", "pos", "tag", "start"])


def _sized(df: DataFrame, row_bytes) -> DataFrame:
    """``df`` marked for broadcast if the sum of ``row_bytes`` over its rows stays in the bound."""
    total = df.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def removed_runs(docs: DataFrame) -> DataFrame:
    """(pos, tag, runs) for documents (pos, tag, text) without whole-text copies.

    ``runs`` lists (start, stop) of repeats; they may overlap.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_bytes(t) for t in batch["text"].tolist()]
            pos, tag = batch["pos"].to_numpy(), batch["tag"].to_numpy()
            for a, b in bounded_groups([len(t) for t in texts], BATCH_BYTES):
                doc, at, key = anchors(texts[a:b])
                yield pd.DataFrame({"key": key, "pos": pos[a:b][doc], "tag": tag[a:b][doc], "at": at})

    found = stored(docs.select("pos", "tag", "text").mapInPandas(find, f"key long, {PLACE}"), "lpf-anchors")

    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = _whole(batches)
        if len(keys):
            key, count = np.unique(keys["key"].to_numpy(), return_counts=True)
            yield pd.DataFrame({"key": key[count >= LOCAL_HOT]})

    hot_keys = stored(found.select("key").mapInPandas(frequent, "key long").distinct(), "lpf-hot-keys")
    hot = _sized(hot_keys, F.lit(16))
    usual = found.join(hot, "key", "left_anti").repartition("key").mapInPandas(recurring, f"key long, {PLACE}, n long")
    often = found.join(hot, "key").select("key", "pos", "tag", "at", F.lit(HOT + 1).cast("long").alias("n"))
    again = usual.select("key", "pos", "tag", "at", "n").union(often)
    by_doc = stored(
        again.groupBy("pos", "tag").agg(F.collect_list(F.struct("at", "key", "n")).alias("marks")), "lpf-marks"
    )

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for pos, tag, text, marks in zip(batch["pos"], batch["tag"], batch["text"], batch["marks"], strict=True):
                body = text_bytes(text)
                for m in marks:
                    at, end = m["at"], m["at"] + SEED
                    before, after = body[max(0, at - REACH) : at][::-1], body[end : end + REACH]
                    if len(before) + len(after) >= REACH:
                        hot, c1, c2 = m["n"] > HOT, 0, 0
                        if hot:
                            d = xxhash.xxh3_128_intdigest(body[at - len(before) : end + len(after)], len(before))
                            c1, c2 = (d >> 64) - (1 << 63), (d & (2**64 - 1)) - (1 << 63)
                        out.append((m["key"], 0, REACH, pos, tag, at, before, after, hot, body[at:end], c1, c2))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    names = [c.split()[0] for c in CONTEXT.split(", ")] + ["hot", "seed", "c1", "c2"]
    marks = _sized(by_doc, 64 + 48 * F.size("marks"))
    placed = docs.select("pos", "tag", "text").join(marks, ["pos", "tag"])
    rows = stored(placed.mapInPandas(contexts, f"{CONTEXT}, hot boolean, seed binary, c1 long, c2 long"), "lpf-contexts")
    columns = [c.split()[0] for c in CONTEXT.split(", ")]
    run = "pos long, tag long, start long, stop long"
    runs = rows.filter("not hot").select(*columns).repartition("key").mapInPandas(settle, run)
    # hot seeds: of equal contexts, known by 128 bits, only the first can be new; refine those
    shared = rows.filter("hot")
    first = stored(
        shared.groupBy("c1", "c2").agg(F.min(F.struct("pos", "at", "tag", *columns[:3], "before", "after", "seed")).alias("f"))
        .select("c1", "c2", "f.*"),
        "lpf-first",
    )
    heads = first.select("c1", "c2", F.col("pos").alias("first_pos"), F.col("at").alias("first_at"))
    copies = shared.select(
        "c1", "c2", "pos", "tag", "at", (F.col("at") - F.length("before")).cast("long").alias("start"),
        (F.col("at") + SEED + F.length("after")).cast("long").alias("stop"),
    ).join(heads, ["c1", "c2"]).filter("pos > first_pos or at > first_at")
    runs = runs.union(copies.select("pos", "tag", "start", "stop"))
    finer = stored(first.select(*columns, "seed").mapInPandas(refine, f"{CONTEXT}, seed binary"), "lpf-finer")
    sizes = finer.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    finer = finer.join(sizes, "key")
    runs = runs.union(
        finer.filter(F.col("n") <= HOT).select(*columns).repartition("key").mapInPandas(settle, run)
    )
    dense = finer.filter(F.col("n") > HOT).select(*columns, "seed").mapInPandas(
        windows, "w1 long, w2 long, pos long, tag long, start long"
    )
    firsts = dense.groupBy("w1", "w2").agg(F.min(F.struct("pos", "start")).alias("first"), F.count("*").alias("n"))
    later = dense.join(firsts.filter("n > 1"), ["w1", "w2"]).filter(
        (F.col("pos") > F.col("first.pos")) | ((F.col("pos") == F.col("first.pos")) & (F.col("start") > F.col("first.start")))
    )
    runs = runs.union(later.select("pos", "tag", "start", F.col("start") + SPAN))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            joined = [[{"start": a, "stop": b} for a, b in merge_runs(r, 1 << 62).tolist()] for r in batch["runs"]]
            yield batch.assign(runs=joined)

    by_doc = runs.groupBy("pos", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    return by_doc.mapInPandas(merge, "pos long, tag long, runs array<struct<start:long,stop:long>>")


def merge_runs(runs, size: int) -> np.ndarray:
    """Sorted disjoint (start, stop) rows that cover the same bytes; touching runs are one."""
    pairs = np.array([(r["start"], r["stop"]) for r in runs], np.int64).reshape(-1, 2)
    pairs = np.clip(pairs[np.argsort(pairs[:, 0], kind="stable")], 0, size)
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.append(True, pairs[1:, 0] > reach[:-1]) if len(pairs) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return np.stack([pairs[at, 0], reach[np.append(at[1:], len(pairs)) - 1]], 1) if len(at) else pairs


def remove_repeats(
    df: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", as_text: bool = False
) -> DataFrame:
    """``keep`` columns, ``kept``, ``n_bytes``, ``n_removed``, ``spans`` of every row.

    ``as_text`` returns ``kept`` as a string; what a cut leaves of a character is dropped.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    place = [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST)).alias("pos"),
        F.xxhash64(body).alias("tag"),
    ]
    source = spread(df)
    small = source.select(*place, F.xxhash64(F.lit(1), body).alias("tag2"), F.octet_length(body).alias("n"))
    small = stored(small.filter(F.col("n") >= SPAN), "lpf-texts")
    first = small.groupBy("tag", "tag2").agg(F.min("pos").alias("first"), F.count("*").alias("c")).filter("c > 1")
    copies = stored(
        small.join(first, ["tag", "tag2"]).filter("pos > first").select("pos", "tag").distinct(), "lpf-copies"
    )
    docs = source.select(*place, body.alias("text"))
    fresh = docs.filter(F.octet_length("text") >= SPAN).join(_sized(copies, F.lit(24)), ["pos", "tag"], "left_anti")
    # rows of the same place and text are one document: no string of one starts before the other's
    again = small.groupBy("pos", "tag").agg(F.count("*").alias("c")).filter("c > 1").select("pos", "tag")
    again = stored(again, "lpf-again")
    if not again.isEmpty():
        once = _sized(again, F.lit(24))
        twice = fresh.join(once, ["pos", "tag"], "left_semi").groupBy("pos", "tag").agg(F.first("text").alias("text"))
        fresh = fresh.join(once, ["pos", "tag"], "left_anti").unionByName(twice)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(1 << 62).alias("stop")))
    runs = removed_runs(fresh).union(copies.select("pos", "tag", whole.alias("runs")))
    runs = _sized(stored(runs, "lpf-runs"), 64 + 48 * F.size("runs"))
    # prefixed, as ``keep`` may have columns of any name
    rows = source.select(*keep, place[0].alias("__pos"), place[1].alias("__tag"), body.alias("__text"))
    rows = rows.join(runs.withColumnsRenamed({"pos": "__pos", "tag": "__tag", "runs": "__runs"}), ["__pos", "__tag"], "left")
    rows = rows.select(*keep, "__text", "__runs")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    fields = [rows.schema[c] for c in keep] + [
        T.StructField("kept", T.StringType() if as_text else T.BinaryType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("spans", span),
    ]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.drop(columns=["__text", "__runs"])
            kept, size, gone, spans = [], [], [], []
            for text, runs in zip(batch["__text"].tolist(), batch["__runs"].tolist(), strict=True):
                body, edges = text_bytes(text), []
                if runs is not None:
                    edges = merge_runs(runs, len(text_bytes(text))).tolist()
                at, parts = 0, []
                for a, b in edges:
                    parts.append(body[at:a])
                    at = b
                kept.append(b"".join([*parts, body[at:]]) if edges else body)
                size.append(len(body))
                gone.append(len(body) - len(kept[-1]))
                spans.append([{"start": a, "stop": b} for a, b in edges])
            if as_text:
                kept = [k.decode("utf-8", "ignore") for k in kept]
            yield out.assign(kept=kept, n_bytes=size, n_removed=gone, spans=spans)

    return rows.mapInPandas(cut, T.StructType(fields))
