"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of tokens. A window of ``size`` tokens gives each queue its share of the
target mixture; the fraction a queue could not spend stays as its deficit for the next window.
The tokens a queue has spent after w windows then follow from w alone (the whole part of its
share of the tokens handed out so far, leftovers by queue order), so a task computes its windows
without knowing what other tasks do: deficits are carried across windows and partitions, and no
token is shuffled. When a queue runs dry, the rest share its turn in proportion (a new phase).

Cases: a null or empty text is its end id alone; a null source is a queue of its own; a repeated
row is packed each time; an empty table gives no rows. The last window holds what is left.
With more than ``max_queues`` sources those without a weight share queues by hash. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.llm.common import prefix_sums, stored
from wanewatch.llm.tokens import GPT_FILE, encoded

BITS = 31  # resolution of the common clock of the queues
CELLS = 2_000_000  # windows times queues worked on at once
BROADCAST_ROWS = 200_000  # block offsets beyond this many rows are joined by shuffling


class Schedule:
    """Tokens each queue has spent when ``rank`` tokens have been handed out in all."""

    def __init__(self, totals: list[int], weights: list[float] | None = None):
        left = np.array(totals, np.int64)
        goal = left.astype(float) if weights is None else np.array(weights, float)
        self.phases: list[tuple[int, np.ndarray, np.ndarray]] = []
        rank, spent = 0, np.zeros(len(left), np.int64)
        while left.sum():
            active = (left > 0) & (goal > 0)
            if not active.any():  # only queues without a target are left: as they come
                goal, active = left.astype(float), left > 0
            if weights is None:
                take = left.copy()
            else:
                turns = np.full(len(left), np.inf)
                turns[active] = left[active] / goal[active]
                first = turns.min()
                take = np.where(active, np.minimum(np.floor(first * goal), left), 0).astype(np.int64)
                take[turns == first] = left[turns == first]
            self.phases.append((rank, spent.copy(), take))
            rank, spent, left = rank + int(take.sum()), spent + take, left - take
        self.total = rank
        self.starts = np.array([p[0] for p in self.phases], np.int64)

    @staticmethod
    def _share(clock: np.ndarray, take: np.ndarray) -> np.ndarray:
        high, low = take >> BITS, take & ((1 << BITS) - 1)
        return clock[:, None] * high + ((clock[:, None] * low) >> BITS)

    def spent(self, ranks: np.ndarray) -> np.ndarray:
        """(rank, queue) matrix; rows grow with the rank and sum to it."""
        ranks = np.minimum(np.asarray(ranks, np.int64), self.total)
        out = np.zeros((len(ranks), len(self.phases[0][1]) if self.phases else 0), np.int64)
        phase = np.searchsorted(self.starts, ranks, "right") - 1
        for k in np.unique(phase):
            rows = np.flatnonzero(phase == k)
            start, spent, take = self.phases[k]
            want = ranks[rows] - start
            low, high = np.zeros(len(rows), np.int64), np.full(len(rows), 1 << BITS, np.int64)
            while True:  # the last clock value at which no more than ``want`` is due
                middle = (low + high + 1) >> 1
                if (low == high).all():
                    break
                fits = self._share(middle, take).sum(1) <= want
                low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
            due = self._share(low, take)
            jump = self._share(np.minimum(low + 1, 1 << BITS), take) - due
            rest = (want - due.sum(1))[:, None] - (np.cumsum(jump, 1) - jump)
            out[rows] = spent + due + np.clip(rest, 0, jump)
        return out

    def bracket(self, queue: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) ranks: ``token`` of ``queue`` is handed out behind ``low``, by ``high``.

        A token of n falls due at the first clock value c with c * n >= token + 1 (in whole
        turns); up to then the queues have got c times all tokens, less than one each short.
        """
        low, high = np.zeros(len(queue), np.int64), np.zeros(len(queue), np.int64)
        for q in np.unique(queue):
            rows = np.flatnonzero(queue == q)
            marks = np.array([p[1][q] for p in self.phases])
            k = np.searchsorted(marks, token[rows], "right") - 1  # where it stands still, the later phase
            takes = np.array([p[2][q] for p in self.phases])[k]
            whole = np.array([p[2].sum() for p in self.phases], float)[k]
            due = self.starts[k] + (token[rows] - marks[k] + 1) / takes * whole
            step = whole / (1 << BITS) + 1
            low[rows] = np.floor(due - step - len(self.phases[0][1]))
            high[rows] = np.ceil(due + step)
        return np.maximum(low, 0), np.minimum(high, self.total)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first``, ``first + 1`` ... up to ``count`` values of each, in a row."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def candidates(queue, position, length, schedule: Schedule, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, window) of all windows that can hold a token of the document."""

    def span(q, begin, end):
        first = schedule.bracket(q, begin)[0] // size
        return first, np.maximum(schedule.bracket(q, end)[1] - 1, 0) // size - first + 1

    full = np.flatnonzero(length > 0)
    first, count = span(queue[full], position[full], (position + length)[full] - 1)
    # where tokens lie windows apart, only the windows around each of them
    thin = count > 4 * length[full]
    doc, window = np.repeat(full[~thin], count[~thin]), _ranges(first[~thin], count[~thin])
    if thin.any():
        few = full[thin]
        owner, token = np.repeat(few, length[few]), _ranges(position[few], length[few])
        first, count = span(queue[owner], token, token)
        pairs = np.unique(np.stack([np.repeat(owner, count), _ranges(first, count)], 1), axis=0)
        doc, window = np.append(doc, pairs[:, 0]), np.append(window, pairs[:, 1])
    return doc, window


def cut(queue, position, length, schedule: Schedule, size: int):
    """Pieces of documents: (document index, start, length, window, offset in the window)."""
    found = [[np.zeros(0, np.int64)] for _ in range(5)]
    pairs, held = candidates(queue, position, length, schedule, size) if len(queue) else (found[0][0],) * 2
    order = np.argsort(held, kind="stable")
    most = max(1, CELLS // max(1, 4 * len(schedule.phases[0][1]))) if len(order) else 1
    # the windows of a block are not more than ``most``
    block = (np.cumsum(np.diff(held[order], prepend=-1) != 0) - 1) // most
    edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1)).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        doc, window = pairs[order[a:b]], held[order[a:b]]
        windows = np.unique(np.concatenate([window, window + 1]))
        spent = schedule.spent(windows * size)
        row, q = np.searchsorted(windows, window), queue[doc]
        low = np.maximum(position[doc], spent[row, q])
        high = np.minimum((position + length)[doc], spent[row + 1, q])
        real = high > low
        doc, row, q, low, high = doc[real], row[real], q[real], low[real], high[real]
        # queues lie in a window one after the other
        filled = np.zeros_like(spent)
        inside = np.diff(spent, axis=0)
        filled[:-1] = np.cumsum(inside, 1) - inside
        offset = filled[row, q] + low - spent[row, q]
        for out, x in zip(found, (doc, low - position[doc], high - low, windows[row], offset), strict=True):
            out.append(x)
    doc, start, count, window, offset = map(np.concatenate, found)
    placed = np.bincount(doc, count, len(queue))
    if (placed != length).any():
        raise AssertionError(f"{int((placed != length).sum())} documents are not placed whole")
    order = np.lexsort((start, doc))
    return doc[order], start[order], count[order], window[order], offset[order]


def pack(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: int = 2048,
    weights: dict[str | None, float] | None = None,
    vocabulary: str = GPT_FILE,
    end_id: int = 1,
    max_queues: int = 4096,
) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids).

    ``weights`` are target proportions by source (default: those of the corpus, so all queues
    end together); a source without a weight comes last. ``ids`` are little-endian unsigned
    32-bit. Pieces of one ``sequence_id`` in the order of ``offset`` are a training sequence.
    """
    name = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source)))
    few = df.select(name.alias("q")).distinct().limit(max_queues + 1).count() <= max_queues
    named = {"" if k is None else f"={k}": v for k, v in (weights or {}).items()}
    shared = F.pmod(F.xxhash64(name), F.lit(max_queues)).cast("string")
    queue = name if few else F.when(name.isin(*named), name).otherwise(shared) if named else shared
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), queue.alias("queue"))
    tokens = stored(
        encoded(docs, vocabulary, ["doc_id", "queue"], end_id=end_id, queue="queue"), "pack-tokens"
    )
    blocks = tokens.groupBy("queue", "block").agg(F.sum("n_tokens").alias("n"))
    blocks = prefix_sums(blocks, ["queue"], "block", "n", "base")
    totals = sorted((r["queue"], r["n"]) for r in tokens.groupBy("queue").agg(F.sum("n_tokens").alias("n")).collect())
    goal = None if weights is None else [named.get(q, 0.0) for q, _ in totals]
    schedule = Schedule([n for _, n in totals], goal)
    number = {q: i for i, (q, _) in enumerate(totals)}
    few_blocks = blocks.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    offsets = blocks.select("queue", "block", "base")
    offsets = F.broadcast(offsets) if few_blocks else offsets
    placed = tokens.join(offsets, ["queue", "block"]).select(
        "doc_id", "queue", "n_tokens", "ids", (F.col("base") + F.col("before")).alias("position")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, "
        "offset long, ids binary"
    )
    rows_at_once = max(1, CELLS // max(1, 8 * len(totals)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            order = batch.sort_values("position", kind="stable") if len(batch) else batch
            for a in range(0, len(order), rows_at_once):
                part = order.iloc[a : a + rows_at_once]
                queues = part["queue"].map(number).to_numpy(np.int64)
                count = part["n_tokens"].to_numpy(np.int64)
                doc, start, length, window, offset = cut(
                    queues, part["position"].to_numpy(np.int64), count, schedule, size
                )
                ids = part["ids"].tolist()
                pieces = [
                    ids[d][4 * s : 4 * (s + n)]
                    for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)
                ]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].array.take(doc), "start": start, "length": length,
                        "doc_tokens": count[doc], "sequence_id": window, "offset": offset,
                        "ids": pieces,
                    }
                )

    return placed.mapInPandas(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids) with the pieces joined; a group holds at most one window."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda got, p: F.concat(got, p["ids"])).alias("ids")
    )
