"""Quality classifier: n-gram indicators scaled by class log-count ratios, linear hinge loss.

Indicators of hashed word n-grams (1, 2) and character n-grams (1 to 4) are multiplied by the
log ratio of their class-conditional rates; every row is scaled by the root of its number of
n-grams; dual coordinate descent fits the hinge loss; the margin is calibrated to a chance.

Cases: a null or empty text has no n-gram and gets the chance of the bias alone; without
labelled rows of both classes every score is 0.5; repeated rows score alike; an empty table
gives an empty one; only ``keep`` columns of the input pass through.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanewatch.llm.common import bounded_groups, id_crc32, spread, text_bytes
from wanewatch.llm.sampling import calibrate, labelled_sample, sigmoid
from wanewatch.llm.words import char_grams, word_grams, word_hashes, words_of

BITS = 16
CHARS = (1, 2, 3, 4)
FAMILIES = 2 + len(CHARS)
BIAS = 1.0  # value of the constant feature
COST = 1.0
ROUNDS = 12
MOST = 3000  # labelled rows used
THRESHOLD = 0.3
BATCH_BYTES = 1_000_000


def indicators(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) once per text and bucket, without sorting: the last writer of a cell wins."""
    w = words_of(texts)
    buckets, docs = [], []
    grams = word_grams(w, word_hashes(w), BITS) + [char_grams(w, n, BITS) for n in CHARS]
    cell = np.zeros(1 << BITS, np.int32)
    for k, (bucket, doc) in enumerate(grams):
        edge = np.searchsorted(doc, np.arange(w.n_docs + 1))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            part = bucket[a:b]
            place = np.arange(b - a, dtype=np.int32)
            cell[part] = place
            only = part[cell[part] == place]
            buckets.append(only + (k << BITS))
        docs.append(np.arange(w.n_docs))
    counts = np.array([len(b) for b in buckets], np.int64)
    return (
        np.concatenate([np.zeros(0, np.int64), *buckets]),
        np.repeat(np.concatenate([np.zeros(0, np.int64), *docs]), counts),
    )


def log_ratios(bucket: np.ndarray, y_of: np.ndarray) -> np.ndarray:
    """Log ratio of a bucket's share among the indicators of either class, add-one smoothed."""
    size = FAMILIES << BITS
    good = 1.0 + np.bincount(bucket[y_of == 1], minlength=size)
    bad = 1.0 + np.bincount(bucket[y_of == 0], minlength=size)
    return (np.log(good / good.sum()) - np.log(bad / bad.sum())).astype(np.float32)


def fit(texts: list[bytes], y: np.ndarray) -> tuple[np.ndarray, float]:
    """(weight per bucket with the ratio multiplied in, bias), by dual coordinate descent."""
    parts, counts = [], []
    for a, b in bounded_groups([len(t) for t in texts], BATCH_BYTES):
        part, doc = indicators(texts[a:b])
        parts.append(part[np.argsort(doc, kind="stable")].astype(np.int32))
        counts.append(np.bincount(doc, minlength=b - a))
    bucket, count = np.concatenate(parts), np.concatenate(counts)
    ratio = log_ratios(bucket, np.repeat(y, count))
    edge = np.append(0, np.cumsum(count)).tolist()
    sign = np.where(y == 1, 1.0, -1.0)
    rows, values, norm = [], [], np.zeros(len(y))
    for i in range(len(y)):
        mine = bucket[edge[i] : edge[i + 1]]
        value = ratio[mine] / np.float32(np.sqrt(max(len(mine), 1)))
        rows.append(mine)
        values.append(value)
        norm[i] = float(value @ value) + BIAS**2
    weights, bias, alpha = np.zeros(FAMILIES << BITS, np.float32), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(11)
    for _ in range(ROUNDS):
        most = 0.0
        for i in rng.permutation(len(y)).tolist():
            gradient = sign[i] * (float(weights[rows[i]] @ values[i]) + bias * BIAS) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), COST)
            if (moved := new - alpha[i]) != 0:
                most = max(most, abs(gradient))
                weights[rows[i]] += np.float32(moved * sign[i]) * values[i]
                bias += moved * sign[i] * BIAS
                alpha[i] = new
        if most < 1e-3:
            break
    return weights * ratio, bias * BIAS


def margins(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    bucket, doc = indicators(texts)
    total = np.bincount(doc, weights[bucket], minlength=len(texts))
    return total / np.sqrt(np.maximum(np.bincount(doc, minlength=len(texts)), 1)) + bias


def train(docs: DataFrame, labels: DataFrame, most: int = MOST, where=None) -> dict | None:
    """The model; None without rows of both classes.

    ``where`` restricts the ids that may be learnt from. One task fits the bounded sample; a
    fifth of it, by crc32 of the id, only calibrates.
    """
    sample = labelled_sample(docs, labels, "quality", most, where).coalesce(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "y": []}), *batches])
        rows = rows.sort_values("doc_id")
        y = rows["y"].to_numpy(int)
        texts = [text_bytes(t) for t in rows["text"]]
        back = np.array([id_crc32(int(i)) // 5 % 5 == 0 for i in rows["doc_id"]], bool)
        for fold in (~back, back):
            if len(np.unique(y[fold])) < 2:
                return
        weights, bias = fit([t for t, b in zip(texts, back, strict=True) if not b], y[~back])
        held = [t for t, b in zip(texts, back, strict=True) if b]
        margin = [margins(held[a:b], weights, bias) for a, b in bounded_groups([len(t) for t in held], BATCH_BYTES)]
        slope, shift = calibrate(np.concatenate(margin), y[back])
        model = {"weights": weights, "bias": bias, "slope": slope, "shift": shift}
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    got = sample.mapInPandas(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else None


def score(docs: DataFrame, model: dict | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of every row plus ``score``, the chance of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of buckets
    shown = text in keep  # then it goes to the workers once
    source = spread(docs).select(*keep, *([] if shown else [F.col(text).alias("__text")]))
    name = text if shown else "__text"
    fields = [*(source.schema[c] for c in keep), T.StructField("score", T.DoubleType())]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_bytes(t) for t in batch[name].tolist()]
            for a, b in bounded_groups([len(t) for t in texts], BATCH_BYTES):
                chance, model = np.full(b - a, 0.5), shared.value
                if model:
                    margin = margins(texts[a:b], model["weights"], model["bias"])
                    chance = sigmoid(model["slope"] * margin + model["shift"])
                rest = batch.iloc[a:b][keep].copy()
                rest["score"] = chance
                yield rest

    return source.mapInPandas(run, T.StructType(fields))
