"""Quality rules: counts over the whole text, then a calibrated logistic regression.

Features are relative frequencies of hashed word n-grams (1, 2) and character n-grams (3, 5).
The model is fitted on at most ``most`` labelled rows, calibrated on a part of them it has not
seen, and scores Arrow batches of documents against fixed thresholds.

Cases: a null or empty text has no words and fails the base rule; without labelled rows of both
classes every text that passes the base rule is kept; repeated rows are judged alike; an empty
table gives an empty one; only ``keep`` columns of the input pass through.
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
from wanewatch.llm.words import (
    Words,
    char_grams,
    duplicate_lines,
    repeated_in_windows,
    word_grams,
    word_hashes,
    words_of,
)

BITS = 16  # hashed buckets of a family of n-grams
CHARS = (3, 5)
SCALE = 30.0  # relative frequencies are small; the penalty is meant for numbers near one
PENALTY = 1e-3
KEEP = 0.3  # least chance of good quality
MOST = 2000  # labelled rows used
MIN_WORDS, REPEAT_PERCENT = 50, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BATCH_BYTES = 1_000_000
VERDICT = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
           ("n_repeat_words", "long"), ("base_failed", "boolean"), ("chance", "double"), ("kept", "boolean")]


def families(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of every n-gram, family by family."""
    return word_grams(w, word_hashes(w), BITS) + [char_grams(w, n, BITS) for n in CHARS]


def sparse_rows(texts: list[bytes]):
    """(row, bucket, value) of the texts' features; buckets of all families in a row."""
    parts = []
    for a, b in bounded_groups([len(t) for t in texts], BATCH_BYTES):
        for k, (bucket, doc) in enumerate(families(words_of(texts[a:b]))):
            key, count = np.unique(doc.astype(np.int64) << BITS | bucket, return_counts=True)
            doc_of = key >> BITS
            total = np.bincount(doc_of, count, minlength=b - a)
            value = SCALE * count / total[doc_of]
            bucket = (key & ((1 << BITS) - 1)) + (k << BITS)
            parts.append(((doc_of + a).astype(np.int32), bucket.astype(np.int32), value.astype(np.float32)))
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def fit(texts: list[bytes], y: np.ndarray, rounds: int = 80) -> tuple[np.ndarray, float]:
    """(weights, bias) of the penalised logistic loss, by limited-memory quasi-Newton steps."""
    row, col, value = sparse_rows(texts)
    size = (2 + len(CHARS)) << BITS
    used = np.flatnonzero(np.bincount(col, minlength=size))
    place = np.zeros(size, np.int32)
    place[used] = np.arange(len(used))
    col = place[col]

    def loss(theta):
        margin = np.bincount(row, value * theta[:-1][col], minlength=len(y)) + theta[-1]
        p = sigmoid(margin)
        err = (p - y) / len(y)
        grad = np.append(np.bincount(col, value * err[row], minlength=len(used)), err.sum())
        grad[:-1] += PENALTY * theta[:-1]
        cost = np.logaddexp(0, np.where(y == 1, -margin, margin)).mean()
        return cost + PENALTY / 2 * (theta[:-1] ** 2).sum(), grad

    theta = np.zeros(len(used) + 1)
    cost, grad = loss(theta)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        step, alphas = grad.copy(), []
        for s, d, rho in reversed(past):
            alphas.append(rho * (s @ step))
            step -= alphas[-1] * d
        if past:
            s, d, _ = past[-1]
            step *= (s @ d) / (d @ d)
        for (s, d, rho), alpha in zip(past, reversed(alphas), strict=True):
            step += (alpha - rho * (d @ step)) * s
        rate = 1.0
        while rate > 1e-6:
            new, new_grad = loss(theta - rate * step)
            if new <= cost - 1e-4 * rate * (grad @ step):
                break
            rate /= 2
        else:
            break
        moved, turned = -rate * step, new_grad - grad
        gain = cost - new
        theta, cost, grad = theta + moved, new, new_grad
        if moved @ turned > 1e-12:
            past = [*past[-9:], (moved, turned, 1 / (moved @ turned))]
        if gain < 1e-6:
            break
    weights = np.zeros(size, np.float32)
    weights[used] = theta[:-1]
    return weights, float(theta[-1])


def margins(w: Words, weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(w.n_docs, bias)
    for k, (bucket, doc) in enumerate(families(w)):
        part = np.bincount(doc, weights[(k << BITS) + bucket], minlength=w.n_docs)
        out += SCALE * part / np.maximum(np.bincount(doc, minlength=w.n_docs), 1)
    return out


def train(docs: DataFrame, labels: DataFrame, most: int = MOST, where=None) -> dict | None:
    """The model as a dict of arrays and numbers; None without rows of both classes.

    One task fits it on the bounded sample; a fifth of the rows, by crc32 of the id, is kept
    back for the calibration.
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
        margin = [margins(words_of(held[a:b]), weights, bias) for a, b in bounded_groups([len(t) for t in held], BATCH_BYTES)]
        slope, shift = calibrate(np.concatenate(margin), y[back])
        model = {"weights": weights, "bias": bias, "slope": slope, "shift": shift, "rows": len(y)}
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    got = sample.mapInPandas(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else None


def judge(texts: list[bytes], model: dict | None, keep: float = KEEP) -> pd.DataFrame:
    """The rule columns of some texts."""
    w = words_of(texts)
    n_words = w.count()
    chars = ((w.data & 0xC0) != 0x80) & ~np.isin(w.data, [9, 10, 11, 12, 13, 32])
    repeats = np.bincount(w.doc[repeated_in_windows(w)], minlength=w.n_docs)
    failed = (n_words < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * n_words)
    chance = np.ones(w.n_docs)
    if model:
        margin = margins(w, model["weights"], model["bias"])
        chance = sigmoid(model["slope"] * margin + model["shift"])
    return pd.DataFrame(
        {
            "n_words": n_words, "word_chars": w.per_doc(chars), "n_symbols": w.per_doc(SYMBOLS[w.data]),
            "n_dup_lines": duplicate_lines(w), "n_repeat_words": repeats, "base_failed": failed,
            "chance": chance, "kept": ~failed & (chance >= keep),
        }
    )


def apply_rules(
    docs: DataFrame, model: dict | None, keep: list[str], text: str = "text", threshold: float = KEEP
) -> DataFrame:
    """``keep`` columns of every row plus the rule columns and the verdict ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of buckets
    shown = text in keep  # then it goes to the workers once
    source = spread(docs).select(*keep, *([] if shown else [F.col(text).alias("__text")]))
    name = text if shown else "__text"
    fields = [source.schema[c] for c in keep]
    fields += T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in VERDICT)).fields

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_bytes(t) for t in batch[name].tolist()]
            for a, b in bounded_groups([len(t) for t in texts], BATCH_BYTES):
                rules = judge(texts[a:b], shared.value, threshold)
                rest = batch.iloc[a:b][keep].reset_index(drop=True)
                yield pd.concat([rest, rules], axis=1)

    return source.mapInPandas(run, T.StructType(fields))
