"""Labelled rows for a classifier, bounded by a parameter, and the calibration of its margin."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most: int, where=None
) -> DataFrame:
    """(doc_id, text, y) of at most ``most`` labelled ids, chosen by a hash of the id.

    Ids without a label or with a null label are left out; of repeated labels the largest counts.
    The ids are few by the bound, so they are broadcast and documents are not shuffled.
    """
    rows = labels.select("doc_id", F.col(label).alias("y")).dropna()
    if where is not None:
        rows = rows.filter(where(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    chosen = rows.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(most)
    text = F.coalesce("text", F.lit("")).alias("text")
    one = docs.select("doc_id", text).join(F.broadcast(chosen), "doc_id")
    return one.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("y").alias("y"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, float)))


def calibrate(margin: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """(slope, shift) so that sigmoid(slope * margin + shift) is the chance of label 1.

    Newton steps on smoothed targets; the slope never turns the order around.
    """
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    goal = np.where(y == 1, high, low)
    a, b = 1.0, float(np.log(high / low) / 2) if len(y) else 0.0
    for _ in range(rounds):
        p = sigmoid(a * margin + b)
        g = np.array([((p - goal) * margin).sum() + 1e-3 * a, (p - goal).sum()])
        s = p * (1 - p)
        h = np.array([[(s * margin**2).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-3), float(b)
