"""Search for the weights of a weighted vote, given stored base-model probabilities."""

from __future__ import annotations

from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.functions.scalars import ratio

# Weights tried for the first two of three models, limits of the third.
THREE_WAY = [0.2, 0.25, 0.3, 0.33, 0.35, 0.4, 0.45, 0.5]
THIRD_LOW, THIRD_HIGH = 0.1, 0.6
SIMPLEX_STEP = 20
CHUNK_CELLS = 4_000_000


def three_way_grid() -> list[tuple[float, ...]]:
    """Candidate weights of three models in search order."""
    triples = [(a, b, 1.0 - a - b) for a, b in product(THREE_WAY, repeat=2)]
    return [t for t in triples if THIRD_LOW <= t[2] <= THIRD_HIGH]


def simplex_grid(models: int, steps: int = SIMPLEX_STEP) -> list[tuple[float, ...]]:
    """All positive weights that are multiples of 1 / steps and add up to one."""
    return [
        tuple(w / steps for w in parts) + ((steps - sum(parts)) / steps,)
        for parts in product(range(1, steps), repeat=models - 1)
        if sum(parts) < steps
    ]


def score_candidates(
    df: DataFrame, label: str, probabilities: list[str], grid: list[tuple[float, ...]]
) -> DataFrame:
    """(candidate, tp, fp, fn, n) for each weight vector, in one pass.

    Every partition counts all candidates on its Arrow batches and emits one row per
    candidate; the sums of those rows are the answer. Rows with a NULL are left out.
    """
    weights = [np.array(column) for column in zip(*grid)]
    totals = reduce(np.add, weights)
    step = max(1, CHUNK_CELLS // len(grid))

    def count(batches):
        tp = np.zeros(len(grid), dtype=np.int64)
        fp, fn, n = tp.copy(), tp.copy(), 0
        for pdf in batches:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at : at + step]
                y = part[label].to_numpy() == 1
                mixed = np.zeros((len(part), len(grid)))
                for i, (name, w) in enumerate(zip(probabilities, weights)):
                    term = part[name].to_numpy(dtype=float)[:, None] * w[None, :]
                    mixed = term if i == 0 else mixed + term
                said = mixed / totals[None, :] > 0.5
                tp += (said & y[:, None]).sum(0)
                fp += (said & ~y[:, None]).sum(0)
                fn += (~said & y[:, None]).sum(0)
                n += len(part)
        yield pd.DataFrame(
            {"candidate": np.arange(len(grid)), "tp": tp, "fp": fp, "fn": fn, "n": n}
        )

    return (
        df.select(label, *probabilities)
        .na.drop()
        .mapInPandas(count, "candidate int, tp bigint, fp bigint, fn bigint, n bigint")
        .groupBy("candidate")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "n")])
    )


def weight_search(
    df: DataFrame,
    label: str,
    probabilities: list[str],
    grid: list[tuple[float, ...]] | None = None,
    metric: str = "accuracy",
) -> DataFrame:
    """One row per candidate: weights, accuracy, F1, and is_best.

    The best is the first candidate with the highest metric.
    """
    if grid is None:
        grid = three_way_grid() if len(probabilities) == 3 else simplex_grid(len(probabilities))
    names = [f"w_{c}" for c in probabilities]
    ddl = "candidate int, " + ", ".join(f"`{n}` double" for n in names)
    listed = df.sparkSession.createDataFrame([(i, *w) for i, w in enumerate(grid)], ddl)
    tp, fp, fn, n = (F.col(c) for c in ("tp", "fp", "fn", "n"))
    scored = score_candidates(df, label, probabilities, grid).select(
        "candidate",
        ratio(n - fp - fn, n).alias("accuracy"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
    # One entry per candidate of the grid, so the list has a fixed size.
    every = scored.agg(F.collect_list(F.struct("candidate", "accuracy", "f1")).alias("l"))
    top = F.array_max(
        F.transform(
            "l", lambda c: F.named_struct(F.lit("m"), c[metric], F.lit("c"), -c["candidate"])
        )
    )
    return (
        every.select((-top["c"]).alias("_best"), F.inline("l"))
        .join(F.broadcast(listed), "candidate")
        .select(
            "candidate",
            *names,
            "accuracy",
            "f1",
            (F.col("candidate") == F.col("_best")).alias("is_best"),
        )
    )


def best_weights(
    df: DataFrame,
    label: str,
    probabilities: list[str],
    grid: list[tuple[float, ...]] | None = None,
    metric: str = "accuracy",
) -> list[float]:
    """The weights of the best candidate; equal weights when no row can be scored."""
    rows = weight_search(df, label, probabilities, grid, metric).where("is_best").collect()
    if not rows or rows[0][metric] == 0.0:
        return [1.0 / len(probabilities)] * len(probabilities)
    return [rows[0][f"w_{c}"] for c in probabilities]


def optimise_weights(
    df: DataFrame,
    label: str,
    probabilities: list[str],
    metric: str = "f1",
    *,
    grid: list[tuple[float, ...]] | None = None,
    bounds: tuple[float, float] = (0.0, 1.0),
    passes: int = 20,
    finest: float = 1e-3,
) -> dict:
    """Weights within ``bounds`` that add up to one and score best, found by a pattern search.

    The first pass scores the grid; each later one scores, together, every transfer of a step,
    half and a quarter of it from one weight to another, around the best so far. A pass without
    a gain cuts the step to an eighth; below ``finest`` or after ``passes`` the search ends. The
    score of a vote is a step function of the weights, so differences stand in for gradients.

    Returns ``weights``, ``score``, ``grid_score`` and ``passes``. Rows that cannot be scored,
    or bounds that no vote meets, give equal weights and 0.
    """
    if metric not in ("accuracy", "f1"):
        raise ValueError(f"unknown metric: {metric}")
    size = len(probabilities)
    low, high = bounds
    grid = grid or (three_way_grid() if size == 3 else simplex_grid(size))
    tried = [w for w in grid if all(low - 1e-12 <= x <= high + 1e-12 for x in w)]
    even = (1.0 / size,) * size
    best, score, used, step = even, 0.0, 0, 1.0 / SIMPLEX_STEP
    grid_score = None
    while tried and used < passes:
        used += 1
        top, at = _best_candidate(score_candidates(df, label, probabilities, tried), metric)
        gained = top > score
        if gained:
            best, score = tried[at], top
        if grid_score is None:
            grid_score = score
            if score == 0.0:
                break
        elif not gained:
            step /= 8
        if step < finest:
            break
        tried = _transfers(best, step, low, high)
    return {"weights": list(best), "score": score, "grid_score": grid_score or 0.0, "passes": used}


def _best_candidate(counts: DataFrame, metric: str) -> tuple[float, int]:
    """Score and number of the first best candidate; one row per candidate reaches the driver."""
    top, first = 0.0, 0
    for row in sorted(counts.collect(), key=lambda r: r["candidate"]):
        wrong = row["fp"] + row["fn"]
        if metric == "f1":
            above, below = 2 * row["tp"], 2 * row["tp"] + wrong
        else:
            above, below = row["n"] - wrong, row["n"]
        value = above / below if below else 0.0
        if value > top:
            top, first = value, row["candidate"]
    return top, first


def _transfers(best: tuple, step: float, low: float, high: float) -> list[tuple[float, ...]]:
    """Moves of a step, half and a quarter of it between two weights, cut at the bounds."""
    found = []
    for part in (step, step / 2, step / 4):
        for i in range(len(best)):
            for j in range(len(best)):
                moved = min(part, best[i] - low, high - best[j])
                if i != j and moved > 0:
                    w = list(best)
                    w[i], w[j] = w[i] - moved, w[j] + moved
                    found.append(tuple(w))
    return list(dict.fromkeys(found))
