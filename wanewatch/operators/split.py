"""Stratified splits, folds, undersampling and class weights.

Rows are ordered by a seeded 52-bit hash of their key. Exact splits find the hash at the
wanted ranks of each class (``order_stats``) and then filter, so nothing is sorted and no
class is gathered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanewatch.functions.scalars import HASH_SPAN, hash_int
from wanewatch.operators.order_stats import ranks_of

SEED = 42


def order_hash(key: str, seed: int = SEED) -> Column:
    return hash_int(seed, key)


def part_sizes(n: int, shares: list[float]) -> list[int]:
    """Rows per part: shares after the first are rounded half up, the first takes the rest."""
    rest = [math.floor(n * s + 0.5) for s in shares[1:]]
    return [n - sum(rest), *rest]


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    shares: dict[str, float],
    *,
    seed: int = SEED,
    exact: bool = True,
    name: str = "part",
) -> DataFrame:
    """Add the part of each row; class shares hold in every part.

    ``exact`` gives exact sizes per class with two extra passes; otherwise one hash
    threshold gives them in expectation with none.
    """
    parts = list(shares)
    h = order_hash(key, seed)
    if not exact:
        chosen, upto = F, 0.0
        for part in parts[:-1]:
            upto += shares[part]
            chosen = chosen.when(h < int(upto * HASH_SPAN), part)
        return df.withColumn(name, chosen.otherwise(parts[-1]))

    def bounds(_: str, n: int) -> list[int]:
        sizes = part_sizes(n, [shares[p] for p in parts])
        ends, total = [], 0
        for size in sizes[:-1]:
            total += size
            ends.append(total - 1)
        return ends

    return df.withColumn(name, _part_of(df, F.col(label).cast("string"), h, bounds, parts))


def _part_of(df: DataFrame, group: Column, h: Column, ends, parts: list) -> Column:
    """Part of a row: the first whose last rank in the class has a hash at or above ``h``.

    ``ends(class, size)`` lists the last rank of every part but the last; -1 is an empty part.
    """

    def wanted(g: str, n: int) -> list[int]:
        return [r for r in ends(g, n) if r >= 0]

    sizes, values = ranks_of(df.select(group.alias("g"), h.alias("x")).na.drop(), wanted)
    chosen = F.when(group.isNull(), F.lit(None))
    for g, n in sizes.items():
        inner = F.when(h.isNull(), F.lit(None))
        for part, rank in zip(parts, ends(g, n)):
            if rank >= 0:
                inner = inner.when(h <= values[g][rank], part)
        chosen = chosen.when(group == g, inner.otherwise(parts[-1]))
    return chosen


def folds(
    df: DataFrame,
    key: str,
    label: str,
    k: int = 5,
    *,
    seed: int = SEED,
    exact: bool = True,
    name: str = "fold",
) -> DataFrame:
    """Add a fold number 0..k-1 with equal class shares, exactly or in expectation."""
    h = order_hash(key, seed)
    if not exact:
        return df.withColumn(name, (h % k).cast("int"))

    def bounds(_: str, n: int) -> list[int]:
        return [(n * (i + 1)) // k - 1 for i in range(k - 1)]

    part = _part_of(df, F.col(label).cast("string"), h, bounds, list(range(k)))
    return df.withColumn(name, part.cast("int"))


def class_sizes(df: DataFrame, label: str) -> dict[str, int]:
    rows = df.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("string").alias("g"))
    return {r["g"]: r["n"] for r in rows.agg(F.count("*").alias("n")).collect()}


def undersample(
    df: DataFrame, key: str, label: str, *, seed: int = SEED, exact: bool = True
) -> DataFrame:
    """Keep as many rows of every class as the smallest one has, chosen by hash."""
    sizes = class_sizes(df, label)
    if not sizes:
        return df
    smallest = min(sizes.values())
    h = order_hash(key, seed)
    group = F.col(label).cast("string")
    keep = F
    if exact:
        pairs = df.select(group.alias("g"), h.alias("x")).na.drop()
        _, cuts = ranks_of(pairs, lambda _g, _n: [smallest - 1])
        for value, edges in cuts.items():
            keep = keep.when(group == value, h <= edges[smallest - 1])
    else:
        for value, n in sizes.items():
            keep = keep.when(group == value, h < int(smallest / n * HASH_SPAN))
    return df.where(keep)


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add n / (classes * size of the class)."""
    sizes = class_sizes(df, label)
    total, chosen = sum(sizes.values()), F
    for value, n in sizes.items():
        chosen = chosen.when(
            F.col(label).cast("string") == value, F.lit(total / (len(sizes) * n))
        )
    return df.withColumn(name, chosen)
