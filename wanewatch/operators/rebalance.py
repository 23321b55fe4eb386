"""Class rebalancing of a training set: synthetic rows, adaptive synthetic rows, undersampling.

Rows carry (key bigint, label, vector array<double>). Apply to the training part only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanewatch.functions.scalars import hash_int, hash_unit
from wanewatch.operators.neighbors import nearest
from wanewatch.operators.order_stats import ranks_of
from wanewatch.operators.split import SEED, class_sizes, order_hash, undersample
from wanewatch.session import cut_lineage

NEIGHBORS = 5
STRATEGIES = ("SMOTE", "ADASYN", "undersample")

# ``neighbors.nearest`` or ``neighbor_graph.nearest_by_graph``, which take the same arguments.
Search = Callable[..., DataFrame]


def smote_quota(df: DataFrame, key: str, label: str, seed: int = SEED) -> DataFrame:
    """(id, label, copies): synthetic rows each original has to produce.

    A class short of the largest by D over n rows gives every row D // n copies and one more
    to the D % n rows with the smallest hash.
    """
    sizes = class_sizes(df, label)
    largest = max(sizes.values())
    short = {g: largest - n for g, n in sizes.items() if n < largest}
    h, group = order_hash(key, seed), F.col(label).cast("string")
    extra = {g: short[g] % sizes[g] for g in short}
    pairs = df.select(group.alias("g"), h.alias("x")).where(
        F.col("g").isin([g for g in extra if extra[g]])
    )
    _, edges = ranks_of(pairs, lambda g, _n: [extra[g] - 1])
    copies: Column = F.lit(0)
    for g, missing in short.items():
        more = (h <= edges[g][extra[g] - 1]).cast("int") if extra[g] else F.lit(0)
        copies = F.when(group == g, F.lit(missing // sizes[g]) + more).otherwise(copies)
    return df.select(
        F.col(key).alias("id"), F.col(label).alias("label"), copies.alias("copies")
    ).where(F.col("copies") > 0)


def synthesise(
    df: DataFrame,
    key: str,
    vector: str,
    quota: DataFrame,
    neighbors: DataFrame,
    seed: int = SEED,
) -> DataFrame:
    """(id, label, copy, neighbor, share, vector): points between a row and a neighbour.

    The neighbour and the share of the way come from a hash of (row, copy). Every step is an
    equi-join on a row key.
    """
    neighbors = cut_lineage(neighbors)  # read twice
    available = neighbors.groupBy("id").agg(F.max("rank").alias("available"))
    drawn = (
        quota.join(available, "id")
        .withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
        .select(
            "id",
            "label",
            "copy",
            (hash_int(F.lit(f"{seed}n"), "id", "copy") % F.col("available") + 1)
            .cast("int")
            .alias("rank"),
            hash_unit(F.lit(f"{seed}u"), "id", "copy").alias("share"),
        )
    )
    points = df.select(
        F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("base")
    )
    others = points.select(F.col("id").alias("neighbor"), F.col("base").alias("other"))
    between = F.zip_with("base", "other", lambda a, b: a + F.col("share") * (b - a))
    return (
        drawn.join(neighbors.select("id", "rank", "neighbor"), ["id", "rank"])
        .join(points, "id")
        .join(others, "neighbor")
        .select("id", "label", "copy", "neighbor", "share", between.alias("vector"))
    )


def smote(
    df: DataFrame, key: str, label: str, vector: str, *, k: int = NEIGHBORS, seed: int = SEED,
    search: Search = nearest,
) -> DataFrame:
    """Synthetic rows that raise every smaller class to the size of the largest.

    ``search`` finds the neighbours; large tables take ``nearest_by_graph``.
    """
    sizes = class_sizes(df, label)
    largest = max(sizes.values())
    small = [g for g, n in sizes.items() if n < largest]
    if any(sizes[g] < 2 for g in small):
        raise ValueError("a class with one row has no neighbours to interpolate")
    minority = df.where(F.col(label).cast("string").isin(small))
    near = search(minority, key, vector, k, group=label)
    return synthesise(minority, key, vector, smote_quota(df, key, label, seed), near, seed)


def adasyn(
    df: DataFrame, key: str, label: str, vector: str, *, k: int = NEIGHBORS, seed: int = SEED,
    search: Search = nearest,
) -> DataFrame:
    """Like ``smote`` for two classes, but rows among majority neighbours produce more.

    Falls back to ``smote`` when no minority row has a majority neighbour.
    """
    sizes = class_sizes(df, label)
    if len(sizes) != 2:
        raise ValueError("adasyn needs two classes")
    rare = min(sizes, key=lambda g: (sizes[g], g))
    missing = max(sizes.values()) - sizes[rare]
    is_rare = F.col(label).cast("string") == rare
    labels = df.select(
        F.col(key).alias("neighbor"), (~is_rare).cast("int").alias("is_common")
    )
    minority = df.where(is_rare)
    # written once, as the total, the test for copies and the quota all read it
    around = cut_lineage(
        search(df, key, vector, k)
        .join(minority.select(F.col(key).alias("id")), "id", "left_semi")
        .join(labels, "neighbor")
        .groupBy("id")
        .agg(F.avg("is_common").alias("hardness"))
    )
    total = around.agg(F.sum("hardness")).first()[0]
    if sizes[rare] < 2 or not total:
        return smote(df, key, label, vector, k=k, seed=seed, search=search)
    quota = around.withColumn(
        "copies", F.bround(F.col("hardness") / F.lit(total) * missing).cast("int")
    ).where(F.col("copies") > 0)
    if quota.isEmpty():  # every share rounds to nothing
        return smote(df, key, label, vector, k=k, seed=seed, search=search)
    quota = (
        quota
        .join(minority.select(F.col(key).alias("id"), F.col(label).alias("label")), "id")
    )
    near = search(minority, key, vector, k)
    return synthesise(minority, key, vector, quota, near, seed)


def rebalance(
    df: DataFrame, key: str, label: str, vector: str, strategy: str | None, seed: int = SEED,
    search: Search = nearest,
) -> DataFrame:
    """Originals plus synthetic rows, or fewer originals; any other strategy changes nothing.

    Returns (key, label, vector, copy); ``copy`` is 0 for originals.
    """
    rows = df.select(key, label, F.col(vector).cast("array<double>").alias(vector))
    if strategy == "undersample":
        return undersample(rows, key, label, seed=seed).withColumn("copy", F.lit(0))
    originals = rows.withColumn("copy", F.lit(0))
    if strategy not in STRATEGIES:
        return originals
    make = smote if strategy == "SMOTE" else adasyn
    made = make(rows, key, label, vector, seed=seed, search=search)
    return originals.unionByName(
        made.select(
            F.col("id").alias(key),
            F.col("label").alias(label),
            F.col("vector").alias(vector),
            "copy",
        )
    )
