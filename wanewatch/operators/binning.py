"""Continuous target to classes: quantile, uniform and k-means edges."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanewatch.operators.order_stats import long_form, quantiles, running_before
from wanewatch.session import cut_lineage

# Fixed value: edges closer than this are merged.
EDGE_GAP = 1e-8


def bin_edges(
    df: DataFrame,
    column: str,
    n_bins: int = 5,
    strategy: str = "quantile",
    weight: str | None = None,
) -> list[float]:
    """The edges of the bins, first and last being the extremes of the column."""
    if strategy == "uniform":
        low, high = df.agg(F.min(column), F.max(column)).first()
        step = (high - low) / n_bins
        return [float(low + step * i) for i in range(n_bins)] + [float(high)]
    if strategy == "quantile":
        shares = [i / n_bins for i in range(n_bins + 1)]
        if weight is None:
            edges = quantiles(long_form(df, [column]), shares)[column]
        else:
            edges = _weighted_quantiles(df, column, weight, shares)
        kept = edges[:1]
        for edge in edges[1:]:
            if edge - kept[-1] > EDGE_GAP:
                kept.append(edge)
        return kept
    if strategy == "kmeans":
        low, high = df.agg(F.min(column), F.max(column)).first()
        points = df.where(F.col(column).isNotNull()).select(
            array_to_vector(F.array(F.col(column).cast("double"))).alias("features")
        )
        fitted = KMeans(k=n_bins, seed=42).fit(points)
        centres = sorted(float(c[0]) for c in fitted.clusterCenters())
        middles = [(a + b) / 2 for a, b in zip(centres, centres[1:])]
        return [float(low), *middles, float(high)]
    raise ValueError(f"unknown strategy: {strategy}")


def _weighted_quantiles(
    df: DataFrame, column: str, weight: str, shares: list[float]
) -> list[float]:
    """Smallest value whose cumulative weight reaches each share of the total.

    Weights are summed by value and written once; the running weight comes from a tree of
    range totals.
    """
    groups = cut_lineage(
        df.groupBy(F.col(column).cast("double").alias("x"))
        .agg(F.sum(F.col(weight).cast("double")).alias("w"))
        .where(F.col("x").isNotNull() & (F.col("w") > 0))
    )
    total = groups.agg(F.sum("w")).first()[0] or 0.0
    upto = running_before(groups, [], "x", ["w"]).withColumn("upto", F.col("before_w") + F.col("w"))
    tiny = total * 1e-12
    found = upto.agg(
        *[
            F.min(F.when(F.col("upto") >= F.lit(max(s * total - tiny, 0.0)), F.col("x")))
            for s in shares
        ]
    ).first()
    return [float(v) for v in found]


def bin_number(column: str, edges: list[float]) -> Column:
    """Left-closed bin of a value; values beyond the edges fall into the end bins."""
    x = F.col(column)
    number = F.lit(0)
    for edge in edges[1:-1]:
        number = number + (x >= F.lit(float(edge))).cast("int")
    return number


def to_classes(
    df: DataFrame, column: str, edges: list[float], encode: str = "ordinal"
) -> DataFrame:
    """Add ``<column>_bin``, or one 0/1 column per bin with ``encode='onehot'``."""
    number = bin_number(column, edges)
    if encode == "ordinal":
        return df.withColumn(f"{column}_bin", number)
    if encode == "onehot":
        bins = max(len(edges) - 1, 1)
        return df.withColumns(
            {f"{column}_bin_{i}": (number == i).cast("int") for i in range(bins)}
        )
    raise ValueError(f"unknown encoding: {encode}")
