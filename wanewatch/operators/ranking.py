"""Latest, newest-k, running best and ranking operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.session import lookup_join

# Epochs per running-best block; blocks bound the window of one very long experiment.
EPOCHS_PER_BLOCK = 1_000


def newest(df: DataFrame, n: int, order: list[str], by: list[str] | None = None) -> DataFrame:
    """The last ``n`` rows by the ordering columns, overall or per group.

    Overall it is a top-n; per group each task first keeps its own n best.
    """
    if not by:
        return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    w = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, by: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """One row per group: the columns of its newest row."""
    picked = F.max_by(F.struct(*cols), F.struct(*order)).alias("r")
    return df.groupBy(*by).agg(picked).select(*by, "r.*")


def retention(df: DataFrame, by: list[str], order: str, keep: int, name: str = "kept") -> DataFrame:
    """Mark the newest ``keep`` rows of each group; ``order`` is unique within a group.

    Only the newest rows are ranked; the oldest order value still kept is then compared
    with every row.
    """
    edge = newest(df.select(*by, order), keep, [order], by).groupBy(*by).agg(
        F.min(order).alias("_edge")
    )
    return (
        lookup_join(df, edge, by, "left")
        .withColumn(name, F.col(order) >= F.col("_edge"))
        .drop("_edge")
    )


def running_best(
    df: DataFrame,
    by: str,
    epoch: str,
    metric: str,
    mode: str = "max",
    block: int = EPOCHS_PER_BLOCK,
) -> DataFrame:
    """Add previous_best and is_best (strict improvement); rows without the metric are left out.

    Epochs are cut into blocks. The best of earlier blocks comes from one row per block, the
    best of earlier epochs in the block from a window over that block.
    """
    if mode not in ("max", "min"):
        raise ValueError(f"unknown mode: {mode}")
    best = F.max if mode == "max" else F.min
    pick = F.greatest if mode == "max" else F.least
    rows = df.where(F.col(metric).isNotNull()).withColumn(
        "_block", F.floor(F.col(epoch) / block)
    )
    earlier = Window.partitionBy(by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(by, "_block")
        .agg(best(metric).alias("_best"))
        .select(by, "_block", best("_best").over(earlier).alias("_carried"))
    )
    inside = (
        Window.partitionBy(by, "_block").orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    )
    previous = pick(F.col("_carried"), best(metric).over(inside))
    improved = F.col(metric) > F.col("previous_best")
    if mode == "min":
        improved = F.col(metric) < F.col("previous_best")
    return (
        rows.join(carried, [by, "_block"])
        .withColumn("previous_best", previous)
        .withColumn("is_best", F.col("previous_best").isNull() | improved)
        .drop("_block", "_carried")
    )


def best_rows(df: DataFrame, by: str, score: Column, cols: list[str]) -> DataFrame:
    """Per group the columns of its best-scored row."""
    return df.groupBy(by).agg(F.max_by(F.struct(*cols), score).alias("r")).select(by, "r.*")


def rank_models(df: DataFrame, metric: str, model: str = "model") -> DataFrame:
    """Models by metric, best first, names break ties; a missing metric counts as zero."""
    return df.orderBy(F.coalesce(F.col(metric), F.lit(0.0)).desc(), F.col(model))


def best_model(df: DataFrame, metric: str, model: str = "model") -> DataFrame:
    return rank_models(df, metric, model).limit(1)
