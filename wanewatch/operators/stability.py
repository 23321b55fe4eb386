"""Population stability: how far a column's distribution has moved over reference bins.

Bins are the exact quantiles of the reference. What is kept of a window of rows is one count per
feature and bin, so windows merge by addition and no row is read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanewatch.functions.scalars import nan_to_null
from wanewatch.operators.order_stats import long_form, quantiles

BINS = 10
SMOOTHING = 0.5  # added to every bin, so that an empty one has a finite logarithm
# Usual bounds of a moderate and of a major shift.
MODERATE, MAJOR = 0.1, 0.25
MISSING = -1  # the bin of NULL and NaN


def reference_bins(df: DataFrame, cols: list[str], bins: int = BINS) -> DataFrame:
    """(feature, edges): ascending distinct inner edges, a value on an edge lies below it.

    One row per column. A column without values has no edges, so all its values share a bin.
    """
    found = quantiles(long_form(df, cols), [i / bins for i in range(1, bins)])
    rows = [(c, sorted(set(found.get(c, [])))) for c in cols]
    return df.sparkSession.createDataFrame(rows, "feature string, edges array<double>")


def bin_of(x: Column, edges: Column) -> Column:
    below = F.size(F.filter(edges, lambda e: e < x))
    return F.when(x.isNull(), MISSING).otherwise(below)


def bin_counts(df: DataFrame, bins: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., feature, bin, n) of the features that ``bins`` lists, from one pass."""
    by, names = by or [], [r["feature"] for r in bins.select("feature").collect()]
    pairs = [F.struct(F.lit(c).alias("feature"), nan_to_null(F.col(c).cast("double")).alias("x")) for c in names]
    long = df.select(*by, F.inline(F.array(*pairs))).join(F.broadcast(bins), "feature")
    return long.groupBy(*by, "feature", bin_of(F.col("x"), F.col("edges")).alias("bin")).agg(F.count("*").alias("n"))


def merged(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of several windows as those of one."""
    return counts.groupBy(*(by or []), "feature", "bin").agg(F.sum("n").alias("n"))


def shares(counts: DataFrame, bins: DataFrame, by: list[str], name: str) -> DataFrame:
    """(by..., feature, bin, share) for every bin there is, smoothed."""
    every = bins.select("feature", F.explode(F.sequence(F.lit(MISSING), F.size("edges"))).alias("bin"))
    groups = counts.select(*by).distinct() if by else None
    grid = F.broadcast(every) if groups is None else groups.crossJoin(F.broadcast(every))
    n = F.coalesce("n", F.lit(0)) + SMOOTHING
    filled = grid.join(counts, [*by, "feature", "bin"], "left").withColumn("n", n)
    total = filled.groupBy(*by, "feature").agg(F.sum("n").alias("total"))
    return filled.join(total, [*by, "feature"]).select(*by, "feature", "bin", (F.col("n") / F.col("total")).alias(name))


def stability(reference: DataFrame, current: DataFrame, bins: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., feature, psi, level) of ``current`` counts against ``reference`` counts.

    A group without rows has no row here; identical distributions have index 0.
    """
    by = by or []
    p, q = shares(merged(reference), bins, [], "p"), shares(current, bins, by, "q")
    term = (F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))
    found = q.join(p, ["feature", "bin"]).groupBy(*by, "feature").agg(F.sum(term).alias("psi"))
    level = F.when(F.col("psi") >= MAJOR, "major").when(F.col("psi") >= MODERATE, "moderate").otherwise("stable")
    return found.withColumn("level", level)
