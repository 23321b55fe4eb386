"""Exact order statistics without sorting the table.

A mergeable sketch brackets each wanted rank; one more pass counts what lies below the
bracket and keeps only the values inside it, pre-aggregated by value. A bracket that still
holds many values is cut into ranges, the range with the rank again, all brackets at once,
until a bounded number is left; only those are sorted, one small window per (group, rank).
If a bracket misses its rank it is opened fully and narrowed in the same way, so the answer
is always exact and no task sorts more than ``SORTED_VALUES`` values.

``running_before`` gives running totals by the same ranges, as a tree of prefix sums.

Groups are features, classes or models: their number is set by the schema, not the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.functions.scalars import nan_to_null
from wanewatch.session import lookup_join

SKETCH_ACCURACY = 20_000
# Values one task may sort; beyond it they are cut into 2 ** TREE_LEVELS ranges.
SORTED_VALUES = 50_000
TREE_LEVELS = 9
TREE_ACCURACY = 10_000
GRID_STEPS = 2_000
SLACK = 2.0 / SKETCH_ACCURACY


def long_form(df: DataFrame, cols: list[str]) -> DataFrame:
    """(g, x) rows of several numeric columns; NULL and NaN left out."""
    pairs = [
        F.struct(F.lit(c).alias("g"), nan_to_null(F.col(c).cast("double")).alias("x")) for c in cols
    ]
    return df.select(F.inline(F.array(*pairs))).where(F.col("x").isNotNull())


def ranks_of(
    pairs: DataFrame, wanted: Callable[[str, int], list[int]]
) -> tuple[dict[str, int], dict[str, dict[int, float]]]:
    """Values at 0-based ranks of ``x`` within each ``g``.

    ``wanted(group, size)`` lists the ranks. Returns group sizes and {group: {rank: value}}.
    """
    grid = ", ".join(f"{i / GRID_STEPS}D" for i in range(GRID_STEPS + 1))
    sketch = pairs.groupBy("g").agg(
        F.count("x").alias("n"),
        F.expr(f"percentile_approx(x, array({grid}), {SKETCH_ACCURACY})").alias("q"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
    )
    sizes, brackets = {}, []
    for row in sketch.collect():
        g, n = row["g"], row["n"]
        sizes[g] = n
        points = [row["low"], *row["q"], row["high"]]
        for r in sorted(set(wanted(g, n))):
            below = math.floor((r / n - SLACK) * GRID_STEPS)
            above = math.ceil(((r + 1) / n + SLACK) * GRID_STEPS)
            lo = points[below + 1] if below >= 0 else row["low"]
            hi = points[above + 1] if above <= GRID_STEPS else row["high"]
            brackets.append((g, r, lo, hi))
    if not brackets:
        return sizes, {g: {} for g in sizes}
    found = _scan(pairs, brackets)
    missed = [b[:2] + (None, None) for b in brackets if b[:2] not in found]
    if missed:
        found.update(_scan(pairs, missed))
    out: dict[str, dict[int, float]] = {g: {} for g in sizes}
    for (g, r), value in found.items():
        out[g][r] = value
    return sizes, out


def _scan(pairs: DataFrame, brackets: list[tuple]) -> dict[tuple[str, int], float]:
    """Value at each bracketed rank; ranks outside their bracket are left out.

    The broadcast side has one row per group, built from the driver's own list.
    """
    spark = pairs.sparkSession
    kind = pairs.schema["x"].dataType.simpleString()
    band = (
        spark.createDataFrame(brackets, f"g string, r bigint, lo {kind}, hi {kind}")
        .groupBy("g")
        .agg(F.collect_list(F.struct("r", "lo", "hi")).alias("bands"))
    )
    x = F.col("x")
    below = F.col("band.lo").isNotNull() & (x < F.col("band.lo"))
    above = F.col("band.hi").isNotNull() & (x > F.col("band.hi"))
    histogram = (
        pairs.join(F.broadcast(band), "g")
        .select("g", "x", F.explode("bands").alias("band"))
        .where(~above)
        .groupBy("g", F.col("band.r").alias("r"), F.when(~below, x).alias("x"))
        .agg(F.count("*").alias("n"))
        .persist()
    )
    kept = _narrowed(histogram, kind) if histogram.count() > SORTED_VALUES else histogram
    w = Window.partitionBy("g", "r").orderBy(F.col("x").asc_nulls_first())
    reached = kept.withColumn("upto", F.sum("n").over(w)).where(
        F.col("x").isNotNull()
        & (F.col("upto") > F.col("r"))
        & (F.col("upto") - F.col("n") <= F.col("r"))
    )
    found = {(row["g"], row["r"]): row["x"] for row in reached.collect()}
    histogram.unpersist()
    return found


def _narrowed(histogram: DataFrame, kind: str) -> DataFrame:
    """The histogram with every bracket narrowed to at most ``SORTED_VALUES`` values.

    What lies below the narrowed bracket is one row with a NULL value, as in the input. Each
    round reads the histogram twice for all brackets together; what reaches the driver is
    one row of range totals a bracket.
    """
    spark = histogram.sparkSession
    schema = f"g string, r bigint, lo {kind}, hi {kind}"
    x = F.col("x")
    inside = (F.col("lo").isNull() | (x > F.col("lo"))) & (F.col("hi").isNull() | (x <= F.col("hi")))

    def within(spans: dict) -> DataFrame:
        side = spark.createDataFrame([(*k, *v) for k, v in spans.items()], schema)
        return histogram.where(x.isNotNull()).join(F.broadcast(side), ["g", "r"]).where(inside)

    lows = {
        (row["g"], row["r"]): row["n"]
        for row in histogram.where(x.isNull()).select("g", "r", "n").collect()
    }
    open_ = {(r["g"], r["r"]): (None, None) for r in histogram.select("g", "r").distinct().collect()}
    final = dict(open_)
    while open_:
        rows = within(open_)
        cuts = {
            (row["g"], row["r"]): row["cuts"]
            for row in rows.groupBy("g", "r")
            .agg(F.count("*").alias("kinds"), _cut_points("x").alias("cuts"))
            .where(F.col("kinds") > SORTED_VALUES)
            .collect()
        }
        if not cuts:
            break
        points = spark.createDataFrame(
            [(*k, v) for k, v in cuts.items()], f"g string, r bigint, cuts array<{kind}>"
        )
        totals = (
            rows.join(F.broadcast(points), ["g", "r"])
            .groupBy("g", "r", range_number(x, F.col("cuts"), TREE_LEVELS).alias("part"))
            .agg(F.sum("n").alias("n"))
            .groupBy("g", "r")
            .agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("parts"))
        )
        narrower = {}
        for row in totals.collect():
            at = (row["g"], row["r"])
            lo, hi = open_[at]
            seen = lows.get(at, 0)
            for part, n in row["parts"]:
                if seen + n > at[1]:
                    if seen <= at[1]:
                        ends = cuts[at]
                        span = (ends[part - 1] if part else lo, ends[part] if part < len(ends) else hi)
                        if span != (lo, hi):
                            narrower[at] = span
                    break
                seen += n
        final.update(narrower)
        open_ = narrower
    side = spark.createDataFrame([(*k, *v) for k, v in final.items()], schema)
    joined = histogram.join(F.broadcast(side), ["g", "r"])
    low = x.isNull() | (F.col("lo").isNotNull() & (x <= F.col("lo")))
    return (
        joined.where(x.isNull() | F.col("hi").isNull() | (x <= F.col("hi")))
        .groupBy("g", "r", F.when(~low, x).alias("x"))
        .agg(F.sum("n").alias("n"))
    )


def _cut_points(x: str) -> Column:
    shares = ", ".join(f"{i / 2**TREE_LEVELS}D" for i in range(1, 2**TREE_LEVELS))
    return F.expr(f"percentile_approx({x}, array({shares}), {TREE_ACCURACY})")


def running_before(
    rows: DataFrame, names: list[str], x: str, sums: list[str], limit: int | None = None
) -> DataFrame:
    """Add ``before_<c>``: the sum of ``c`` over the group's rows with a smaller ``x``.

    ``rows`` has one row per group and ``x``, none of them NULL, and is read several times:
    hand in a written table. A group of more than ``limit`` rows is cut into ranges, each of
    them again while the largest is above ``limit``, so the depth follows the number of rows.
    The sum is that of the ranges before, level by level, and of a window in the last range.
    """
    limit = limit or SORTED_VALUES
    kinds = {c: rows.schema[c].dataType for c in sums}
    path, parts = list(names), []
    if not path:
        path, parts = ["__all"], ["__all"]
        rows = rows.withColumn("__all", F.lit(0))
    rows = rows.withColumns({f"before_{c}": F.lit(0).cast(t) for c, t in kinds.items()})
    largest = rows.groupBy(*path).count().agg(F.max("count")).first()[0] or 0
    while largest > limit:
        part = f"__part_{len(parts)}"
        cuts = rows.groupBy(*path).agg(_cut_points(x).alias("__cuts"))
        number = range_number(F.col(x), F.col("__cuts"), TREE_LEVELS)
        cut = lookup_join(rows, cuts, path).withColumn(part, number).drop("__cuts")
        earlier = Window.partitionBy(*path).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        totals = cut.groupBy(*path, part).agg(
            *[F.sum(c).alias(c) for c in sums], F.count("*").alias("__n")
        )
        size = totals.agg(F.max("__n")).first()[0]
        if size >= largest:
            break
        shifts = totals.select(
            *path,
            part,
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast(t).alias(f"__shift_{c}") for c, t in kinds.items()],
        )
        rows = (
            lookup_join(cut, shifts, [*path, part])
            .withColumns({f"before_{c}": F.col(f"before_{c}") + F.col(f"__shift_{c}") for c in sums})
            .drop(*[f"__shift_{c}" for c in sums])
        )
        parts.append(part)
        path.append(part)
        largest = size
    inside = Window.partitionBy(*path).orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns(
        {
            f"before_{c}": F.col(f"before_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)).cast(t)
            for c, t in kinds.items()
        }
    ).drop(*parts)


def interpolated_ranks(n: int, prob: float) -> tuple[int, int, float]:
    position = prob * (n - 1)
    low = math.floor(position)
    return low, min(low + 1, n - 1), position - low


def quantiles(pairs: DataFrame, probs: list[float]) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of ``x`` for every group."""

    def wanted(_: str, n: int) -> list[int]:
        return [r for p in probs for r in interpolated_ranks(n, p)[:2]]

    sizes, values = ranks_of(pairs, wanted)
    out = {}
    for g, n in sizes.items():
        out[g] = []
        for p in probs:
            low, high, part = interpolated_ranks(n, p)
            a, b = values[g][low], values[g][high]
            out[g].append(a + (b - a) * part)
    return out


def medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    found = quantiles(long_form(df, cols), [0.5]) if cols else {}
    return {c: found[c][0] if c in found else None for c in cols}


def range_number(x: Column, cuts: Column, levels: int) -> Column:
    """How many of the 2 ** levels - 1 ascending cut points lie below ``x``, by halving."""
    steps = F.array(*[F.lit(2**i) for i in reversed(range(levels))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) < x, at + step).otherwise(at),
    )
