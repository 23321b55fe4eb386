"""Degradation alerts on a stream of metrics, with the open alerts as keyed state.

Per metric the state holds the time of the newest value, the level of the open alert, when it
was opened and the worst fall since. Only changes are given out, so an alert that stays open over
many batches is raised once, and a batch that comes again changes nothing: values no newer than
the state are late.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wanewatch.functions import scalars
from wanewatch.operators.monitor import ALERT_THRESHOLD, HIGH_THRESHOLD

LEVELS = ["NONE", "MEDIUM", "HIGH"]
EVENT_DDL = (
    "metric string, at timestamp, change string, severity string, current double, baseline double, "
    "degradation_pct double, opened_at timestamp, worst_pct double, late bigint"
)
STATE_DDL = "newest timestamp, level int, opened timestamp, worst double, late bigint"


def falls(metrics: DataFrame, baseline: DataFrame, metric: str, time: str, value: str) -> DataFrame:
    """(metric, at, current, baseline, fall) of metrics that have a baseline other than zero."""
    base = baseline.select(F.col("metric"), F.col("value").cast("double").alias("baseline"))
    rows = metrics.select(
        F.col(metric).cast("string").alias("metric"), F.col(time).alias("at"), F.col(value).cast("double").alias("current")
    )
    fall = scalars.nan_to_null(F.try_divide(F.col("baseline") - F.col("current"), F.col("baseline")))
    return rows.join(base, "metric").withColumn("fall", fall).where(F.col("fall").isNotNull())


def change(before: int, now: int) -> str | None:
    """Name of the step from one level to another; None if they are equal."""
    if before == now:
        return None
    if not before:
        return "OPENED"
    if not now:
        return "RESOLVED"
    return "ESCALATED" if now > before else "EASED"


def alert_changes(
    metrics: DataFrame,
    baseline: DataFrame,
    metric: str,
    time: str,
    value: str,
    threshold: float = ALERT_THRESHOLD,
    high: float = HIGH_THRESHOLD,
) -> DataFrame:
    """Changes of the alert of every metric, for a stream of final metric values.

    ``baseline`` is a static table with one row per metric. A resolved alert reports when it was
    opened and its worst fall. ``late`` counts the values of the metric that came too late.
    """

    def follow(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest, level, opened, worst, late = state.get if state.exists else (None, 0, None, 0.0, 0)
        # the values of one metric in one batch: one per window
        rows = pd.concat(list(chunks)).sort_values("at")
        out = []
        for r in rows.itertuples(index=False):
            if newest is not None and r.at <= newest:
                late += 1
                continue
            newest = r.at
            now = 2 if r.fall > high else int(r.fall > threshold)
            step = change(level, now)
            if step == "OPENED":
                opened, worst = r.at, r.fall
            worst = max(worst, r.fall)
            if step:
                out.append(
                    (key[0], r.at, step, LEVELS[now], r.current, r.baseline, 100 * r.fall, opened, 100 * worst, late)
                )
            level = now
        state.update((newest, level, opened, float(worst), late))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in EVENT_DDL.split(", ")])

    moved = falls(metrics, baseline, metric, time, value)
    return moved.groupBy("metric").applyInPandasWithState(
        follow, EVENT_DDL, STATE_DDL, "append", GroupStateTimeout.NoTimeout
    )
