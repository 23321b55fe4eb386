"""Late ground truth attached to predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_truth(predictions: DataFrame, truth: DataFrame, key: str, label: str) -> DataFrame:
    """Batch: left join, predictions without truth keep NULL."""
    return predictions.join(truth.select(key, F.col(label).alias("ground_truth")), key, "left")


def attach_truth_stream(
    predictions: DataFrame,
    truth: DataFrame,
    key: str,
    label: str,
    *,
    time: str = "timestamp",
    truth_time: str = "truth_at",
    delay: str = "10 minutes",
    wait: str = "1 day",
) -> DataFrame:
    """Stream: left interval join; truth may arrive up to ``wait`` after the prediction."""
    p = predictions.withWatermark(time, delay).alias("p")
    t = truth.select(F.col(key), F.col(truth_time), F.col(label).alias("ground_truth"))
    t = t.withWatermark(truth_time, delay).alias("t")
    within = (
        (F.col(f"p.{key}") == F.col(f"t.{key}"))
        & (F.col(f"t.{truth_time}") >= F.col(f"p.{time}"))
        & (F.col(f"t.{truth_time}") <= F.col(f"p.{time}") + F.expr(f"interval {wait}"))
    )
    return p.join(t, within, "leftOuter").select("p.*", "t.ground_truth")
