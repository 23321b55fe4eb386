"""Session windows of a stream: activity of a key without a pause longer than a gap.

A session is given out once, when the watermark has passed its end; rows that come later are
dropped. State holds open sessions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.streaming.windows import WATERMARK


def sessions(
    df: DataFrame, time: str, by: list[str], value: str, *, gap: str = "30 minutes", delay: str = WATERMARK
) -> DataFrame:
    """(session_start, session_end, by..., n, total); the end is the last row's time plus the gap."""
    if df.isStreaming:
        df = df.withWatermark(time, delay)
    x = F.col(value).cast("double")
    framed = df.groupBy(F.session_window(time, gap).alias("s"), *by)
    return framed.agg(F.count(x).alias("n"), F.sum(x).alias("total")).select(
        F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), *by, "n", "total"
    )
