"""Time-window statistics of a stream, kept small by a watermark.

Windows are written as they change; the reader keeps the newest version of each. So the
state is bounded by the watermark, not by the length of the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wanewatch.operators import monitor

WATERMARK, WINDOW = "10 minutes", "1 hour"


def deduplicate(stream: DataFrame, key: str, time: str, delay: str = WATERMARK) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark."""
    if stream.isStreaming:
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def window_stats(
    df: DataFrame,
    time: str,
    value: str,
    by: list[str],
    *,
    window: str = WINDOW,
    slide: str | None = None,
    delay: str = WATERMARK,
) -> DataFrame:
    """Count, sum and sum of squares per (window, group); batch and stream alike."""
    if df.isStreaming:
        df = df.withWatermark(time, delay)
    framed = F.window(time, window, slide) if slide else F.window(time, window)
    x = F.col(value).cast("double")
    return (
        df.groupBy(framed.alias("w"), *by)
        .agg(F.count(x).alias("n"), F.sum(x).alias("total"), F.sum(x * x).alias("squares"))
        .select(F.col("w.start").alias("window_start"), *by, "n", "total", "squares")
    )


def moments_of(stats: DataFrame) -> DataFrame:
    """Mean and population deviation from count, sum and sum of squares."""
    mean = F.try_divide("total", "n")
    spread = F.sqrt(F.greatest(F.try_divide("squares", "n") - mean * mean, F.lit(0.0)))
    return stats.withColumns({"mean": mean, "std": spread})


def run_to_table(
    stats: DataFrame,
    path: str,
    checkpoint: str,
    *,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    mode: str = "update",
) -> None:
    """Process what is there and append every changed window with its batch number.

    With ``mode='append'`` every window comes once, when the watermark has closed it.

    Rewriting a batch after a failure overwrites its own folder, so no row doubles.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if on_batch is not None:
            on_batch(batch, number)

    query = (
        stats.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def newest_windows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last version written of each window."""
    versions = spark.read.parquet(path)
    columns = [c for c in versions.columns if c not in (*keys, "batch")]
    return versions.groupBy(*keys).agg(
        F.max_by(F.struct(*columns), "batch").alias("r")
    ).select(*keys, "r.*")


def drift_on_batch(
    reference: DataFrame, value: str, path: str, threshold: float = monitor.DRIFT_THRESHOLD
) -> Callable[[DataFrame, int], None]:
    """Batch callback: compare the rows of a micro-batch with reference moments."""

    def check(batch: DataFrame, number: int) -> None:
        current = monitor.moments(batch, {value: F.col(value)})
        found = monitor.drift(current, reference, threshold)
        found.write.mode("overwrite").json(f"{path}/batch={number}")

    return check


def rolling(df: DataFrame, by: list[str], n: int, order: list[str]) -> DataFrame:
    """Batch twin of the count window: the newest n rows per group."""
    w = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def as_timestamp(c: str) -> Column:
    return F.col(c).cast("timestamp")
