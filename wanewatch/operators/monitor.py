"""Monitoring: prediction log, reference statistics, drift, degradation, health.

State is small tables: one row per feature, per metric or per alert.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanewatch.functions import scalars
from wanewatch.operators.order_stats import long_form, quantiles
from wanewatch.operators.ranking import newest

# Drift and alert thresholds, window sizes.
DRIFT_THRESHOLD, DRIFT_MIN_ROWS, DRIFT_WINDOW = 0.1, 100, 1_000
ALERT_THRESHOLD, HIGH_THRESHOLD = 0.05, 0.1
LOG_BUFFER, TINY = 10_000, 1e-10
WIDE_FEATURES = 24

LOG_COLUMNS = [
    "timestamp",
    "prediction",
    "probability",
    "ground_truth",
    "metadata",
    "features_hash",
]


def prediction_log(
    df: DataFrame,
    *,
    at: Column,
    prediction: Column,
    probability: Column,
    ground_truth: Column | None = None,
    metadata: Column | None = None,
    features: list[str] | None = None,
    extra: list[str] | None = None,
) -> DataFrame:
    """Rows in the log schema, for a batch or a stream alike."""
    empty = F.create_map().cast("map<string,string>")
    truth = F.lit(None) if ground_truth is None else ground_truth
    mark = scalars.row_hash(*features) if features else F.lit(None)
    return df.select(
        *(extra or []),
        at.alias("timestamp"),
        prediction.cast("int").alias("prediction"),
        probability.cast("double").alias("probability"),
        truth.cast("int").alias("ground_truth"),
        (empty if metadata is None else metadata).alias("metadata"),
        mark.cast("bigint").alias("features_hash"),
    )


def moments(df: DataFrame, features: dict[str, Column]) -> DataFrame:
    """(feature, n, mean, std, min, max) from one pass; NaN is left out like NULL.

    A few features are aggregated side by side in one row. Many would make one very long
    generated method, so they are turned into (feature, value) rows first; partial
    aggregation keeps what is shuffled at one row per task and feature.
    """
    if len(features) > WIDE_FEATURES:
        pairs = [
            F.struct(F.lit(name).alias("feature"), scalars.nan_to_null(c.cast("double")).alias("x"))
            for name, c in features.items()
        ]
        return (
            df.select(F.inline(F.array(*pairs)))
            .groupBy("feature")
            .agg(
                F.count("*").alias("n"),
                F.avg("x").alias("mean"),
                F.stddev_pop("x").alias("std"),
                F.min("x").alias("min"),
                F.max("x").alias("max"),
            )
        )
    sums, structs = [], []
    for i, (name, c) in enumerate(features.items()):
        x = scalars.nan_to_null(c.cast("double"))
        sums += [
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_pop(x).alias(f"std_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
        ]
        structs.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.col("n"),
                *[F.col(f"{k}_{i}").alias(k) for k in ("mean", "std", "min", "max")],
            )
        )
    return df.agg(F.count("*").alias("n"), *sums).select(F.inline(F.array(*structs)))


def reference_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean, std, min, max, p25, p50, p75) of a reference table."""
    found = quantiles(long_form(df, cols), [0.25, 0.5, 0.75])
    rows = [(c, *found.get(c, [None] * 3)) for c in cols]
    points = df.sparkSession.createDataFrame(
        rows, "feature string, p25 double, p50 double, p75 double"
    )
    return moments(df, {c: F.col(c) for c in cols}).drop("n").join(F.broadcast(points), "feature")


def drift_by_feature(current: DataFrame, reference: DataFrame) -> DataFrame:
    """(feature, n, mean_shift, std_ratio) of current moments against reference moments."""
    ref = reference.select(
        "feature", F.col("mean").alias("ref_mean"), F.col("std").alias("ref_std")
    )
    scale = F.col("ref_std") + F.lit(TINY)
    return current.join(ref, "feature").select(
        "feature",
        "n",
        (F.abs(F.col("mean") - F.col("ref_mean")) / scale).alias("mean_shift"),
        (F.col("std") / scale).alias("std_ratio"),
    )


def drift(
    current: DataFrame, reference: DataFrame, threshold: float = DRIFT_THRESHOLD
) -> DataFrame:
    """One row: drift_detected, drift_score, averages, features_drifted, reason.

    Both inputs are moments (one row per feature). Fewer than 100 current rows: no verdict.
    """
    moved = scalars.nan_to_null("mean_shift")
    shift, spread = F.avg(moved), F.avg(scalars.nan_to_null("std_ratio"))
    row = drift_by_feature(current, reference).agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("samples"),
        (shift + F.abs(spread - 1)).alias("drift_score"),
        shift.alias("mean_shift_avg"),
        spread.alias("std_ratio_avg"),
        F.count_if(moved > threshold).alias("features_drifted"),
    )
    enough = F.col("samples") >= DRIFT_MIN_ROWS
    return row.select(
        (enough & F.coalesce(F.col("drift_score") > threshold, F.lit(False))).alias(
            "drift_detected"
        ),
        *[
            F.when(enough, F.col(c)).alias(c)
            for c in ("drift_score", "mean_shift_avg", "std_ratio_avg", "features_drifted")
        ],
        F.when(~enough, "Insufficient samples").alias("reason"),
    )


def alerts(
    metrics: DataFrame,
    baseline: DataFrame,
    threshold: float = ALERT_THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """Metrics that fell below their baseline by more than the threshold.

    ``metrics`` is long (metric, value, ...), ``baseline`` (metric, value). Metrics without
    a baseline, or with a baseline of zero, never alert.
    """
    base = baseline.select("metric", F.col("value").alias("baseline"))
    fall = scalars.nan_to_null(F.try_divide(F.col("baseline") - F.col("value"), F.col("baseline")))
    return (
        metrics.join(base, "metric")
        .withColumn("fall", fall)
        .where(F.col("fall") > threshold)
        .select(
            *(keep or []),
            "metric",
            "baseline",
            F.col("value").alias("current"),
            (F.col("fall") * 100).alias("degradation_pct"),
            F.when(F.col("fall") > HIGH_THRESHOLD, "HIGH").otherwise("MEDIUM").alias("severity"),
        )
    )


def alerts_of(raised: DataFrame, severity: str | None = None) -> DataFrame:
    return raised.where(F.col("severity") == severity) if severity else raised


def metrics_wide(log: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Long metric log to one row per key with the named metrics as columns."""
    return log.groupBy(*keys).pivot("metric", names).agg(F.first("value"))


def health(model: str, drift_row: DataFrame | None, raised: DataFrame) -> DataFrame:
    """One row: status, drift verdict and alert counts; a HIGH alert outranks drift."""
    counts = raised.agg(
        F.count_if(F.col("severity") == "HIGH").alias("high_severity_count"),
        F.count("*").alias("total_alerts"),
    ).withColumn("_k", F.lit(1))
    if drift_row is None:
        verdict = counts.select("_k", F.lit(None).cast("boolean").alias("drift_detected"))
    else:
        verdict = drift_row.select(F.lit(1).alias("_k"), "drift_detected")
    return counts.join(verdict, "_k").select(
        F.lit(model).alias("model_name"),
        F.when(F.col("high_severity_count") > 0, "CRITICAL")
        .when(F.col("drift_detected"), "WARNING")
        .otherwise("HEALTHY")
        .alias("status"),
        F.when(F.col("drift_detected").isNull(), "SKIPPED")
        .when(F.col("drift_detected"), "DRIFT")
        .otherwise("NONE")
        .alias("drift_status"),
        "high_severity_count",
        "total_alerts",
    )


@dataclass
class Monitor:
    """Reference, baseline and history of one model; every part is a DataFrame."""

    model_name: str
    features: list[str]
    reference: DataFrame | None = None
    baseline: DataFrame | None = None
    drift_log: list[DataFrame] = field(default_factory=list)
    metric_log: list[DataFrame] = field(default_factory=list)

    def set_reference(self, df: DataFrame) -> None:
        self.reference = reference_stats(df, self.features)

    def set_baseline(self, metrics: DataFrame) -> None:
        self.baseline = metrics

    def detect_drift(
        self, log: DataFrame, order: list[str], threshold: float = DRIFT_THRESHOLD
    ) -> DataFrame:
        """Drift of the newest rows; the result joins the history."""
        if self.reference is None:
            raise ValueError("reference data not set")
        window = newest(log, DRIFT_WINDOW, order)
        current = moments(window, {c: F.col(c) for c in self.features})
        result = drift(current, self.reference, threshold)
        self.drift_log.append(result)
        return result

    def log_metrics(self, metrics: DataFrame) -> None:
        self.metric_log.append(metrics)

    def _all(self, parts: list[DataFrame]) -> DataFrame | None:
        out = None
        for part in parts:
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    def drift_history(self) -> DataFrame | None:
        return self._all(self.drift_log)

    def alerts(self, severity: str | None = None) -> DataFrame | None:
        logged = self._all(self.metric_log)
        if logged is None or self.baseline is None:
            return None
        return alerts_of(alerts(logged, self.baseline), severity)

    def report(self, log: DataFrame, order: list[str]) -> DataFrame:
        """One row: logged count, drift checks so far, health and all alerts."""
        verdict = self.detect_drift(log, order) if self.reference is not None else None
        raised = self.alerts()
        if raised is None:
            raised = log.sparkSession.createDataFrame(
                [], "metric string, baseline double, current double, "
                "degradation_pct double, severity string"
            )
        state = health(self.model_name, verdict, raised).withColumn("_k", F.lit(1))
        counted = log.agg(F.count("*").alias("predictions_logged")).withColumn("_k", F.lit(1))
        listed = raised.agg(
            F.sort_array(F.collect_list(F.struct("metric", "severity", "current"))).alias("alerts")
        ).withColumn("_k", F.lit(1))
        return (
            state.join(counted, "_k")
            .join(listed, "_k")
            .withColumn("drift_checks", F.lit(len(self.drift_log)))
            .drop("_k")
        )


def monitor_for(
    model: str, features: list[str], reference: DataFrame, baseline: DataFrame
) -> Monitor:
    """Monitor with its reference statistics and baseline set."""
    made = Monitor(model, features)
    made.set_reference(reference)
    made.set_baseline(baseline)
    return made
