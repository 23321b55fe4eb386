"""Stability index, session windows and alerts on a stream that comes in slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from wanewatch.catalog.registry import query, r6
from wanewatch.operators import stability
from wanewatch.session import fresh_path
from wanewatch.sources.tables import table
from wanewatch.streaming import alerts, sessions, windows

HALF = "2024-01-16"
SLICES = 4
GAP = "6 hours"
PSI_WINDOWS = f"""
w AS (
  SELECT 'same' AS part, value AS v, user_id::DOUBLE AS u FROM events WHERE ts < TIMESTAMP '{HALF}'
  UNION ALL SELECT 'later', value, user_id FROM events WHERE ts >= TIMESTAMP '{HALF}'
  UNION ALL SELECT 'shifted', value * 1.5 + 10, user_id + 3 FROM events WHERE ts >= TIMESTAMP '{HALF}'
  UNION ALL SELECT 'low', CASE WHEN value < 10 THEN value END, 1 FROM events WHERE ts >= TIMESTAMP '{HALF}')"""


@query(
    f"""WITH {PSI_WINDOWS},
long AS (SELECT part, 'value' AS feature, v AS x FROM w UNION ALL SELECT part, 'user_id', u FROM w),
edges AS (
  SELECT feature, list(DISTINCT e) AS edges FROM (
    SELECT feature, unnest(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e
    FROM long WHERE part = 'same' GROUP BY feature) GROUP BY feature),
counts AS (
  SELECT part, feature, CASE WHEN x IS NULL THEN -1 ELSE len(list_filter(edges, lambda e: e < x)) END AS bin, count(*) AS n
  FROM long JOIN edges USING (feature) GROUP BY 1, 2, 3),
grid AS (
  SELECT part, feature, unnest(range(-1, len(edges) + 1)) AS bin FROM edges, (SELECT DISTINCT part FROM w)),
share AS (
  SELECT part, feature, bin, (coalesce(n, 0) + 0.5::DOUBLE) / sum(coalesce(n, 0) + 0.5::DOUBLE) OVER (PARTITION BY part, feature) AS q
  FROM grid LEFT JOIN counts USING (part, feature, bin)),
psi AS (
  SELECT a.part, a.feature, sum((a.q - b.q) * ln(a.q / b.q)) AS psi
  FROM share a JOIN share b ON a.feature = b.feature AND a.bin = b.bin AND b.part = 'same' GROUP BY 1, 2)
SELECT part, feature, round(psi, 6) AS psi,
  CASE WHEN psi >= 0.25 THEN 'major' WHEN psi >= 0.1 THEN 'moderate' ELSE 'stable' END AS level FROM psi"""
)
def drift_psi(spark, folder):
    """Index of the same, later, shifted and empty bins; later rows come as merged day windows."""
    events = table(spark, folder, "events").select("ts", "value", F.col("user_id").cast("double").alias("user_id"))
    first, rest = events.where(F.col("ts") < HALF), events.where(F.col("ts") >= HALF)
    bins = stability.reference_bins(first, ["value", "user_id"])
    reference = stability.bin_counts(first, bins)
    days = stability.bin_counts(rest.withColumn("day", F.to_date("ts")), bins, ["day"])
    low = F.when(F.col("value") < 10, F.col("value"))
    moved = {
        "shifted": rest.select((F.col("value") * 1.5 + 10).alias("value"), (F.col("user_id") + 3).alias("user_id")),
        "low": rest.select(low.alias("value"), F.lit(1.0).alias("user_id")),
    }
    windows_ = {"same": reference, "later": stability.merged(days)}
    windows_ |= {k: stability.bin_counts(df, bins) for k, df in moved.items()}
    current = None
    for part, counts in windows_.items():
        named = counts.select(F.lit(part).alias("part"), "feature", "bin", "n")
        current = named if current is None else current.unionByName(named)
    return stability.stability(reference, current, bins, ["part"]).withColumn("psi", r6("psi"))


def _slices(spark, folder, path):
    """Write the events in time order, slice by slice, the first slice a second time at the end."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    step = (high - low) // SLICES + 1
    for i in [*range(SLICES), 0]:
        since = F.unix_micros("ts") - low
        part = events.where((since >= i * step) & (since < (i + 1) * step))
        part.write.mode("append").parquet(path)
        yield i


CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query(
    f"""WITH marked AS (
  SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 6 HOUR, TRUE)::INT AS head FROM events),
numbered AS (SELECT *, sum(head) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM marked),
found AS (
  SELECT user_id, min(ts) AS b, max(ts) + INTERVAL 6 HOUR AS e, count(*) AS n, sum(value) AS total FROM numbered GROUP BY user_id, s)
SELECT user_id, epoch_us(b) AS session_start, epoch_us(e) AS session_end, n, round(total, 4) AS total
FROM found WHERE date_trunc('millisecond', e) <= date_trunc('millisecond', {CLOSED})"""
)
def stream_sessions(spark, folder):
    """Closed sessions of every user over five micro-batches, the last a repeat of the first."""
    source, out, marks = (fresh_path(spark, f"sessions-{k}") for k in ("in", "out", "state"))
    schema = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp")).schema
    for _ in _slices(spark, folder, source):
        stream = spark.readStream.schema(schema).parquet(source)
        found = sessions.sessions(stream, "ts", ["user_id"], "value", gap=GAP)
        windows.run_to_table(found, out, marks, mode="append")
    return spark.read.parquet(out).select(
        "user_id", *[F.unix_micros(c).alias(c) for c in ("session_start", "session_end")], "n", F.round("total", 4).alias("total")
    )


@query(
    f"""WITH base AS (SELECT event_type AS metric, avg(value) AS baseline FROM events WHERE ts < TIMESTAMP '{HALF}' GROUP BY 1),
daily AS (SELECT event_type AS metric, date_trunc('day', ts) AS d, avg(value) AS current FROM events GROUP BY 1, 2),
rated AS (
  SELECT *, (baseline - current) / baseline AS fall FROM daily JOIN base USING (metric)
  WHERE d + INTERVAL 1 DAY <= {CLOSED}),
levels AS (SELECT *, CASE WHEN fall > 0.1 THEN 2 WHEN fall > 0.05 THEN 1 ELSE 0 END AS level FROM rated),
steps AS (SELECT *, coalesce(lag(level) OVER (PARTITION BY metric ORDER BY d), 0) AS before FROM levels),
runs AS (SELECT *, count(*) FILTER (WHERE before = 0 AND level > 0) OVER (PARTITION BY metric ORDER BY d) AS run FROM steps),
worst AS (
  SELECT *, max(fall) FILTER (WHERE level > 0) OVER (PARTITION BY metric, run ORDER BY d) AS w,
    min(d) FILTER (WHERE level > 0) OVER (PARTITION BY metric, run ORDER BY d) AS opened FROM runs)
SELECT metric, strftime(d, '%Y-%m-%d') AS "at",
  CASE WHEN before = 0 THEN 'OPENED' WHEN level = 0 THEN 'RESOLVED' WHEN level > before THEN 'ESCALATED' ELSE 'EASED' END AS change,
  CASE level WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'NONE' END AS severity, round(current, 6) AS current,
  round(100 * fall, 6) AS degradation_pct, strftime(opened, '%Y-%m-%d') AS opened_at, round(100 * w, 6) AS worst_pct
FROM worst WHERE level <> before"""
)
def stream_alerts(spark, folder):
    """Changes of the alert on every event type's daily mean, over slices of the stream.

    The first stream gives out days that the watermark has closed, the second follows them with the
    open alerts as state; both go on from their checkpoints slice by slice.
    """
    source, daily, out = (fresh_path(spark, f"alerts-{k}") for k in ("in", "daily", "out"))
    marks, state = (fresh_path(spark, f"alerts-{k}") for k in ("marks", "state"))
    events = table(spark, folder, "events")
    baseline = events.where(F.col("ts") < HALF).groupBy(F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    schema = events.withColumn("ts", F.col("ts").cast("timestamp")).schema
    for _ in _slices(spark, folder, source):
        stream = spark.readStream.schema(schema).parquet(source)
        stats = windows.window_stats(stream, "ts", "value", ["event_type"], window="1 day")
        means = stats.select("window_start", "event_type", (F.col("total") / F.col("n")).alias("mean"))
        windows.run_to_table(means, daily, marks, mode="append")
        days = spark.readStream.schema(means.schema).parquet(f"{daily}/batch=*")
        changes = alerts.alert_changes(days, baseline, "event_type", "window_start", "mean")
        windows.run_to_table(changes, out, state, mode="append")
    found = spark.read.parquet(out)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return found.select(
        "metric", day("at"), "change", "severity", r6("current").alias("current"), r6("degradation_pct").alias("degradation_pct"),
        day("opened_at"), r6("worst_pct").alias("worst_pct"),
    )
