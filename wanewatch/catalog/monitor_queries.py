"""Prediction log, drift, alerts, checkpoints, registry and stream queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wanewatch.catalog.registry import h13, on_scored, query, r6
from wanewatch.functions import scalars
from wanewatch.operators import monitor, ranking
from wanewatch.session import fresh_path
from wanewatch.sources import files, tracking
from wanewatch.sources.subscribers import scored_subscribers
from wanewatch.sources.tables import table
from wanewatch.streaming import count_window, truth, windows

LOG_DDL = (
    "event_id bigint, timestamp string, prediction int, probability double, ground_truth int, "
    "metadata map<string,string>, features_hash bigint"
)
TS = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def _log(spark, folder):
    """The events as a prediction log: probability from the value, truth from the type."""
    events = table(spark, folder, "events")
    p = F.least(F.col("value") / 100.0, F.lit(1.0))
    return monitor.prediction_log(
        events,
        at=scalars.iso_time(F.col("ts")),
        prediction=scalars.positive(p),
        probability=p,
        ground_truth=F.when(F.col("event_type") == "purchase", 1).when(
            F.col("event_type") == "view", 0
        ),
        metadata=F.create_map(F.lit("event_type"), F.col("event_type")),
        features=["user_id", "value"],
        extra=["event_id"],
    )


LOGGED = f"""
log AS (
  SELECT event_id, {TS} AS "timestamp", CAST(least(value / 100, 1.0::DOUBLE) > 0.5 AS INTEGER) AS prediction,
    least(value / 100, 1.0::DOUBLE) AS probability,
    CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 0 END AS ground_truth, event_type FROM events)"""
LOG_OUT = 'event_id, "timestamp", prediction, round(probability, 6) AS probability, ground_truth, event_type'


def _shown(log):
    return log.select(
        "event_id",
        "timestamp",
        "prediction",
        r6("probability").alias("probability"),
        "ground_truth",
        F.col("metadata")["event_type"].alias("event_type"),
    )


@query(f"WITH {LOGGED} SELECT {LOG_OUT} FROM log")
def prediction_log(spark, folder):
    return _shown(_log(spark, folder))


@query(f"WITH {LOGGED} SELECT {LOG_OUT} FROM log")
def log_round_trip(spark, folder):
    """Appended as JSON lines and read back."""
    path = fresh_path(spark, "log")
    files.append_log(_log(spark, folder), path)
    return _shown(files.read_log(spark, path, LOG_DDL))


@query(f'WITH {LOGGED} SELECT {LOG_OUT} FROM log ORDER BY "timestamp" DESC, event_id DESC LIMIT 100')
def recent_predictions(spark, folder):
    return _shown(ranking.newest(_log(spark, folder), 100, ["timestamp", "event_id"]))


@query(
    """SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM (SELECT *,
  row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 1000 GROUP BY 1"""
)
def last_window(spark, folder):
    """Newest thousand rows per model."""
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    newest = ranking.newest(events, monitor.DRIFT_WINDOW, ["ts", "event_id"], ["event_type"])
    return newest.groupBy("event_type").agg(
        F.count("*").alias("n"), r6(F.avg("value")).alias("mean")
    )


@query(
    on_scored(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(avg("{c}"), 6) AS mean, round(stddev_pop("{c}"), 6) AS std,
  round(min("{c}"), 6)::DOUBLE AS min, round(max("{c}"), 6)::DOUBLE AS max, round(quantile_cont("{c}"::DOUBLE, 0.25), 6) AS p25,
  round(quantile_cont("{c}"::DOUBLE, 0.5), 6) AS p50, round(quantile_cont("{c}"::DOUBLE, 0.75), 6) AS p75 FROM scored"""
            for c in ("tenure", "MonthlyCharges", "TotalCharges", "p_a")
        )
    )
)
def reference_stats(spark, folder):
    stats = monitor.reference_stats(
        scored_subscribers(spark, folder), ["tenure", "MonthlyCharges", "TotalCharges", "p_a"]
    )
    return stats.withColumns(
        {c: r6(c) for c in ("mean", "std", "min", "max", "p25", "p50", "p75")}
    )


LINE_STATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75 FROM lineitem"""
        for c in LINE_STATS
    )
)
def reference_stats_lineitem(spark, folder):
    """Reference statistics of the largest table."""
    stats = monitor.reference_stats(table(spark, folder, "lineitem"), LINE_STATS)
    return stats.select("feature", *[r6(c).alias(c) for c in ("mean", "std", "p25", "p50", "p75")])


def _drift_sql(current: str, reference: str, n: str) -> str:
    """SQL of the verdict over (feature, m, s) tables ``current`` and ``reference``."""
    return f"""SELECT score > 0.1::DOUBLE AS drift_detected, round(score, 6) AS drift_score,
  round(shift, 6) AS mean_shift_avg, round(spread, 6) AS std_ratio_avg, features_drifted, CAST(NULL AS VARCHAR) AS reason
FROM (SELECT avg(sh) + abs(avg(ra) - 1) AS score, avg(sh) AS shift, avg(ra) AS spread,
  count(*) FILTER (WHERE sh > 0.1::DOUBLE) AS features_drifted
  FROM (SELECT abs(c.m - r.m) / (r.s + 1e-10::DOUBLE) AS sh, c.s / (r.s + 1e-10::DOUBLE) AS ra
    FROM ({current}) c JOIN ({reference}) r USING (feature)))"""


def _value_stats(expr: str, where: str = "TRUE") -> str:
    return f"SELECT 'value' AS feature, avg({expr}) AS m, stddev_pop({expr}) AS s FROM events WHERE {where}"


MIDDLE = "2024-01-16"


def _shown_drift(row):
    return row.withColumns(
        {c: r6(c) for c in ("drift_score", "mean_shift_avg", "std_ratio_avg")}
    )


@query(
    _drift_sql(
        _value_stats("value", f"ts >= TIMESTAMP '{MIDDLE}'"),
        _value_stats("value", f"ts < TIMESTAMP '{MIDDLE}'"),
        "",
    )
)
def drift_halves(spark, folder):
    """Second half of the month against the first: no drift expected."""
    events = table(spark, folder, "events")
    late = F.col("ts") >= F.lit(f"{MIDDLE} 00:00:00").cast("timestamp_ntz")
    value = {"value": F.col("value")}
    return _shown_drift(
        monitor.drift(
            monitor.moments(events.where(late), value), monitor.moments(events.where(~late), value)
        )
    )


@query(_drift_sql(_value_stats("value * 2"), _value_stats("value"), ""))
def drift_shifted(spark, folder):
    """Doubled values against the original: drift expected."""
    events = table(spark, folder, "events")
    return _shown_drift(
        monitor.drift(
            monitor.moments(events, {"value": F.col("value") * 2}),
            monitor.moments(events, {"value": F.col("value")}),
        )
    )


def _embedding_stats(where: str) -> str:
    return f"""SELECT i AS feature, avg(embedding[i]::DOUBLE) AS m, stddev_pop(embedding[i]::DOUBLE) AS s
FROM embeddings, generate_series(1, 64) AS g(i) WHERE {where} GROUP BY 1"""


@query(_drift_sql(_embedding_stats("label >= 5"), _embedding_stats("label < 5"), ""))
def drift_embeddings(spark, folder):
    """Sixty-four features at once, one half of the labels against the other."""
    df = table(spark, folder, "embeddings")
    parts = {f"e{i:02d}": F.col("embedding")[i] for i in range(64)}
    return _shown_drift(
        monitor.drift(
            monitor.moments(df.where("label >= 5"), parts),
            monitor.moments(df.where("label < 5"), parts),
        )
    )


@query(
    _drift_sql(
        "SELECT 'value' AS feature, avg(value) AS m, stddev_pop(value) AS s FROM "
        "(SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)",
        _value_stats("value"),
        "",
    )
)
def drift_window(spark, folder):
    """The newest thousand rows against all."""
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    watch = monitor.Monitor("events", ["value"])
    watch.set_reference(events)
    return _shown_drift(watch.detect_drift(events, ["ts", "event_id"]))


@query(_drift_sql(_value_stats("value", "event_id % 7 <> 0"), _value_stats("value"), ""))
def drift_nan(spark, folder):
    """Every seventh value is not a number: left out, so no drift comes of it."""
    events = table(spark, folder, "events")
    holes = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return _shown_drift(
        monitor.drift(
            monitor.moments(events, {"value": holes}),
            monitor.moments(events, {"value": F.col("value")}),
        )
    )


def _newest_stats(expr: str) -> str:
    return f"""SELECT 'value' AS feature, avg({expr}) AS m, stddev_pop({expr}) AS s FROM
  (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)"""


@query(
    _drift_sql(_newest_stats("value"), _value_stats("value"), "")
    + " UNION ALL "
    + _drift_sql(_newest_stats("value * 3"), _value_stats("value"), "")
)
def drift_history(spark, folder):
    """What a monitor keeps of two checks, one without and one with drift."""
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    watch = monitor.Monitor("events", ["value"])
    watch.set_reference(events)
    watch.detect_drift(events, ["ts", "event_id"])
    watch.detect_drift(events.withColumn("value", F.col("value") * 3), ["ts", "event_id"])
    return _shown_drift(watch.drift_history())


@query(
    """SELECT event_type, count(*) AS n, count(DISTINCT (user_id, value)) AS marks FROM events GROUP BY 1"""
)
def row_marks(spark, folder):
    """The log's row hash: as many hashes as there are different feature rows."""
    log = _log(spark, folder).withColumn("event_type", F.col("metadata")["event_type"])
    return log.groupBy("event_type").agg(
        F.count("*").alias("n"), F.countDistinct("features_hash").alias("marks")
    )


DAILY = """
daily AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, avg(value) AS value_mean,
    avg(CAST(event_type <> 'error' AS INTEGER)) AS ok_rate FROM events GROUP BY 1),
base AS (
  SELECT avg(value) AS value_mean, avg(CAST(event_type <> 'error' AS INTEGER)) AS ok_rate FROM events
  WHERE ts < TIMESTAMP '2024-01-16'),
alert AS (
  SELECT day, metric, baseline, current, (baseline - current) / baseline AS fall FROM (
    SELECT day, 'value_mean' AS metric, b.value_mean AS baseline, d.value_mean AS current FROM daily d, base b
    UNION ALL SELECT day, 'ok_rate', b.ok_rate, d.ok_rate FROM daily d, base b)
  WHERE (baseline - current) / baseline > 0.05::DOUBLE)"""


def _metrics(events, keys):
    wide = events.groupBy(*keys).agg(
        F.avg("value").alias("value_mean"),
        F.avg((F.col("event_type") != "error").cast("int")).alias("ok_rate"),
    )
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("value_mean", "ok_rate")]
    return wide.select(*[k if isinstance(k, str) else "day" for k in keys], F.inline(F.array(*pairs)))


def _daily(spark, folder):
    events = table(spark, folder, "events")
    early = events.where(F.col("ts") < F.lit(f"{MIDDLE} 00:00:00").cast("timestamp_ntz"))
    daily = _metrics(events, [F.date_format("ts", "yyyy-MM-dd").alias("day")])
    return daily, _metrics(early, [])


@query(
    f"""WITH {DAILY} SELECT day, metric, round(baseline, 6) AS baseline, round(current, 6) AS current,
  round(fall * 100, 6) AS degradation_pct, CASE WHEN fall > 0.1::DOUBLE THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM alert"""
)
def metric_alerts(spark, folder):
    """Daily metrics that fell below the first half of the month."""
    daily, base = _daily(spark, folder)
    raised = monitor.alerts(daily, base, keep=["day"])
    return raised.withColumns({c: r6(c) for c in ("baseline", "current", "degradation_pct")})


@query(
    f"""WITH {DAILY} SELECT day, metric FROM alert WHERE fall > 0.1::DOUBLE"""
)
def high_alerts(spark, folder):
    daily, base = _daily(spark, folder)
    return monitor.alerts_of(monitor.alerts(daily, base, keep=["day"]), "HIGH").select("day", "metric")


@query(
    f"""WITH {DAILY} SELECT day, metric, CASE WHEN fall > 0.1::DOUBLE THEN 'HIGH' ELSE 'MEDIUM' END AS severity
FROM alert WHERE metric <> 'ok_rate'"""
)
def alert_nan(spark, folder):
    """A metric that is not a number raises no alert; the others do as before."""
    daily, base = _daily(spark, folder)
    rate = F.col("metric") == "ok_rate"
    daily = daily.withColumn("value", F.when(rate, F.lit(float("nan"))).otherwise(F.col("value")))
    return monitor.alerts(daily, base, keep=["day"]).select("day", "metric", "severity")


def _health_sql(model: str, drift: str | None) -> str:
    found = f"(SELECT drift_detected FROM ({drift}))" if drift else "CAST(NULL AS BOOLEAN)"
    return f"""SELECT '{model}' AS model_name, CASE WHEN high > 0 THEN 'CRITICAL' WHEN d THEN 'WARNING' ELSE 'HEALTHY' END AS status,
  CASE WHEN d IS NULL THEN 'SKIPPED' WHEN d THEN 'DRIFT' ELSE 'NONE' END AS drift_status,
  high AS high_severity_count, total AS total_alerts
FROM (SELECT {found} AS d, count(*) FILTER (WHERE fall > 0.1::DOUBLE) AS high, count(*) AS total FROM mild)"""


@query(
    f"WITH {DAILY}, mild AS (SELECT * FROM alert WHERE fall <= 0.1::DOUBLE) "
    + " UNION ALL ".join(
        [
            _health_sql("moved", _drift_sql(_value_stats("value * 2"), _value_stats("value"), "")),
            _health_sql("still", _drift_sql(_value_stats("value"), _value_stats("value"), "")),
            _health_sql("unwatched", None),
        ]
    )
)
def health_levels(spark, folder):
    """Health with medium alerts only: with drift, without, and without a reference."""
    events = table(spark, folder, "events")
    daily, base = _daily(spark, folder)
    mild = monitor.alerts_of(monitor.alerts(daily, base), "MEDIUM")
    plain = monitor.moments(events, {"value": F.col("value")})
    double = monitor.moments(events, {"value": F.col("value") * 2})
    rows = monitor.health("moved", monitor.drift(double, plain), mild)
    rows = rows.union(monitor.health("still", monitor.drift(plain, plain), mild))
    return rows.union(monitor.health("unwatched", None, mild))


@query(
    f"""WITH {DAILY} SELECT day, round(value_mean, 6) AS value_mean, round(ok_rate, 6) AS ok_rate FROM daily"""
)
def metrics_wide(spark, folder):
    daily, _ = _daily(spark, folder)
    wide = monitor.metrics_wide(daily, ["day"], ["value_mean", "ok_rate"])
    return wide.withColumns({c: r6(c) for c in ("value_mean", "ok_rate")})


@query(
    f"""WITH {DAILY} SELECT 'events' AS model_name, CASE WHEN count(*) FILTER (WHERE fall > 0.1::DOUBLE) > 0 THEN 'CRITICAL'
  ELSE 'WARNING' END AS status, 'DRIFT' AS drift_status, count(*) FILTER (WHERE fall > 0.1::DOUBLE) AS high_severity_count,
  count(*) AS total_alerts FROM alert"""
)
def health(spark, folder):
    """Health from daily alerts and a drift verdict on doubled values."""
    events = table(spark, folder, "events")
    daily, base = _daily(spark, folder)
    verdict = monitor.drift(
        monitor.moments(events, {"value": F.col("value") * 2}),
        monitor.moments(events, {"value": F.col("value")}),
    )
    return monitor.health("events", verdict, monitor.alerts(daily, base))


@query(
    f"""WITH {DAILY} SELECT 'events' AS model_name, count(*) FILTER (WHERE fall > 0.1::DOUBLE) AS high_severity_count,
  count(*) AS total_alerts, (SELECT count(*) FROM events) AS predictions_logged, CAST(count(*) AS INTEGER) AS alerts, 1 AS drift_checks FROM alert"""
)
def monitor_report(spark, folder):
    """The monitor's report, written as JSON and read back."""
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    daily, base = _daily(spark, folder)
    watch = monitor.monitor_for("events", ["value"], events, base)
    watch.log_metrics(daily.select("metric", "value"))
    path = fresh_path(spark, "monitor")
    files.write_json(watch.report(events, ["ts", "event_id"]), path)
    ddl = (
        "model_name string, high_severity_count bigint, total_alerts bigint, "
        "predictions_logged bigint, alerts array<struct<metric string>>, drift_checks int"
    )
    return spark.read.schema(ddl).json(path).withColumn("alerts", F.size("alerts"))


def _checkpoints(spark, folder):
    """Events as checkpoint rows: user is the experiment, event the sequence, value the score."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("experiment"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("score"),
        F.concat(F.lit("ckpt/"), F.col("event_id").cast("string")).alias("path"),
    )


@query(
    """SELECT user_id AS experiment, max(event_id) AS seq, 'ckpt/' || max(event_id) AS path FROM events GROUP BY 1"""
)
def checkpoint_latest(spark, folder):
    return ranking.latest(_checkpoints(spark, folder), ["experiment"], ["seq"], ["seq", "path"])


@query(
    """SELECT user_id AS experiment, event_id AS seq,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 5 AS kept FROM events"""
)
def checkpoint_retention(spark, folder):
    marked = ranking.retention(_checkpoints(spark, folder), ["experiment"], "seq", 5)
    return marked.select("experiment", "seq", "kept")


def _running(best: str, sign: str) -> str:
    return f"""SELECT experiment, seq, previous_best, previous_best IS NULL OR score {sign} previous_best AS is_best FROM (
  SELECT user_id AS experiment, event_id AS seq, value AS score,
    {best}(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_best
  FROM events)"""


@query(_running("max", ">"))
def running_best(spark, folder):
    found = ranking.running_best(_checkpoints(spark, folder), "experiment", "seq", "score")
    return found.select("experiment", "seq", "previous_best", "is_best")


@query(_running("min", "<"))
def running_best_min(spark, folder):
    found = ranking.running_best(_checkpoints(spark, folder), "experiment", "seq", "score", "min")
    return found.select("experiment", "seq", "previous_best", "is_best")


@query(
    """SELECT user_id AS experiment, max(value) AS score,
  'ckpt/' || min(event_id) FILTER (WHERE value = m) AS path FROM (
    SELECT *, max(value) OVER (PARTITION BY user_id) AS m FROM events) GROUP BY 1"""
)
def best_checkpoint(spark, folder):
    """The first row that reached the best score."""
    rows = _checkpoints(spark, folder)
    order = F.struct(F.col("score"), -F.col("seq"))
    return ranking.best_rows(rows, "experiment", order, ["score", "path"])


STAGES = ["None", "Staging", "Production", "Archived"]
EVENTS = """
events_log AS (
  SELECT event_type AS name, CAST(user_id % 7 + 1 AS INTEGER) AS version,
    CASE event_id % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'Staging' WHEN 2 THEN 'Production' ELSE 'Archived' END AS stage,
    event_id AS seq FROM events),
now AS (
  SELECT name, version, stage, seq FROM (SELECT *, row_number() OVER (PARTITION BY name, version ORDER BY seq DESC) AS rn
    FROM events_log) WHERE rn = 1)"""


def _stage_events(spark, folder):
    stage = F
    for i, name in enumerate(STAGES[:-1]):
        stage = stage.when(F.col("event_id") % 4 == i, name)
    return table(spark, folder, "events").select(
        F.col("event_type").alias("name"),
        (F.col("user_id") % 7 + 1).cast("int").alias("version"),
        stage.otherwise(STAGES[-1]).alias("stage"),
        F.col("event_id").alias("seq"),
    )


@query(f"WITH {EVENTS} SELECT * FROM now")
def registry_stages(spark, folder):
    return tracking.current_stages(_stage_events(spark, folder))


@query(f"WITH {EVENTS} SELECT name, stage, max(version) AS version FROM now GROUP BY 1, 2")
def registry_latest(spark, folder):
    return tracking.latest_versions(_stage_events(spark, folder))


@query(
    f"""WITH {EVENTS}, chosen AS (SELECT max(version) AS v FROM now WHERE name = 'click')
SELECT name, version, 'Archived' AS stage, 1000000000::BIGINT AS seq FROM now, chosen
WHERE name = 'click' AND stage = 'Production' AND version <> v
UNION ALL SELECT 'click', v, 'Production', 1000000000::BIGINT FROM chosen"""
)
def registry_promotion(spark, folder):
    """Newest version promoted, the others in that stage archived."""
    return tracking.promotion_events(
        _stage_events(spark, folder), "click", archive=True, seq=1_000_000_000
    )


@query(
    """SELECT event_type AS run, 'mean_value' AS key, round(avg(value), 6) AS value FROM events GROUP BY 1
UNION ALL SELECT event_type, 'rows', count(*)::DOUBLE FROM events GROUP BY 1"""
)
def run_metrics(spark, folder):
    """Metrics computed by Spark, appended to the run log and read back."""
    log = tracking.RunLog(spark, fresh_path(spark, "runs"))
    wide = table(spark, folder, "events").groupBy(F.col("event_type").alias("run")).agg(
        r6(F.avg("value")).alias("mean_value"), F.count("*").cast("double").alias("rows")
    )
    pairs = [F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in ("mean_value", "rows")]
    log.log_metrics(wide.select("run", F.inline(F.array(*pairs))))
    return log.metrics()


@query(
    on_scored(
        """SELECT s."customerID", round(p_b, 6) AS p, CASE "Churn" WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS ground_truth
FROM scored s LEFT JOIN (SELECT DISTINCT "customerID", "Churn" FROM subs WHERE "Contract" <> 'One year') t USING ("customerID")"""
    )
)
def truth_join(spark, folder):
    """Predictions with the truth that has arrived so far."""
    df = scored_subscribers(spark, folder)
    arrived = df.where(F.col("Contract") != "One year").select("customerID", "label")
    joined = truth.attach_truth(df.select("customerID", r6("p_b").alias("p")), arrived, "customerID", "label")
    return joined


def _stream(spark, folder):
    """The events table as a file stream."""
    path = f"{folder.rstrip('/')}/events*.parquet"  # a glob takes a file or a folder
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _windowed(spark, folder, **options):
    out, marks = fresh_path(spark, "windows"), fresh_path(spark, "windows-state")
    stats = windows.window_stats(
        _stream(spark, folder), "ts", "value", ["event_type"], **options
    )
    windows.run_to_table(stats, out, marks)
    newest = windows.newest_windows(spark, out, ["window_start", "event_type"])
    return newest.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"),
        "event_type",
        "n",
        F.round("total", 2).alias("total"),
        F.round("squares", 4).alias("squares"),
    )


STATS = "count(value) AS n, round(sum(value), 2) AS total, round(sum(value * value), 4) AS squares"


@query(
    f"SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, event_type, {STATS} FROM events GROUP BY 1, 2"
)
def stream_windows(spark, folder):
    """Tumbling hours of the stream."""
    return _windowed(spark, folder)


@query(
    f"""SELECT strftime(date_trunc('hour', ts) - to_hours(i), '%Y-%m-%d %H:%M') AS window_start, event_type, {STATS}
FROM events, generate_series(0, 1) AS g(i) GROUP BY 1, 2"""
)
def stream_sliding(spark, folder):
    """Two-hour windows sliding by one hour."""
    return _windowed(spark, folder, window="2 hours", slide="1 hour")


@query("SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1")
def stream_deduplicated(spark, folder):
    """Every event sent twice, repeats dropped within the watermark."""
    out, marks = fresh_path(spark, "dedup"), fresh_path(spark, "dedup-state")
    stream = _stream(spark, folder).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    kept = windows.deduplicate(stream, "event_id", "ts").select("event_id", "event_type")
    query_ = (
        kept.writeStream.format("parquet")
        .option("checkpointLocation", marks)
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    read = spark.read.schema("event_id bigint, event_type string").parquet(out)
    return read.groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    """SELECT event_type AS grp, max(all_n) AS seen, count(*) AS kept, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std
FROM (SELECT *, count(*) OVER (PARTITION BY event_type) AS all_n,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 500 GROUP BY 1"""
)
def stream_count_window(spark, folder):
    """The newest five hundred values per model, held as stream state."""
    out, marks = fresh_path(spark, "count"), fresh_path(spark, "count-state")
    states = count_window.count_window(_stream(spark, folder), "event_type", "event_id", "value", 500)
    windows.run_to_table(states, out, marks)
    merged = count_window.merge_count_windows(
        windows.newest_windows(spark, out, ["grp", "salt"]), 500
    )
    return merged.withColumns({c: r6(c) for c in ("mean", "std")})


@query("SELECT event_id, 1 AS ground_truth FROM events WHERE event_type = 'purchase'")
def stream_truth(spark, folder):
    """Stream of predictions joined with a stream of truth that comes an hour later."""
    out, marks = fresh_path(spark, "truth"), fresh_path(spark, "truth-state")
    predictions = _stream(spark, folder).select("event_id", F.col("ts").alias("timestamp"))
    outcome = (
        _stream(spark, folder)
        .where(F.col("event_type") == "purchase")
        .select(
            "event_id",
            (F.col("ts") + F.expr("interval 1 hour")).alias("truth_at"),
            F.lit(1).alias("label"),
        )
    )
    joined = truth.attach_truth_stream(predictions, outcome, "event_id", "label")
    query_ = (
        joined.writeStream.format("parquet")
        .option("checkpointLocation", marks)
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    read = spark.read.schema("event_id bigint, timestamp timestamp, ground_truth int").parquet(out)
    return read.where(F.col("ground_truth").isNotNull()).select("event_id", "ground_truth")


@query(
    f"""WITH s AS (SELECT *, {h13("'events|' || event_id")} AS h FROM events)
SELECT event_id, round(h / 4503599627370496.0::DOUBLE, 6) AS u FROM s"""
)
def hash_unit(spark, folder):
    """The seeded uniform draw behind every sampling operator."""
    return table(spark, folder, "events").select(
        "event_id", r6(scalars.hash_unit(F.lit("events"), "event_id")).alias("u")
    )
