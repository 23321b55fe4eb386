import pytest
from pyspark.sql import functions as F

from wanewatch.functions import rules, scalars
from wanewatch.operators import fallback, monitor, ranking, weights
from wanewatch.plans.preprocess import FeatureSpec, feature_table, fit_preprocessor
from wanewatch.session import lookup_join
from wanewatch.sources import files
from wanewatch.sources.tracking import Registry, RunLog
from wanewatch.streaming import count_window, truth, windows

REQUEST = {
    "gender": "Male",
    "tenure": 12,
    "InternetService": "Fiber optic",
    "OnlineSecurity": "No",
    "TechSupport": "No",
    "Contract": "Month-to-month",
    "PaymentMethod": "Electronic check",
    "MonthlyCharges": 70.35,
}


def one(spark, row):
    kinds = {str: "string", int: "int", float: "double"}
    ddl = ", ".join(f"{k} {kinds[type(v)]}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], ddl)


def rule(spark, row):
    df = one(spark, row)
    return df.select(
        rules.rule_probability(df.columns).alias("p"), rules.rule_prediction(df.columns).alias("y")
    ).first()


def test_rules(spark):
    assert tuple(rule(spark, REQUEST)) == (0.95, 1)
    assert tuple(rule(spark, {"gender": "Male"})) == (0.27, 0)
    assert rule(spark, {"tenure": 5})["p"] == 0.52
    assert rule(spark, {"MonthlyCharges": 70.0})["p"] == 0.27


def chain_on(spark, rows, **options):
    df = spark.createDataFrame(rows, "id int, p1 double, p2 double")
    chain = fallback.FallbackChain(**options)
    chain.add_handler(fallback.column_handler("first", "p1"))
    chain.add_handler(fallback.column_handler("second", "p2"))
    return chain, {r["id"]: r for r in chain.predict(df).collect()}


def test_ladder_order_threshold_and_failure(spark):
    rows = [(1, 0.3, 0.9), (2, 0.29, 0.9), (3, None, 0.5), (4, 0.1, 0.27), (5, float("nan"), 0.4)]
    _, found = chain_on(spark, rows)
    assert (found[1]["model_used"], found[1]["is_fallback"]) == ("first", False)
    assert found[1]["fallback_reason"] is None and found[1]["metadata"]["handler_index"] == "0"
    assert (found[2]["model_used"], found[2]["fallback_reason"]) == ("second", "low_confidence")
    assert found[3]["prediction"] == 0
    assert found[4]["model_used"] == "ultimate_fallback" and found[4]["probability"] == 0.5
    assert found[4]["fallback_reason"] == "model_error"
    assert found[5]["model_used"] == "second"


def test_symmetric_confidence(spark):
    _, found = chain_on(spark, [(1, 0.05, 0.9)], symmetric=True)
    assert found[1]["model_used"] == "first"


def test_base_rate_is_unreachable_by_default(spark):
    df = one(spark, {"tenure": 40})
    assert fallback.churn_ladder(df.columns).predict(df).first()["model_used"] == "ultimate_fallback"
    low = fallback.churn_ladder(df.columns, confidence=0.2).predict(df).first()
    assert low["model_used"] == "rules_based" and not low["is_fallback"]


def test_usage_and_summary_count_the_fixed_answer_differently(spark):
    rows = [(1, 0.9, 0.9), (2, 0.1, 0.9), (3, 0.1, 0.1), (4, 0.9, 0.1)]
    df = spark.createDataFrame(rows, "id int, p1 double, p2 double")
    chain, _ = chain_on(spark, rows)
    results = chain.predict(df, latency=F.col("id").cast("double"))
    usage = {r["model_used"]: r for r in chain.usage(results).collect()}
    assert usage["first"]["uses"] == 2 and usage["second"]["fallback_rate"] == 0.25
    row = fallback.fallback_summary(results).first()
    assert row["fallback_rate"] == 0.5 and row["avg_latency_ms"] == 2.5
    assert row["fallback_reasons"] == {"low_confidence": 1, "model_error": 1}
    nothing = fallback.fallback_summary(results.limit(0)).first()
    assert nothing["fallback_rate"] == 0 and nothing["avg_latency_ms"] == 0


def test_response_shape(spark):
    df = spark.createDataFrame([(None,), (0.0,), (0.4,)], "probability double")
    assert sorted(r[0] for r in fallback.respond(df).collect()) == [0.4, 0.5, 0.5]


def normal(spark, n, mean, std, seed):
    return spark.range(n).select(
        "id", *[(F.randn(seed * 10 + i) * std + mean).alias(f"f{i}") for i in range(5)]
    )


FEATURES = [f"f{i}" for i in range(5)]


def test_drift(spark):
    watch = monitor.Monitor("m", FEATURES)
    with pytest.raises(ValueError):
        watch.detect_drift(normal(spark, 10, 0, 1, 1), ["id"])
    watch.set_reference(normal(spark, 1000, 0, 1, 1))
    stats = watch.reference.first()
    assert stats["min"] <= stats["p25"] <= stats["p50"] <= stats["p75"] <= stats["max"]
    same = watch.detect_drift(normal(spark, 500, 0, 1, 2), ["id"], 0.5).first()
    assert not same["drift_detected"]
    moved = watch.detect_drift(normal(spark, 500, 5, 2, 3), ["id"], 0.5).first()
    assert moved["drift_detected"] and moved["drift_score"] > 0.5
    assert moved["features_drifted"] == 5
    few = watch.detect_drift(normal(spark, 10, 5, 2, 3), ["id"]).first()
    assert not few["drift_detected"] and few["reason"] == "Insufficient samples"
    assert watch.drift_history().count() == 3


def test_values_that_are_not_numbers(spark):
    """One such value is left out; it is neither drift nor an alert."""
    df = normal(spark, 1000, 0, 1, 1)
    hole = df.limit(1).withColumn("f0", F.lit(float("nan")))
    stats = {f: F.col(f) for f in FEATURES}
    plain = {r["feature"]: r["mean"] for r in monitor.moments(df, stats).collect()}
    mixed = {r["feature"]: r["mean"] for r in monitor.moments(df.unionByName(hole), stats).collect()}
    assert mixed["f0"] == pytest.approx(plain["f0"], abs=1e-9)
    verdict = monitor.drift(monitor.moments(df.unionByName(hole), stats), monitor.moments(df, stats))
    assert not verdict.first()["drift_detected"]
    watched = monitor.reference_stats(df.unionByName(hole), FEATURES)
    assert all(r["p75"] < 10 for r in watched.collect())
    nothing = long(spark, accuracy=float("nan"))
    assert monitor.alerts(nothing, long(spark, accuracy=0.9)).count() == 0


def test_one_hot_beyond_a_thousand_values(spark):
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("customerID"), (F.col("id") % 1500).cast("string").alias("city"),
        F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("label"),
    )
    rows = feature_table(df, fit_preprocessor(df, FeatureSpec(["x"], ["city"])), "customerID", "label")
    assert rows.first()["features"].size > 1500 and rows.count() == 3000


def long(spark, **values):
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "metric string, value double")


def test_alerts_health_and_report(spark):
    base = long(spark, accuracy=0.9, zero=0.0)
    high = monitor.alerts(long(spark, accuracy=0.8, zero=0.0, other=0.1), base)
    assert [(r["metric"], r["severity"]) for r in high.collect()] == [("accuracy", "HIGH")]
    assert monitor.alerts(long(spark, accuracy=0.88), base).count() == 0
    medium = monitor.alerts(long(spark, accuracy=0.84), base)
    assert medium.first()["severity"] == "MEDIUM"
    assert monitor.alerts_of(medium, "HIGH").count() == 0
    assert monitor.health("m", None, medium).first()["status"] == "HEALTHY"
    assert monitor.health("m", None, medium).first()["drift_status"] == "SKIPPED"
    assert monitor.health("m", None, high).first()["status"] == "CRITICAL"
    watch = monitor.monitor_for("m", FEATURES, normal(spark, 500, 0, 1, 1), base)
    watch.log_metrics(long(spark, accuracy=0.8))
    report = watch.report(normal(spark, 500, 9, 1, 2), ["id"]).first()
    assert report["status"] == "CRITICAL" and report["drift_status"] == "DRIFT"
    assert report["predictions_logged"] == 500 and report["alerts"][0]["metric"] == "accuracy"
    quiet = monitor.monitor_for("m", FEATURES, normal(spark, 500, 0, 1, 1), base)
    assert quiet.report(normal(spark, 500, 9, 1, 2), ["id"]).first()["status"] == "WARNING"


def test_log_rows_and_newest(spark):
    df = spark.createDataFrame([(i, i % 2, i / 20) for i in range(20)], "i int, y int, p double")
    log = monitor.prediction_log(
        df, at=F.lit("2024-01-01"), prediction=F.col("y"), probability=F.col("p"),
        features=["p"], extra=["i"],
    )
    assert set(monitor.LOG_COLUMNS) <= set(log.columns)
    kept = ranking.newest(log, 10, ["i"])
    assert sorted(r["i"] for r in kept.collect()) == list(range(10, 20))
    assert log.where("features_hash is null").count() == 0


def test_running_best_across_blocks_skips_missing(spark):
    scores = [0.5, None, 0.5, 0.7, 0.6, 0.9, 0.1]
    df = spark.createDataFrame(
        [("e", i, s) for i, s in enumerate(scores)], "exp string, epoch int, score double"
    )
    rows = ranking.running_best(df, "exp", "epoch", "score", block=2).orderBy("epoch").collect()
    assert [(r["epoch"], r["is_best"]) for r in rows] == [
        (0, True), (2, False), (3, True), (4, False), (5, True), (6, False),
    ]
    assert [r["previous_best"] for r in rows] == [None, 0.5, 0.5, 0.7, 0.7, 0.9]
    lows = ranking.running_best(df, "exp", "epoch", "score", "min", 2).where("is_best").collect()
    assert sorted(r["epoch"] for r in lows) == [0, 6]
    with pytest.raises(ValueError):
        ranking.running_best(df, "exp", "epoch", "score", "other")


def test_retention_and_best_model(spark):
    df = spark.createDataFrame([("a", i) for i in range(7)] + [("b", 1)], "exp string, seq int")
    marked = ranking.retention(df, ["exp"], "seq", 3)
    assert sorted((r["exp"], r["seq"]) for r in marked.where("kept").collect()) == [
        ("a", 4), ("a", 5), ("a", 6), ("b", 1),
    ]
    table = spark.createDataFrame(
        [("x", 0.5), ("y", None), ("z", 0.5)], "model string, f1 double"
    )
    assert ranking.best_model(table, "f1").first()["model"] == "x"


def test_weight_grids_and_ties(spark):
    assert len(weights.three_way_grid()) == 58 and len(weights.simplex_grid(4)) == 969
    df = spark.createDataFrame(
        [(1, 0.9, 0.9, 0.9), (0, 0.1, 0.1, 0.1), (1, None, 0.9, 0.9)],
        "label int, a double, b double, c double",
    )
    found = weights.weight_search(df, "label", ["a", "b", "c"])
    best = found.where("is_best").collect()
    assert len(best) == 1 and best[0]["candidate"] == 0 and best[0]["accuracy"] == 1.0
    nothing = weights.best_weights(df.limit(0), "label", ["a", "b", "c"])
    assert nothing == [1 / 3] * 3


def test_lookup_join_beyond_its_bound(spark):
    left = spark.range(50).withColumnRenamed("id", "k")
    right = left.withColumn("v", F.col("k") * 2)
    small = lookup_join(left, right, "k", "left", 100)
    large = lookup_join(left, right, "k", "left", 10)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_run_log_and_registry(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    log.log("r1", {"depth": None, "rate": 0.1}, {"f1": 0.5, "name": "x", "ok": True}, {"stage": "t"})
    assert [tuple(r) for r in log.metrics().collect()] == [("r1", "f1", 0.5)]
    assert log.params().where("kind = 'param' and text = 'None'").count() == 1
    registry = Registry(spark, str(tmp_path))
    with pytest.raises(ValueError):
        registry.promote("m")
    assert [registry.register("m") for _ in range(3)] == [1, 2, 3]
    assert registry.promote("m", version=2) == 2
    assert registry.promote("m", archive=True) == 3
    stages = {(r["version"], r["stage"]) for r in registry.latest().collect()}
    assert stages == {(1, "None"), (2, "Archived"), (3, "Production")}
    assert registry.latest(["Production"]).first()["version"] == 3


def test_results_document(spark, tmp_path):
    ranked = spark.createDataFrame([("a", 0.8), ("b", 0.7)], "model string, test_accuracy double")
    files.save_results(ranked, str(tmp_path), score="test_accuracy", target=0.785, at=F.lit("now"))
    row = spark.read.json(str(tmp_path / "json")).first()
    assert row["best_model"] == "a" and row["beats_target"] and len(row["results"]) == 2


EVENT_DDL = "event_id bigint, at timestamp, model string, value double"


def event_files(spark, path):
    """Three files, so the stream runs in several batches and windows get updated."""
    df = spark.range(900).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id div 3 as int), 0)").alias("at"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("other").alias("model"),
        (F.col("id") % 17).cast("double").alias("value"),
    )
    for i in range(3):
        part = df.where((F.col("event_id") >= i * 300) & (F.col("event_id") < (i + 1) * 300))
        part.coalesce(1).write.mode("append").parquet(path)
    return df


def stream_of(spark, path):
    return spark.readStream.schema(EVENT_DDL).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_windows_equal_batch(spark, tmp_path):
    df = event_files(spark, str(tmp_path / "in"))
    batch = windows.window_stats(df, "at", "value", ["model"], delay="2 hours")
    stream = windows.window_stats(
        stream_of(spark, str(tmp_path / "in")), "at", "value", ["model"], delay="2 hours"
    )
    seen = []
    windows.run_to_table(
        stream, str(tmp_path / "out"), str(tmp_path / "state"),
        on_batch=lambda b, n: seen.append(n),
    )
    newest = windows.newest_windows(spark, str(tmp_path / "out"), ["window_start", "model"])
    assert len(seen) >= 3
    assert sorted(map(tuple, newest.collect())) == sorted(map(tuple, batch.collect()))
    spread = windows.moments_of(batch).first()
    assert spread["std"] >= 0


def test_late_rows_are_dropped(spark, tmp_path):
    early = "timestamp'2024-01-01 00:00:00'"
    for hours, name in ((0, "a"), (50, "b"), (0, "c")):
        spark.range(5).select(
            F.col("id").alias("event_id"),
            F.expr(f"{early} + interval {hours} hours").alias("at"),
            F.lit(name).alias("model"),
            F.lit(1.0).alias("value"),
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    # file order decides the batches, so fix it by name order of arrival
    stream = windows.window_stats(
        stream_of(spark, str(tmp_path / "in")), "at", "value", ["model"], delay="1 hour"
    )
    windows.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    rows = windows.newest_windows(spark, str(tmp_path / "out"), ["window_start", "model"]).collect()
    assert "b" in {r["model"] for r in rows} and len(rows) <= 3


def test_count_window_equals_batch(spark, tmp_path):
    df = event_files(spark, str(tmp_path / "in"))
    states = count_window.count_window(
        stream_of(spark, str(tmp_path / "in")), "model", "event_id", "value", 40, salts=4
    )
    windows.run_to_table(states, str(tmp_path / "out"), str(tmp_path / "state"))
    newest = windows.newest_windows(spark, str(tmp_path / "out"), ["grp", "salt"])
    found = {r["grp"]: r for r in count_window.merge_count_windows(newest, 40).collect()}
    expected = ranking.newest(df, 40, ["event_id"], ["model"]).groupBy("model").agg(
        F.avg("value").alias("m"), F.stddev_pop("value").alias("s")
    )
    for row in expected.collect():
        assert found[row["model"]]["mean"] == pytest.approx(row["m"])
        assert found[row["model"]]["std"] == pytest.approx(row["s"])
        assert found[row["model"]]["kept"] == 40
    assert found["hot"]["seen"] == 300


def test_drift_per_micro_batch(spark, tmp_path):
    df = event_files(spark, str(tmp_path / "in"))
    reference = monitor.moments(df, {"value": F.col("value")})
    check = windows.drift_on_batch(reference, "value", str(tmp_path / "drift"))
    query = (
        stream_of(spark, str(tmp_path / "in"))
        .withColumn("value", F.col("value") * 3)
        .writeStream.option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .foreachBatch(check)
        .start()
    )
    query.awaitTermination()
    found = spark.read.json(str(tmp_path / "drift"))
    assert found.count() == 3 and found.where("drift_detected").count() == 3


def test_truth_batch_keeps_unmatched(spark):
    p = spark.createDataFrame([(1, 0.2), (2, 0.8)], "id int, p double")
    t = spark.createDataFrame([(2, 1)], "id int, y int")
    rows = {r["id"]: r["ground_truth"] for r in truth.attach_truth(p, t, "id", "y").collect()}
    assert rows == {1: None, 2: 1}
    assert windows.deduplicate(p.union(p), "id", "p").count() == 2


def test_small_helpers(spark):
    df = spark.createDataFrame([(0.5,), (5.0,), (50.0,)], "ms double")
    assert [r[0] for r in df.select(scalars.latency_band("ms")).collect()] == [
        "low", "moderate", "high",
    ]
    half = df.limit(1).select(
        scalars.positive(F.lit(0.5)), scalars.positive(F.lit(0.5), inclusive=True)
    ).first()
    assert tuple(half) == (0, 1)
    name = df.limit(1).select(
        scalars.time_stamped_name("run", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    ).first()[0]
    assert name == "run_20240102_030405"


def test_lookup_is_broadcast_only_within_its_bytes(spark):
    left = spark.range(50).select(F.col("id").alias("k"))
    wide = left.select("k", F.repeat(F.lit("x"), 1000).alias("t"), F.array("k").alias("l"), F.create_map(F.lit("a"), F.array(F.lit("b"))).alias("m"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    for right, small, large in ((wide, 100_000, 40_000), (left.withColumn("n", F.lit(1)), 10_000, 1_000)):
        for bound, expected in ((small, True), (large, False)):
            joined = lookup_join(left, right, "k", max_bytes=bound)
            assert hinted(joined) == expected and joined.count() == 50


def test_weights_beyond_the_grid(spark):
    """Only a narrow band of weights, between the points of the grid, calls every row right."""
    import numpy as np

    rng = np.random.default_rng(21)
    p = rng.random((400, 3))
    y = (p @ np.array([0.61, 0.02, 0.37]) > 0.5).astype(int)
    df = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(y, p)] + [(1, None, 0.5, 0.5)], "label int, a double, b double, c double").repartition(3)
    found = weights.optimise_weights(df, "label", ["a", "b", "c"])
    w = np.array(found["weights"])
    said = p @ w > 0.5
    f1 = 2 * (said & (y == 1)).sum() / (said.sum() + y.sum())
    assert found["score"] == pytest.approx(f1) and found["score"] > found["grid_score"]
    assert found["score"] > 0.99 and found["passes"] <= 20
    assert abs(w.sum() - 1) < 1e-9 and (w >= 0).all()
    kept = weights.optimise_weights(df, "label", ["a", "b", "c"], "accuracy", bounds=(0.2, 0.5), passes=6)
    assert all(0.2 - 1e-9 <= x <= 0.5 + 1e-9 for x in kept["weights"]) and kept["passes"] <= 6
    nothing = weights.optimise_weights(df.limit(0), "label", ["a", "b", "c"])
    assert nothing == {"weights": [1 / 3] * 3, "score": 0.0, "grid_score": 0.0, "passes": 1}
