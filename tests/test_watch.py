"""Stability index, sessions, stream alerts and pipeline stages on small tables."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from wanewatch.operators import stability
from wanewatch.plans import stages
from wanewatch.session import fresh_path
from wanewatch.streaming import alerts, sessions, windows


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def index_of(spark, reference, current, bins=4):
    edges = stability.reference_bins(reference, ["x"], bins)
    a, b = stability.bin_counts(reference, edges), stability.bin_counts(current, edges)
    return stability.stability(a, b, edges).first()


def test_index_of_same_shifted_and_empty_bins(spark):
    reference = numbers(spark, [float(i) for i in range(100)])
    assert index_of(spark, reference, reference)["psi"] == 0
    moved = index_of(spark, reference, numbers(spark, [99.0] * 50))
    # bins: missing and four quarters, all rows in the last one
    q = [0.5 / 52.5] * 4 + [50.5 / 52.5]
    p = [0.5 / 102.5] + [25.5 / 102.5] * 4
    assert moved["psi"] == pytest.approx(sum((b - a) * math.log(b / a) for a, b in zip(p, q)))
    assert moved["level"] == "major"


def test_index_of_missing_values_and_constant_columns(spark):
    holes = numbers(spark, [None, float("nan")] + [1.0] * 98)
    assert index_of(spark, numbers(spark, [1.0] * 98 + [None] * 2), holes)["psi"] == pytest.approx(0)
    assert index_of(spark, numbers(spark, [1.0] * 100), holes)["psi"] > 0
    nothing = stability.reference_bins(numbers(spark, [None, None]), ["x"])
    assert nothing.first()["edges"] == []


def test_windows_merge_by_addition(spark):
    df = spark.createDataFrame([(d, float(v)) for d in range(3) for v in range(d, 40)], "day int, x double")
    edges = stability.reference_bins(df, ["x"])
    by_day = stability.bin_counts(df, edges, ["day"])
    key = lambda r: (r["feature"], r["bin"], r["n"])
    assert sorted(map(key, stability.merged(by_day).collect())) == sorted(map(key, stability.bin_counts(df, edges).collect()))
    assert stability.stability(stability.merged(by_day), by_day, edges, ["day"]).count() == 3


START = datetime(2024, 1, 1)


def run_batches(spark, schema, batches, build, mode="append"):
    source, out, marks = (fresh_path(spark, k) for k in ("in", "out", "marks"))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        windows.run_to_table(build(spark.readStream.schema(schema).parquet(source)), out, marks, mode=mode)
    return spark.read.parquet(out)


def test_sessions_close_once_and_late_rows_are_dropped(spark):
    at = lambda m: START + timedelta(minutes=m)
    batches = [
        [(at(0), "a", 1.0), (at(20), "a", 2.0), (at(5), "b", 4.0)],
        [(at(45), "a", 3.0), (at(120), "b", 5.0)],
        [(at(1), "a", 100.0), (at(300), "c", 7.0)],  # the first row is late
        [(at(0), "a", 1.0), (at(20), "a", 2.0), (at(5), "b", 4.0)],  # a repeat of the first batch
    ]
    rows = run_batches(
        spark, "ts timestamp, who string, v double", batches,
        lambda s: sessions.sessions(s, "ts", ["who"], "v", gap="30 minutes"),
    ).collect()
    got = sorted((r["who"], r["session_start"], r["session_end"], r["n"], r["total"]) for r in rows)
    assert got == [("a", at(0), at(75), 3, 6.0), ("b", at(5), at(35), 1, 4.0), ("b", at(120), at(150), 1, 5.0)]


def test_alerts_stay_open_across_batches(spark):
    day = lambda d: START + timedelta(days=d)
    values = [[(0, 100.0)], [(1, 93.0), (2, 92.0)], [(1, 93.0), (2, 92.0)], [(3, 80.0)], [(4, 94.0), (5, 99.0)], [(2, 1.0)], [(6, 70.0)]]
    batches = [[("m", day(d), v) for d, v in b] + [("unknown", day(d), 0.0) for d, _ in b] for b in values]
    base = spark.createDataFrame([("m", 100.0), ("zero", 0.0)], "metric string, value double")
    found = run_batches(
        spark, "name string, day timestamp, v double", batches,
        lambda s: alerts.alert_changes(s, base, "name", "day", "v"),
    ).orderBy("at").collect()
    assert [(r["at"], r["change"], r["severity"]) for r in found] == [
        (day(1), "OPENED", "MEDIUM"), (day(3), "ESCALATED", "HIGH"), (day(4), "EASED", "MEDIUM"),
        (day(5), "RESOLVED", "NONE"), (day(6), "OPENED", "HIGH"),
    ]
    assert [r["opened_at"] for r in found] == [day(1)] * 4 + [day(6)]
    assert found[3]["worst_pct"] == pytest.approx(20) and found[4]["worst_pct"] == pytest.approx(30)
    assert [r["late"] for r in found] == [0, 2, 2, 2, 3]  # the repeated batch and the old value


def test_stages_fit_save_and_load(spark):
    rows = [("a", 1.0), ("b", 2.0), ("a", 3.0), (None, 4.0), ("c", None)]
    df = spark.createDataFrame(rows, "c string, y double")
    pipeline = Pipeline(
        stages=[
            stages.Hashing(inputCol="c", width=8), stages.Embedding(inputCol="c", dim=3), stages.LabelCodes(inputCol="c"),
            stages.TargetBins(inputCol="y", bins=2, strategy="uniform"),
        ]
    )
    again = fresh_path(spark, "unfitted")
    pipeline.write().save(again)
    model = Pipeline.load(again).fit(df)
    path = fresh_path(spark, "fitted")
    model.write().overwrite().save(path)
    fresh = spark.createDataFrame([*rows, ("never seen", 9.0)], "c string, y double")
    one, two = (m.transform(fresh).collect() for m in (model, PipelineModel.load(path)))
    assert sorted(map(str, one)) == sorted(map(str, two)) and len(one) == 6
    found = {r["c"]: r for r in one}
    assert found["a"]["c_code"] == 0 and found[None]["c_code"] == 3 and found["never seen"]["c_code"] is None
    assert found["never seen"]["c_vector"] == [0.0] * 3 and any(found["a"]["c_vector"])
    assert sum(abs(v) for v in found["never seen"]["c_hash"]) == 1
    assert (found["b"]["y_bin"], found["c"]["y_bin"], found["never seen"]["y_bin"]) == (0, None, 1)
    assert model.stages[3].edges() == [1.0, 2.5, 4.0]
    assert {f.metadata.get("x") for f in df.schema} == {None} and df.where(F.col("c") == "a").count() == 2
