"""End-to-end jobs: the churn pipeline, the trainer and the full experiment.

    spark-submit wanewatch/plans/experiment.py <subscribers.csv> <output folder>
"""

from __future__ import annotations

import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanewatch.operators.clean import clean
from wanewatch.operators.profile import profile
from wanewatch.operators.split import stratified_split
from wanewatch.plans import presets
from wanewatch.plans.benchmark import Benchmark, deployment_report
from wanewatch.plans.ensembles import ChurnPredictor, EnsembleModel, Stacking, WeightedVote
from wanewatch.plans.preprocess import (
    FeatureSpec,
    feature_table,
    fit_preprocessor,
    generic_spec,
    named_spec,
)
from wanewatch.plans.trainer import cross_validate, evaluate, train_all, with_probability
from wanewatch.plans.tuning import Tuner
from wanewatch.sources.files import read_subscribers, save_results, write_json
from wanewatch.sources.model_store import load_model, save_model
from wanewatch.sources.tracking import RunLog

SPLIT = {"train": 0.7, "val": 0.1, "test": 0.2}
PREDICTOR_SPLIT = {"train": 0.68, "val": 0.12, "test": 0.2}


def data_quality_flow(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return profile(read_subscribers(spark, path))


def prepared_parts(
    df: DataFrame,
    shares: dict[str, float],
    spec: FeatureSpec | None = None,
    fit_on_all: bool = False,
) -> tuple[object, dict[str, DataFrame]]:
    """Fitted preprocessor and feature tables by part.

    It is fitted on the first part only; ``fit_on_all`` reproduces fitting before the split.
    """
    parts = stratified_split(df, "customerID", "label", shares)
    first = next(iter(shares))
    train = df if fit_on_all else parts.where(F.col("part") == first)
    model = fit_preprocessor(train, spec or generic_spec(df))
    tables = {
        p: feature_table(parts.where(F.col("part") == p), model, "customerID", "label")
        for p in shares
    }
    return model, tables


def churn_pipeline(
    raw: DataFrame, rebalancing: str | None = "SMOTE", **shrink
) -> tuple[object, EnsembleModel, float]:
    """Clean, prepare, rebalance the training part, fit the vote, score the test part."""
    df = clean(raw, keep_key=True).persist()
    prepared, parts = prepared_parts(df, {"train": 0.8, "test": 0.2}, named_spec())
    model = EnsembleModel("voting", rebalancing, **shrink).fit(parts["train"])
    return prepared, model, model.score(parts["test"])


def train_predictor(
    raw: DataFrame, path: str | None = None, **shrink
) -> tuple[ChurnPredictor, dict[str, float]]:
    """Three-model predictor on a 68/12/20 split; saved below ``path`` if given."""
    df = clean(raw, keep_key=True).persist()
    prepared, parts = prepared_parts(df, PREDICTOR_SPLIT)
    model = ChurnPredictor(**shrink).fit(parts["train"], parts["val"])
    found = model.evaluate(parts["test"])
    if path:
        save_model(prepared, f"{path}/preprocessor")
        model.save(f"{path}/predictor")
    return model, found


def score_stored(
    spark: SparkSession, raw: DataFrame, preprocessor: str, model: str, log: RunLog | None = None
) -> dict[str, float]:
    """Load a stored pipeline and model, score new labelled rows, log the metrics."""
    df = clean(raw, keep_key=True).persist()
    rows = feature_table(df, load_model(preprocessor), "customerID", "label")
    found = evaluate(with_probability(rows, load_model(model), "stored"), "p_stored")
    if log is not None:
        log.log("evaluation", metrics=found)
    return found


def run_experiment(
    raw: DataFrame, path: str, tuning: bool = False, k: int = 5, **shrink
) -> DataFrame:
    """Train, cross-validate, optionally tune, combine, benchmark and report.

    Returns the benchmark rows, best test accuracy first; files go below ``path``.
    """
    spark = raw.sparkSession
    df = clean(raw, keep_key=True).persist()
    prepared, parts = prepared_parts(df, SPLIT)
    train, val, test = (parts[p].persist() for p in ("train", "val", "test"))
    log = RunLog(spark, f"{path}/tracking")

    fitted, base = train_all(presets.default_models(**shrink), train, val)
    base.write.mode("overwrite").json(f"{path}/base_models")
    cross_validate(presets.default_models(**shrink), train, k).write.mode("overwrite").json(
        f"{path}/cross_validation"
    )
    if tuning:
        tuner = Tuner()
        write_json(tuner.tune(train, k=k), f"{path}/tuning_best")
        write_json(tuner.history(), f"{path}/tuning_history")

    bench = Benchmark()
    for name, estimator in presets.default_models(**shrink).items():
        bench.model(name, estimator, train, test, k)
    models = presets.ensemble_models(**shrink)
    ensembles = {
        "Ensemble (Weighted Voting)": WeightedVote(models),
        "Ensemble (Stacking)": Stacking(models),
    }
    for name, made in ensembles.items():
        bench.ensemble(name, made, train, val, test)

    results = bench.table(raw)
    now = F.lit(datetime.now(timezone.utc).isoformat())
    save_results(
        results, f"{path}/benchmark", score="test_accuracy", target=bench.target, at=now
    )
    write_json(deployment_report(results), f"{path}/deployment")
    for row in bench.rows:
        log.log(row["model"], metrics=row, tags={"stage": "benchmark"})
    best = max(bench.rows, key=lambda r: r["test_f1"])["model"]
    save_model(prepared, f"{path}/preprocessor")
    if best in fitted:
        save_model(fitted[best], f"{path}/best_model")
    else:
        ensembles[best].save(f"{path}/best_model")
    return results


if __name__ == "__main__":
    session = SparkSession.builder.appName("wanewatch-experiment").getOrCreate()
    run_experiment(read_subscribers(session, sys.argv[1]), sys.argv[2]).show(truncate=False)
