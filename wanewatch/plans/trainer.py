"""Train, score and cross-validate classifiers on (key, features, label) tables."""

from __future__ import annotations

import logging
import time
from collections import Counter
from functools import partial

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.operators.evaluate import fold_summary, metrics
from wanewatch.operators.split import class_weights, folds
from wanewatch.plans.boosting import BoostedTrees
from wanewatch.session import at_once

log = logging.getLogger(__name__)

METRICS = ["accuracy", "precision", "recall", "f1", "specificity", "roc_auc"]
COUNTS = ["tn", "fp", "fn", "tp"]


def with_probability(df: DataFrame, model, name: str) -> DataFrame:
    """Add ``p_<name>``, the probability of class 1; helper columns of the model go."""
    scored = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return scored.select(*[F.col(c) for c in df.columns], p.alias(f"p_{name}"))


def fit(estimator: Estimator, train: DataFrame):
    """Fit; an estimator that asks for class weights gets them."""
    return estimator.fit(_weighted(estimator, train))


def _weighted(estimator: Estimator, train: DataFrame) -> DataFrame:
    if estimator.hasParam("weightCol") and estimator.isDefined(estimator.getParam("weightCol")):
        if estimator.getOrDefault(estimator.getParam("weightCol")) == "weight":
            return class_weights(train, "label")
    return train


def fit_all(models: dict[str, Estimator], train: DataFrame) -> dict[str, object]:
    """Fitted models by name; boosted models that bin rows alike share one pass of binning."""
    alike = Counter(e.binning() for e in models.values() if isinstance(e, BoostedTrees))
    shared, fitted = {}, {}
    try:
        for name, estimator in models.items():
            way = estimator.binning() if isinstance(estimator, BoostedTrees) else None
            if alike[way] < 2 and way not in shared:
                fitted[name] = fit(estimator, train)
                continue
            if way not in shared:
                shared[way] = estimator.binned(_weighted(estimator, train))
            alike[way] -= 1
            fitted[name] = estimator.fit_binned(shared[way], last=not alike[way])
    finally:
        for table in shared.values():
            table.blocks.unpersist()
    return fitted


def evaluate(scored: DataFrame, probability: str) -> dict[str, float]:
    """Metrics of one probability column as a plain dict."""
    row = metrics(scored, "label", probability, []).first()
    found = row.asDict() if row else {}
    return {k: found.get(k, 0) for k in [*METRICS, *COUNTS]}


def train_model(
    name: str, estimator: Estimator, train: DataFrame, validation: DataFrame
) -> tuple[object, dict]:
    """Fitted model and its validation metrics with the fitting time."""
    start = time.monotonic()
    model = fit(estimator, train)
    seconds = time.monotonic() - start
    found = evaluate(with_probability(validation, model, name), f"p_{name}")
    return model, {"model": name, **found, "train_seconds": seconds}


def train_all(
    models: dict[str, Estimator], train: DataFrame, validation: DataFrame
) -> tuple[dict[str, object], DataFrame]:
    """Fitted models and one metric row per model, best F1 first; a failing model is skipped."""
    train, validation = train.persist(), validation.persist()
    fitted, rows = {}, []
    for name, estimator in models.items():
        try:
            fitted[name], row = train_model(name, estimator, train, validation)
            rows.append(row)
        except Exception as error:
            log.warning("%s not trained: %s", name, error)
    table = metric_table(train, rows).orderBy(F.col("f1").desc(), "model")
    train.unpersist()
    validation.unpersist()
    return fitted, table


def metric_table(like: DataFrame, rows: list[dict]) -> DataFrame:
    """One row per model from plain dicts."""
    doubles = [*METRICS, "train_seconds"]
    ddl = "model string, " + ", ".join(f"{m} double" for m in doubles)
    ddl += ", " + ", ".join(f"{c} bigint" for c in COUNTS)
    values = [
        (r["model"], *[float(r.get(m) or 0.0) for m in doubles], *[int(r.get(c) or 0) for c in COUNTS])
        for r in rows
    ]
    return like.sparkSession.createDataFrame(values, ddl)


def out_of_fold(
    models: dict[str, Estimator], df: DataFrame, k: int = 5, fold: str = "fold", kept: dict | None = None, parallel: int = 1
) -> DataFrame:
    """Rows with ``p_<name>`` from models that did not see the row; every key exactly once.

    Calls on the same rows may pass one dict, ``kept``: rows of a fold are then binned once for all models
    that bin alike, and are the caller's to give up. So many folds as ``parallel`` says are fitted at a time.
    """
    df = df.persist()

    def fitted(i: int) -> dict[str, object]:
        rest = df.where(F.col(fold) != i)
        if kept is None:
            return {name: fit(estimator, rest) for name, estimator in models.items()}
        made = {}
        for name, estimator in models.items():
            if not hasattr(estimator, "fit_binned"):
                made[name] = fit(estimator, rest)
                continue
            way = (i, type(estimator), estimator.binning())
            if way not in kept:
                kept[way] = estimator.binned(_weighted(estimator, rest))
            made[name] = estimator.fit_binned(kept[way], last=False)
        return made

    out = None
    for i, made in enumerate(at_once(df.sparkSession, [partial(fitted, i) for i in range(k)], parallel)):
        held = df.where(F.col(fold) == i)
        for name, model in made.items():
            held = with_probability(held, model, name)
        out = held if out is None else out.unionByName(held)
    return out


def cross_validate(models: dict[str, Estimator], df: DataFrame, k: int = 5) -> DataFrame:
    """Mean and deviation of fold metrics per model, best F1 first."""
    scored = out_of_fold(models, folds(df, "key", "label", k), k)
    pairs = [F.struct(F.lit(n).alias("model"), F.col(f"p_{n}").alias("p")) for n in models]
    long = scored.select("fold", "label", F.inline(F.array(*pairs)))
    per_fold = metrics(long, "label", "p", ["model", "fold"])
    summary = fold_summary(per_fold, "model", "fold", ["accuracy", "f1", "roc_auc"])
    return summary.orderBy(F.col("f1_mean").desc(), "model")
