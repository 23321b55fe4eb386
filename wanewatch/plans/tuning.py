"""Grid and random search with stratified folds, scored by F1 of class 1."""

from __future__ import annotations

import random
from itertools import product

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanewatch.operators.evaluate import fold_summary, metrics
from wanewatch.operators.split import class_weights, folds
from wanewatch.plans import presets
from wanewatch.plans.forest import BootstrapForest
from wanewatch.plans.trainer import out_of_fold

SEED = 42
PARALLEL = 4

# Full search grids in the vocabulary of the estimators.
FULL = {
    "xgboost": {
        "maxIter": [50, 100, 200, 300],
        "maxDepth": [3, 5, 7, 10],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "minHessian": [1.0, 3.0, 5.0],
        "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
        "featureShare": [0.7, 0.8, 0.9, 1.0],
        "regAlpha": [0.0, 0.1, 0.5, 1.0],
        "regLambda": [0.1, 0.5, 1.0, 2.0],
    },
    "lightgbm": {
        "maxIter": [50, 100, 200, 300],
        "maxDepth": [3, 5, 7, 10],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "maxLeaves": [15, 31, 63, 127],
        "minInstancesPerNode": [10, 20, 30, 50],
        "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
        "featureShare": [0.7, 0.8, 0.9, 1.0],
        "regAlpha": [0.0, 0.1, 0.5, 1.0],
        "regLambda": [0.1, 0.5, 1.0, 2.0],
    },
    "random_forest": {
        "numTrees": [50, 100, 200, 300],
        "maxDepth": [5, 10, 15, 20, 0],
        "minInstancesPerSplit": [2, 5, 10, 20],
        "minInstancesPerNode": [1, 2, 4, 8],
        "featureSubsetStrategy": ["sqrt", "log2", "all"],
        "classWeights": ["none", "balanced", "balanced_subsample"],
    },
    "gradient_boosting": {
        "maxIter": [50, 100, 200],
        "maxDepth": [3, 5, 7],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "minInstancesPerNode": [1, 2, 4],
        "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
        "featureSubsetStrategy": ["sqrt", "log2", "all"],
    },
}
# Reduced grids.
REDUCED = {
    "xgboost": {
        "maxIter": [100, 200],
        "maxDepth": [5, 7],
        "stepSize": [0.05, 0.1],
        "subsamplingRate": [0.8, 1.0],
        "featureShare": [0.8, 1.0],
        "regLambda": [0.5, 1.0],
    },
    "lightgbm": {
        "maxIter": [100, 200],
        "maxDepth": [5, 7],
        "stepSize": [0.05, 0.1],
        "maxLeaves": [31, 63],
        "subsamplingRate": [0.8, 1.0],
        "featureShare": [0.8, 1.0],
    },
    "random_forest": {
        "numTrees": [100, 200],
        "maxDepth": [10, 15],
        "minInstancesPerSplit": [5, 10],
        "minInstancesPerNode": [1, 2],
        "classWeights": ["none", "balanced"],
    },
    "gradient_boosting": {
        "maxIter": [100, 200],
        "maxDepth": [3, 5],
        "stepSize": [0.05, 0.1],
        "subsamplingRate": [0.8, 1.0],
    },
}


def base_model(name: str) -> Estimator:
    if name not in FULL:
        raise ValueError(f"unknown model: {name}")
    if name == "random_forest":
        return BootstrapForest(seed=SEED)
    if name == "gradient_boosting":
        return GBTClassifier(seed=SEED)
    return presets.make(name)


def combinations(grid: dict[str, list]) -> list[dict[str, object]]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _param_maps(estimator: Estimator, settings: list[dict[str, object]]) -> list[dict]:
    return [
        {estimator.getParam(k): v for k, v in s.items() if v is not None} for s in settings
    ]


def search(
    name: str,
    df: DataFrame,
    settings: list[dict[str, object]],
    k: int = 5,
    parallel: int = PARALLEL,
) -> tuple[object, DataFrame]:
    """Best model and one row per setting: params text and mean F1, best first."""
    estimator = base_model(name)
    evaluator = MulticlassClassificationEvaluator(
        metricName="fMeasureByLabel", metricLabel=1.0, labelCol="label"
    )
    rows = class_weights(folds(df, "key", "label", k), "label").persist()
    found = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=_param_maps(estimator, settings),
        evaluator=evaluator,
        numFolds=k,
        foldCol="fold",
        parallelism=parallel,
        seed=SEED,
    ).fit(rows)
    rows.unpersist()
    scores = [
        (name, i, str({p: v for p, v in s.items() if v is not None}), float(m))
        for i, (s, m) in enumerate(zip(settings, found.avgMetrics))
    ]
    table = df.sparkSession.createDataFrame(
        scores, "model string, setting int, params string, f1 double"
    )
    return found.bestModel, table.orderBy(F.col("f1").desc(), "setting")


def _rows_at(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet folder, -1 where there is none."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return -1


def search_kept(
    name: str, df: DataFrame, settings: list[dict[str, object]], path: str, k: int = 5
) -> DataFrame:
    """One row per setting with the mean and the deviation of its fold metrics, best F1 first.

    Every setting's out-of-fold probabilities (setting, key, label, fold, p) are written below
    ``path`` before anything is measured; all metrics come from them in one pass, and so can
    others later, without training again. A setting whose rows are all there is not trained again.
    Settings that bin rows alike share the binned rows of a fold.
    """
    spark, estimator = df.sparkSession, base_model(name)
    rows = class_weights(folds(df, "key", "label", k), "label").persist()
    n, binned = rows.count(), {}
    for i, chosen in enumerate(_param_maps(estimator, settings)):
        if _rows_at(spark, f"{path}/setting={i}") == n:
            continue
        scored = out_of_fold({"it": estimator.copy(chosen)}, rows, k, kept=binned, parallel=PARALLEL)
        kept = scored.select("key", "label", "fold", F.col("p_it").alias("p"))
        kept.write.mode("overwrite").parquet(f"{path}/setting={i}")
    for table in binned.values():
        table.blocks.unpersist()
    rows.unpersist()
    per_fold = metrics(spark.read.parquet(path), "label", "p", ["setting", "fold"])
    found = fold_summary(per_fold, "setting", "fold", ["accuracy", "f1", "roc_auc"])
    texts = [(i, name, str({p: v for p, v in s.items() if v is not None})) for i, s in enumerate(settings)]
    named = spark.createDataFrame(texts, "setting int, model string, params string")
    return named.join(found, "setting").orderBy(F.col("f1_mean").desc(), "setting")


def grid_search(
    name: str, df: DataFrame, grid: dict[str, list] | None = None, k: int = 5
) -> tuple[object, DataFrame]:
    base_model(name)
    return search(name, df, combinations(grid or REDUCED[name]), k)


def random_search(
    name: str, df: DataFrame, n_iter: int = 50, grid: dict[str, list] | None = None, k: int = 5
) -> tuple[object, DataFrame]:
    """Seeded draw of settings without repeats."""
    base_model(name)
    every = combinations(grid or FULL[name])
    drawn = random.Random(SEED).sample(every, min(n_iter, len(every)))
    return search(name, df, drawn, k)


class Tuner:
    """Tune several models and keep their results."""

    def __init__(self):
        self.models: dict[str, object] = {}
        self.tables: dict[str, DataFrame] = {}

    def tune(
        self,
        df: DataFrame,
        names: list[str] | None = None,
        method: str = "grid",
        k: int = 5,
        n_iter: int = 50,
        grids: dict[str, dict[str, list]] | None = None,
    ) -> DataFrame:
        """Best setting per model, best F1 first."""
        for name in names or list(FULL):
            grid = (grids or {}).get(name)
            if method == "grid":
                self.models[name], self.tables[name] = grid_search(name, df, grid, k)
            else:
                self.models[name], self.tables[name] = random_search(name, df, n_iter, grid, k)
        best = self.history().groupBy("model").agg(
            F.max_by(F.struct("params", "f1"), F.struct("f1", -F.col("setting"))).alias("r")
        )
        return best.select("model", "r.*").orderBy(F.col("f1").desc(), "model")

    def history(self) -> DataFrame:
        out = None
        for table in self.tables.values():
            out = table if out is None else out.unionByName(table)
        return out

    def tuned_model(self, name: str):
        if name not in self.models:
            raise ValueError(f"model {name} was not tuned")
        return self.models[name]

