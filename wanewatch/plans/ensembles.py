"""Voting, weighted voting, stacking, blending and bagging over any probability model.

Base models are chained on one table, so their probabilities meet in the same row and no
positional or keyed join is needed.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.ml import Estimator, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.functions.scalars import hash_unit, positive, weighted_mean
from wanewatch.operators.evaluate import long_scores, metrics
from wanewatch.operators.rebalance import rebalance
from wanewatch.operators.split import SEED, folds, stratified_split
from wanewatch.operators.weights import best_weights
from wanewatch.plans import presets
from wanewatch.plans.boosting import BLOCK_ROWS
from wanewatch.plans.trainer import evaluate, fit_all, metric_table, out_of_fold, with_probability
from wanewatch.session import at_once, cut_lineage
from wanewatch.sources.model_store import load_model, load_state, save_model, save_state

# Cumulative probability of at most j events, Poisson with mean one, as far as doubles tell it from 1.
POISSON_ONE = list(accumulate(math.exp(-1) / math.factorial(j) for j in range(17)))


class Ensemble:
    """Fitted base models plus the rule that combines their probabilities."""

    def __init__(self, models: dict[str, Estimator] | None = None):
        self.models = models or presets.ensemble_models()
        self.fitted: dict[str, Transformer] = {}

    def set_base_models(self, models: dict[str, Estimator]) -> None:
        self.models = models

    def fit_base(self, train: DataFrame) -> None:
        self.fitted = fit_all(self.models, train)

    def base_probabilities(self, df: DataFrame) -> DataFrame:
        """Add ``p_<name>`` for every base model."""
        if not self.fitted:
            raise ValueError("fit the ensemble first")
        for name, model in self.fitted.items():
            df = with_probability(df, model, name)
        return df

    @property
    def columns(self) -> list[str]:
        return [f"p_{name}" for name in self.models]

    def combine(self, df: DataFrame) -> DataFrame:
        """Add ``p`` from the base probabilities."""
        raise NotImplementedError

    def predict(self, df: DataFrame) -> DataFrame:
        """Add p (probability of class 1) and prediction."""
        kept = df.columns
        scored = self.combine(self.base_probabilities(df))
        return scored.select(*kept, "p").withColumn("prediction", positive("p"))

    def score(self, df: DataFrame) -> float:
        """Accuracy on labelled rows."""
        return self.evaluate(df)["accuracy"]

    def evaluate(self, df: DataFrame) -> dict[str, float]:
        return evaluate(self.predict(df), "p")

    def state(self) -> dict[str, object]:
        return {}

    def save(self, path: str) -> None:
        """Every fitted model below the path, the rest as one JSON row."""
        for name, model in self.fitted.items():
            save_model(model, f"{path}/base/{name}")
        first = next(iter(self.fitted.values()))
        spark = getattr(first, "sparkSession", None)
        if spark is None:
            from pyspark.sql import SparkSession

            spark = SparkSession.getActiveSession()
        save_state(spark, f"{path}/state", {"names": list(self.fitted), **self.state()})

    def load(self, spark, path: str) -> "Ensemble":
        state = load_state(spark, f"{path}/state")
        self.fitted = {n: load_model(f"{path}/base/{n}") for n in state["names"]}
        self.models = dict.fromkeys(state["names"])
        self.restore(path, state)
        return self

    def restore(self, path: str, state: dict[str, object]) -> None:
        """Take up what ``state`` gave."""


class WeightedVote(Ensemble):
    """Average of base probabilities; weights equal or searched for on validation rows."""

    weights: list[float] | None = None

    def fit(
        self,
        train: DataFrame,
        validation: DataFrame | None = None,
        optimize: bool = True,
        metric: str = "f1",
        grid: list[tuple[float, ...]] | None = None,
    ) -> "WeightedVote":
        self.fit_base(train)
        self.weights = [1.0 / len(self.models)] * len(self.models)
        if validation is not None and optimize:
            scored = self.base_probabilities(validation)
            self.weights = best_weights(scored, "label", self.columns, grid, metric)
        return self

    def combine(self, df: DataFrame) -> DataFrame:
        if self.weights is None:
            raise ValueError("fit the ensemble first")
        return df.withColumn("p", weighted_mean(self.columns, self.weights))

    def state(self):
        return {"weights": self.weights}

    def restore(self, path, state):
        self.weights = state["weights"]


class Stacking(Ensemble):
    """A meta-learner over out-of-fold base probabilities, optionally with the features."""

    def __init__(
        self,
        models: dict[str, Estimator] | None = None,
        meta: Estimator | None = None,
        use_features: bool = False,
        k: int = 5,
    ):
        super().__init__(models)
        self.meta = meta or LogisticRegression(maxIter=1000)
        self.use_features = use_features
        self.k = k
        self.meta_model = None

    def held_out(self, train: DataFrame, parallel: int = 1) -> DataFrame:
        """Out-of-fold base probabilities, what the meta-learner learns from."""
        return out_of_fold(self.models, folds(train, "key", "label", self.k), self.k, parallel=parallel)

    def fit(
        self, train: DataFrame, held_out: DataFrame | None = None, fitted: dict[str, Transformer] | None = None
    ) -> "Stacking":
        """``held_out`` and ``fitted`` may be those of another ensemble of the same models and rows."""
        self.fit_meta(self.held_out(train) if held_out is None else held_out)
        if fitted is None:
            self.fit_base(train)
        else:
            self.fitted = dict(fitted)
        return self

    def fit_meta(self, scored: DataFrame) -> None:
        """Fit the meta-learner.

        Probabilities alone are few numbers a row and written first: a meta-learner reads its rows
        several times, and the base models' Python workers would stay beside its own in every task.
        """
        rows = self.meta_rows(scored).drop("_original")
        self.meta_model = self.meta.fit(rows if self.use_features else cut_lineage(rows))

    def meta_rows(self, scored: DataFrame) -> DataFrame:
        inputs = self.columns + (["_original"] if self.use_features else [])
        renamed = scored.withColumnRenamed("features", "_original")
        return VectorAssembler(inputCols=inputs, outputCol="features").transform(renamed)

    def combine(self, df: DataFrame) -> DataFrame:
        if self.meta_model is None:
            raise ValueError("fit the ensemble first")
        scored = with_probability(self.meta_rows(df), self.meta_model, "meta")
        return scored.drop("features").withColumnRenamed("_original", "features").withColumnRenamed(
            "p_meta", "p"
        )

    def state(self):
        return {"use_features": self.use_features}

    def save(self, path):
        super().save(path)
        save_model(self.meta_model, f"{path}/meta")

    def restore(self, path, state):
        self.use_features = state["use_features"]
        self.meta_model = load_model(f"{path}/meta")


class Blending(Stacking):
    """A meta-learner fitted on a blend part the base models did not see."""

    def __init__(self, models=None, meta: Estimator | None = None):
        super().__init__(models, meta or GBTClassifier(maxIter=100, maxDepth=3, seed=SEED))

    def fit(self, train: DataFrame, blend: DataFrame | None = None) -> "Blending":
        if blend is None:
            parts = stratified_split(train, "key", "label", {"base": 0.7, "blend": 0.3})
            train = parts.where("part = 'base'").drop("part")
            blend = parts.where("part = 'blend'").drop("part")
        self.fit_base(train)
        self.fit_meta(self.base_probabilities(blend))
        return self


class Bagging(Ensemble):
    """One estimator on bootstrap samples; a row's weight per bag is Poisson(1) by hash."""

    def __init__(self, estimator: Estimator | None = None, bags: int = 10):
        made = estimator or presets.make("xgboost")
        super().__init__({f"bag{i}": made for i in range(bags)})

    def fit(self, train: DataFrame) -> "Bagging":
        for i, (name, estimator) in enumerate(self.models.items()):
            u = hash_unit(F.lit(f"{SEED}b{i}"), "key")
            drawn = sum(((u >= F.lit(c)).cast("double") for c in POISSON_ONE), F.lit(0.0))
            bag = train.withColumn("_drawn", drawn).where(F.col("_drawn") > 0)
            weighted = estimator.copy({estimator.getParam("weightCol"): "_drawn"})
            self.fitted[name] = weighted.fit(bag)
        return self

    def combine(self, df: DataFrame) -> DataFrame:
        return df.withColumn("p", weighted_mean(self.columns, [1.0] * len(self.columns)))


class EnsembleModel:
    """Voting, stacking or bagging behind one interface, with optional rebalancing."""

    def __init__(
        self,
        ensemble_type: str = "voting",
        rebalancing: str | None = None,
        **shrink,
    ):
        self.ensemble_type = ensemble_type
        self.rebalancing = rebalancing
        self.shrink = shrink
        self.model: Ensemble | None = None

    def _base(self) -> dict[str, Estimator]:
        names = ("xgboost", "lightgbm", "random_forest")
        return {n: presets.make(n, presets.shrink_options(n, self.shrink)) for n in names}

    def fit(self, train: DataFrame) -> "EnsembleModel":
        """``train`` is (key, features, label); rebalancing touches nothing else."""
        if self.ensemble_type not in ("voting", "stacking", "bagging"):
            raise ValueError(f"unknown ensemble type: {self.ensemble_type}")
        rows = rebalanced_features(train, self.rebalancing).persist()
        boosted = presets.make("xgboost", presets.shrink_options("xgboost", self.shrink))
        if self.ensemble_type == "voting":
            self.model = WeightedVote(self._base()).fit(rows, optimize=False)
        elif self.ensemble_type == "stacking":
            self.model = Stacking(self._base(), meta=boosted, k=3).fit(rows)
        else:
            self.model = Bagging(boosted).fit(rows)
        rows.unpersist()
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("fit the model first")
        return self.model.predict(df)

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Add p0 and p1."""
        return self.predict(df).select("*", (1 - F.col("p")).alias("p0"), F.col("p").alias("p1"))

    def score(self, df: DataFrame) -> float:
        return evaluate(self.predict(df), "p")["accuracy"]


def rebalanced_features(train: DataFrame, strategy: str | None) -> DataFrame:
    """(key, features, label) after rebalancing; synthetic rows get keys of their own."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    if strategy not in ("SMOTE", "ADASYN", "undersample"):
        return train.select("key", "features", "label")
    dense = train.select(
        F.col("key").cast("bigint").alias("key"),
        vector_to_array("features").alias("vector"),
        "label",
    )
    made = rebalance(dense, "key", "label", "vector", strategy)
    name = F.concat_ws("#", F.col("key").cast("string"), F.when(F.col("copy") > 0, F.col("copy")))
    return made.select(
        name.alias("key"), array_to_vector("vector").alias("features"), "label"
    )


def compare_ensembles(
    models: dict[str, Estimator], train: DataFrame, validation: DataFrame, k: int = 5, parallel: int = 1
) -> DataFrame:
    """Metrics of weighted vote, stacking and stacking with features, best F1 first.

    All three have the same base models and folds: these are fitted once, and the out-of-fold
    probabilities are written once. With ``parallel`` so many folds are fitted at a time, beside the models of all
    rows. Rows are drawn together into partitions of about a block, as every step of a fit is a job.
    """
    train = train.coalesce(max(1, -(-train.count() // BLOCK_ROWS))).persist()
    made = {
        "weighted_voting": WeightedVote(models),
        "stacking": Stacking(models, k=k),
        "stacking_features": Stacking(models, use_features=True, k=k),
    }
    ways = [
        lambda: made["weighted_voting"].fit(train, validation),
        lambda: cut_lineage(made["stacking"].held_out(train, parallel)),
    ]
    vote, held_out = at_once(train.sparkSession, ways, parallel)
    for name in ("stacking", "stacking_features"):
        made[name].fit(train, held_out, vote.fitted)
    train.unpersist()
    rows = [{"model": name, **e.evaluate(validation)} for name, e in made.items()]
    return metric_table(train, rows).orderBy(F.col("f1").desc(), "model")


class ChurnPredictor(WeightedVote):
    """Three tuned models with weights searched for accuracy."""

    def __init__(self, models: dict[str, Estimator] | None = None, **shrink):
        super().__init__(models or presets.predictor_models(**shrink))
        self.training_metrics: dict[str, float] = {}

    def fit(self, train: DataFrame, validation: DataFrame | None = None, k: int = 5):
        """Weights from the validation rows, or from out-of-fold predictions without any."""
        self.fit_base(train)
        if validation is not None:
            scored = self.base_probabilities(validation)
        else:
            scored = out_of_fold(self.models, folds(train, "key", "label", k), k)
        self.weights = best_weights(scored, "label", self.columns, metric="accuracy")
        self.training_metrics = self.evaluate(train)
        return self

    def individual_scores(self, df: DataFrame) -> DataFrame:
        """Metrics and weight of each base model and of the ensemble."""
        scored = self.combine(self.base_probabilities(df))
        names = {n: f"p_{n}" for n in self.models}
        long = long_scores(scored, "key", "label", {**names, "ENSEMBLE": "p"})
        weight = F
        for name, w in zip(self.models, self.weights):
            weight = weight.when(F.col("model") == name, F.lit(float(w)))
        return metrics(long, "label", "p", ["model"]).withColumn("weight", weight.otherwise(1.0))

    def feature_importance(self, names: list[str] | None = None) -> DataFrame:
        """(feature, importance): weighted over the models that have importances, sum one."""
        rows = []
        for (name, model), w in zip(self.fitted.items(), self.weights):
            found = getattr(model, "featureImportances", None)
            if found is not None:
                rows += [(name, i, w * float(v)) for i, v in enumerate(found.toArray())]
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        table = spark.createDataFrame(rows, "model string, i int, imp double")
        labels = names or [f"feature_{i}" for i in range(1 + max((r[1] for r in rows), default=-1))]
        listed = spark.createDataFrame(list(enumerate(labels)), "i int, feature string")
        total = sum(r[2] for r in rows) or 1.0
        return (
            table.groupBy("i")
            .agg((F.sum("imp") / F.lit(total)).alias("importance"))
            .join(listed, "i")
            .select("feature", "importance")
            .orderBy(F.col("importance").desc(), "feature")
        )
