"""Training, ensemble, search and model-store queries.

Presets are shrunk so that a check stays short; the rows trained on and scored are all rows.
Where a model's own numbers have no SQL form, the keys, labels and folds it must cover do.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wanewatch.catalog.feature_queries import ORDER, ORDERED
from wanewatch.catalog.registry import on_clean, query, r6
from wanewatch.operators.split import folds, stratified_split
from wanewatch.plans import ensembles, experiment, presets, trainer, tuning
from wanewatch.plans.benchmark import Benchmark
from wanewatch.plans.preprocess import feature_table, fit_preprocessor, named_spec
from wanewatch.session import fresh_path
from wanewatch.sources.model_store import BestCheckpoint, Checkpoints, load_model, save_model
from wanewatch.sources.subscribers import clean_subscribers, subscribers

SMALL = {"trees": 3, "depth": 3, "rounds": 20}
SPLIT = {"train": 0.8, "test": 0.2}


def _features(spark, folder):
    df = clean_subscribers(spark, folder).persist()
    made = feature_table(df, fit_preprocessor(df, named_spec()), "customerID", "label")
    return made.persist()


def _parts(spark, folder, shares=SPLIT):
    df = clean_subscribers(spark, folder).persist()
    _, parts = experiment.prepared_parts(df, shares, named_spec())
    return {name: part.persist() for name, part in parts.items()}


def _two() -> dict:
    return {n: presets.make(n, SMALL) for n in ("xgboost", "random_forest")}


def _covered(scored):
    """(key, label, valid): the row was scored with a probability and a class."""
    valid = F.col("p").between(0.0, 1.0) & F.col("prediction").isin(0, 1)
    return scored.select("key", "label", valid.alias("valid"))


TEST_ROWS = on_clean(
    """SELECT "customerID" AS key, label, TRUE AS valid FROM ordered
WHERE rn > n - CAST(floor(n * 0.2::DOUBLE + 0.5::DOUBLE) AS BIGINT)""",
    ORDERED,
)


@query(on_clean('SELECT "customerID" AS key, label, TRUE AS finite FROM clean'))
def feature_vectors(spark, folder):
    """Named preprocessor over all rows: one finite vector per row."""
    from pyspark.ml.functions import vector_to_array

    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    finite = total.isNotNull() & ~F.isnan(total)
    return _features(spark, folder).select("key", "label", finite.alias("finite"))


@query()
def train_models(spark, folder):
    """Six presets, best F1 first."""
    parts = _parts(spark, folder)
    _, table = trainer.train_all(presets.default_models(**SMALL), parts["train"], parts["test"])
    return table.drop("train_seconds")


@query()
def cross_validation(spark, folder):
    summary = trainer.cross_validate(_two(), _features(spark, folder), 3)
    return summary.select("model", "accuracy_mean", "accuracy_std", "f1_mean", "roc_auc_mean")


@query(
    on_clean(
        """SELECT "customerID" AS key, label, CASE WHEN rn <= n // 3 THEN 0 WHEN rn <= n * 2 // 3 THEN 1 ELSE 2 END AS fold,
  TRUE AS valid FROM ordered""",
        ORDERED,
    )
)
def out_of_fold(spark, folder):
    """Every row scored exactly once, by models that did not see it."""
    df = folds(_features(spark, folder), "key", "label", 3)
    scored = trainer.out_of_fold(_two(), df, 3)
    valid = F.col("p_xgboost").between(0.0, 1.0) & F.col("p_random_forest").between(0.0, 1.0)
    return scored.select("key", "label", "fold", valid.alias("valid"))


@query(TEST_ROWS)
def voting_smote(spark, folder):
    """Soft vote after synthetic rebalancing of the training part."""
    parts = _parts(spark, folder)
    model = ensembles.EnsembleModel("voting", "SMOTE", **SMALL).fit(parts["train"])
    return _covered(model.predict(parts["test"]))


@query(TEST_ROWS)
def stacking_ensemble(spark, folder):
    parts = _parts(spark, folder)
    made = ensembles.Stacking(_two(), use_features=True, k=3).fit(parts["train"])
    return _covered(made.predict(parts["test"]))


@query(TEST_ROWS)
def blending_ensemble(spark, folder):
    parts = _parts(spark, folder)
    made = ensembles.Blending(_two(), meta=presets.make("xgboost", SMALL)).fit(parts["train"])
    return _covered(made.predict(parts["test"]))


@query(TEST_ROWS)
def bagging_undersampled(spark, folder):
    parts = _parts(spark, folder)
    model = ensembles.EnsembleModel("bagging", "undersample", trees=1, depth=2)
    return _covered(model.fit(parts["train"]).predict(parts["test"]))


@query()
def compare_ensembles(spark, folder):
    """Weighted vote, stacking, stacking with features: the four presets of the ensemble as they are, five folds."""
    parts = _parts(spark, folder)
    found = ensembles.compare_ensembles(presets.ensemble_models(), parts["train"], parts["test"], k=5, parallel=5)
    return found.drop("train_seconds")


@query()
def churn_predictor(spark, folder):
    """Three tuned models, weights searched on the validation part, scores of each."""
    parts = _parts(spark, folder, experiment.PREDICTOR_SPLIT)
    model = ensembles.ChurnPredictor(**SMALL).fit(parts["train"], parts["val"])
    return model.individual_scores(parts["test"])


@query()
def feature_importance(spark, folder):
    parts = _parts(spark, folder, experiment.PREDICTOR_SPLIT)
    model = ensembles.ChurnPredictor(**SMALL).fit(parts["train"], parts["val"])
    return model.feature_importance()


@query()
def grid_search(spark, folder):
    grid = {"numTrees": [2, 4], "maxDepth": [2], "weightCol": [None, "weight"]}
    return tuning.grid_search("random_forest", _features(spark, folder), grid, 3)[1]


@query()
def random_search(spark, folder):
    grid = {"maxIter": [1, 2, 3], "maxDepth": [2, 3], "stepSize": [0.05, 0.1]}
    return tuning.random_search("gradient_boosting", _features(spark, folder), 2, grid, 3)[1]


@query()
def benchmark_models(spark, folder):
    """Benchmark rows of one model and one ensemble on a 70/10/20 split."""
    parts = _parts(spark, folder, experiment.SPLIT)
    bench = Benchmark()
    bench.model("random_forest", _two()["random_forest"], parts["train"], parts["test"], 2)
    vote = ensembles.WeightedVote(_two())
    bench.ensemble("Ensemble (Weighted Voting)", vote, *[parts[p] for p in ("train", "val", "test")])
    return bench.table(parts["train"]).select(
        "model", "test_accuracy", "test_f1", "test_roc_auc", "cv_accuracy_mean", "beats_target"
    )


@query(on_clean('SELECT "customerID" AS key, label, TRUE AS same FROM clean'))
def model_round_trip(spark, folder):
    """A saved and loaded ensemble scores every row as before."""
    rows = _features(spark, folder)
    path = fresh_path(spark, "ensemble")
    made = ensembles.WeightedVote(_two()).fit(rows)
    made.save(path)
    loaded = ensembles.WeightedVote(_two()).load(spark, path)
    before = made.predict(rows).withColumnRenamed("p", "before").drop("prediction")
    after = loaded.combine(loaded.base_probabilities(before))
    return after.select("key", "label", (F.col("p") == F.col("before")).alias("same"))


@query()
def checkpoint_training(spark, folder):
    """Checkpoints of a growing forest: best kept, old ones retired, newest reloaded."""
    rows = _features(spark, folder)
    checkpoints = Checkpoints(spark, fresh_path(spark, "ckpt"), "forest", keep=2)
    watch = BestCheckpoint(checkpoints, "accuracy", best_only=False)
    for epoch in range(3):
        model = presets.make("random_forest", {"trees": epoch + 1, "depth": 2}).fit(rows)
        scored = trainer.with_probability(rows, model, "forest")
        watch.on_epoch_end(epoch, model, {"accuracy": trainer.evaluate(scored, "p_forest")["accuracy"]})
    newest = checkpoints.load()
    rescored = trainer.with_probability(rows, newest["model"], "again")
    live = checkpoints.history().select("epoch", "is_best")
    counted = rescored.agg(F.count("p_again").alias("scored"))
    return live.join(counted.withColumn("epoch", F.lit(newest["epoch"])), "epoch", "left")


@query(
    on_clean(
        f"""SELECT CASE WHEN {ORDER} < {int(0.8 * 16**13)} THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM clean GROUP BY 1"""
    )
)
def stored_preprocessor(spark, folder):
    """A preprocessor fitted on a hash split, saved, loaded and applied to every row."""
    df = stratified_split(clean_subscribers(spark, folder), "customerID", "label", SPLIT, exact=False)
    path = fresh_path(spark, "preprocessor")
    save_model(fit_preprocessor(df.where("part = 'train'"), named_spec()), path)
    return load_model(path).transform(df).groupBy("part").agg(F.count("features").alias("n"))


@query()
def churn_job(spark, folder):
    """The whole churn job from raw rows to the test accuracy."""
    _, model, accuracy = experiment.churn_pipeline(subscribers(spark, folder), "undersample", **SMALL)
    row = [(model.ensemble_type, float(accuracy))]
    return spark.createDataFrame(row, "model string, accuracy double").withColumn(
        "accuracy", r6("accuracy")
    )
