import pytest
from pyspark.sql import functions as F

from wanewatch.functions import scalars
from wanewatch.operators import fallback
from wanewatch.operators.split import folds
from wanewatch.plans import benchmark, boosting, ensembles, experiment, presets, trainer, tuning
from wanewatch.sources.model_store import BestCheckpoint, Checkpoints, TrainingResumer
from wanewatch.sources.subscribers import subscribers
from wanewatch.sources.tracking import RunLog

SMALL = {"trees": 3, "depth": 2, "rounds": 20}


def two():
    return {n: presets.make(n, SMALL) for n in ("xgboost", "random_forest")}


@pytest.mark.parametrize("kind", ["voting", "stacking", "bagging"])
def test_ensemble_interface(classified, kind):
    model = ensembles.EnsembleModel(kind, trees=2, depth=2).fit(classified)
    rows = model.predict_proba(classified).collect()
    assert len(rows) == 400 and {r["prediction"] for r in rows} <= {0, 1}
    assert all(abs(r["p0"] + r["p1"] - 1) < 1e-9 for r in rows)
    assert 0.7 < model.score(classified) <= 1


@pytest.mark.parametrize("name", ["logistic_regression", "adaboost"])
def test_bags_of_estimators_of_our_own(classified, name):
    model = ensembles.Bagging(presets.make(name, SMALL), bags=2).fit(classified)
    assert 0.7 < model.score(classified) <= 1
    assert len(model.fitted) == 2


def test_scores_that_are_all_missing(classified):
    empty = classified.withColumn("p", F.lit(None).cast("double"))
    assert trainer.evaluate(empty, "p")["roc_auc"] == 0
    holes = classified.withColumn("p", F.lit(float("nan")))
    found = trainer.evaluate(holes, "p")
    assert (found["tp"], found["fp"], found["roc_auc"]) == (0, 0, 0)


def test_unknown_names_raise(classified):
    with pytest.raises(ValueError):
        ensembles.EnsembleModel("invalid").fit(classified)
    with pytest.raises(ValueError):
        presets.make("svm")
    with pytest.raises(ValueError):
        tuning.grid_search("svm", classified)
    with pytest.raises(ValueError):
        ensembles.WeightedVote(two()).predict(classified)


@pytest.mark.parametrize("strategy", ["SMOTE", "ADASYN", "undersample", None])
def test_rebalancing_before_training(imbalanced, strategy):
    rows = ensembles.rebalanced_features(imbalanced, strategy)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if strategy is None:
        assert counts == {0: 270, 1: 30}
    elif strategy == "undersample":
        assert counts == {0: 30, 1: 30}
    else:
        assert counts[0] == 270 and abs(counts[1] - 270) <= 30
    assert rows.select("key").distinct().count() == rows.count()


def test_all_presets_train_and_failures_are_skipped(classified):
    models = presets.default_models(**SMALL)
    models["broken"] = presets.make("random_forest", {"trees": 1, "depth": 99})
    fitted, table = trainer.train_all(models, classified, classified)
    rows = table.collect()
    assert set(fitted) == set(presets.DEFAULTS) and len(rows) == 6
    assert [r["f1"] for r in rows] == sorted((r["f1"] for r in rows), reverse=True)
    assert all(r["accuracy"] > 0.7 for r in rows)


def test_boosted_stumps_beat_one(classified):
    one, many = (
        trainer.evaluate(
            trainer.with_probability(classified, presets.Samme(rounds=n, rate=1.0).fit(classified), "s"),
            "p_s",
        )
        for n in (1, 11)
    )
    assert many["accuracy"] > one["accuracy"] and many["roc_auc"] > one["roc_auc"]


def test_out_of_fold_covers_every_key_once(classified):
    scored = trainer.out_of_fold(two(), folds(classified, "key", "label", 3), 3)
    assert scored.count() == 400 and scored.select("key").distinct().count() == 400
    assert scored.where("p_xgboost is null or p_random_forest is null").count() == 0


def test_cross_validation(classified):
    row = trainer.cross_validate({"rf": two()["random_forest"]}, classified, 3).first()
    assert len(row["f1_folds"]) == 3
    assert row["f1_mean"] == pytest.approx(sum(row["f1_folds"]) / 3)


def test_weighted_vote_saves_and_loads(spark, classified, tmp_path):
    made = ensembles.WeightedVote(two()).fit(classified, classified, metric="f1")
    assert sum(made.weights) == pytest.approx(1)
    made.save(str(tmp_path / "vote"))
    loaded = ensembles.WeightedVote(two()).load(spark, str(tmp_path / "vote"))
    assert loaded.weights == made.weights and loaded.evaluate(classified) == made.evaluate(classified)


def test_stacking_with_features_saves_and_loads(spark, classified, tmp_path):
    made = ensembles.Stacking(two(), use_features=True, k=2).fit(classified)
    made.save(str(tmp_path / "stack"))
    loaded = ensembles.Stacking(two()).load(spark, str(tmp_path / "stack"))
    assert loaded.evaluate(classified) == made.evaluate(classified)
    assert made.score(classified) > 0.7


def test_blending_and_predictor(classified):
    blend = ensembles.Blending(two(), meta=presets.make("xgboost", SMALL)).fit(classified)
    assert blend.score(classified) > 0.7
    model = ensembles.ChurnPredictor(**SMALL).fit(classified, k=2)
    assert {"accuracy", "roc_auc"} <= set(model.training_metrics)
    scores = model.individual_scores(classified)
    assert scores.where("model = 'ENSEMBLE' and weight = 1").count() == 1 and scores.count() == 4
    importance = model.feature_importance()
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert importance.first()["feature"] in ("feature_0", "feature_1", "feature_2")


def test_tuner(classified):
    assert len(tuning.combinations(tuning.REDUCED["gradient_boosting"])) == 16
    grids = {"random_forest": {"numTrees": [1, 3], "maxDepth": [2]}}
    tuner = tuning.Tuner()
    best = tuner.tune(classified, ["random_forest"], k=2, grids=grids)
    assert best.count() == 1 and tuner.history().count() == 2
    assert tuner.tuned_model("random_forest").getNumTrees in (1, 3)
    with pytest.raises(ValueError):
        tuner.tuned_model("xgboost")
    drawn = tuning.random_search("xgboost", classified, 1, {"maxIter": [1, 2], "maxDepth": [2]}, 2)
    assert drawn[1].count() == 1


def test_benchmark_and_report(classified):
    bench = benchmark.Benchmark()
    bench.set_target(0.5)
    bench.model("random_forest", two()["random_forest"], classified, classified, 2)
    vote = ensembles.WeightedVote(two())
    bench.ensemble("Ensemble (Weighted Voting)", vote, classified, classified, classified)
    table = bench.table(classified)
    assert table.where("beats_target").count() == 2
    assert table.where("cv_accuracy_mean is null").count() == 1
    assert benchmark.deployment_report(table).first()["recommendations"]
    assert benchmark.summary(table, 0.5).where("Gap_Points > 0").count() == 2


def test_model_in_the_fallback_ladder(spark, classified):
    model = presets.make("random_forest", SMALL).fit(classified)
    chain = fallback.FallbackChain(confidence=0.3)
    chain.add_handler(fallback.model_handler("primary", model))
    found = chain.predict(classified)
    assert found.columns[:3] == ["key", "features", "label"]
    assert found.where("model_used = 'primary' and probability < 0.3").count() == 0
    assert found.count() == 400


def test_checkpoints_resume_and_retire(spark, classified, tmp_path):
    resumer = TrainingResumer(spark, str(tmp_path), "t", keep=2, every=2)
    assert not resumer.can_resume() and resumer.resume() is None
    model = presets.make("random_forest", {"trees": 1, "depth": 1}).fit(classified)
    assert resumer.save(1, model, {}) is None
    for epoch in (2, 4, 6):
        assert resumer.save(epoch, model, {"f1": 0.1 * epoch})
    again = TrainingResumer(spark, str(tmp_path), "t")
    row = again.resume()
    assert again.epoch == 6 and row["metrics"]["f1"] == pytest.approx(0.6)
    assert row["model"].transform(classified).count() == 400
    assert again.checkpoints.history().count() == 2
    assert Checkpoints(spark, str(tmp_path), "other").load() is None
    assert again.checkpoints.load("nowhere") is None


def test_best_checkpoint_carries_the_previous_best(spark, classified, tmp_path):
    model = presets.make("random_forest", {"trees": 1, "depth": 1}).fit(classified)
    watch = BestCheckpoint(Checkpoints(spark, str(tmp_path), "b"))
    paths = [watch.on_epoch_end(i, model, m) for i, m in enumerate(
        [{"val_f1": 0.5}, {"val_f1": 0.5}, {"other": 1.0}, {"val_f1": 0.6}]
    )]
    assert [p is not None for p in paths] == [True, False, False, True]
    newest = watch.checkpoints.latest()
    assert newest["best_score"] == 0.5 and newest["is_best"]
    assert watch.best_model() is not None
    with pytest.raises(ValueError):
        BestCheckpoint(watch.checkpoints, mode="other")


def test_experiment_end_to_end(spark, tmp_path):
    raw = subscribers(spark, "/root/testdata/sf0.001")
    results = experiment.run_experiment(raw, str(tmp_path), k=2, trees=1, depth=1, rounds=5)
    assert results.count() == 8
    assert spark.read.json(str(tmp_path / "benchmark/json")).first()["best_model"]
    assert RunLog(spark, str(tmp_path / "tracking")).metrics().count() > 0
    predictor, found = experiment.train_predictor(raw, str(tmp_path / "p"), trees=1, depth=1)
    assert 0 <= found["accuracy"] <= 1
    again = ensembles.WeightedVote(predictor.models).load(spark, str(tmp_path / "p/predictor"))
    assert again.weights == predictor.weights
    stored = experiment.score_stored(
        spark, raw, str(tmp_path / "p/preprocessor"), str(tmp_path / "p/predictor/base/xgboost"),
        RunLog(spark, str(tmp_path / "eval")),
    )
    assert 0 <= stored["accuracy"] <= 1


def test_weighted_mean_is_normalised(spark):
    df = spark.createDataFrame([(0.2, 0.8)], "a double, b double")
    assert df.select(scalars.weighted_mean(["a", "b"], [1, 3])).first()[0] == pytest.approx(0.65)


def test_compared_ensembles_share_their_fits(classified, monkeypatch):
    """One fit on all rows and one a fold, whatever the number of ensembles; same metrics as apart."""
    fits, fit = [], presets.BoostedTrees._fit
    monkeypatch.setattr(presets.BoostedTrees, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    models = {"xgboost": two()["xgboost"]}
    rows = {r["model"]: r for r in ensembles.compare_ensembles(models, classified, classified, k=2).collect()}
    assert len(fits) == 3 and len(rows) == 3
    for name, use in (("stacking", False), ("stacking_features", True)):
        apart = ensembles.Stacking(models, use_features=use, k=2).fit(classified).evaluate(classified)
        assert all(rows[name][m] == pytest.approx(apart[m], abs=1e-6) for m in ("f1", "roc_auc", "tp", "fp"))


def test_boosted_models_of_a_vote_share_their_bins(classified, monkeypatch):
    """Rows are binned once for models that bin alike; same trees as fitted apart."""
    made, blocks_of = [], boosting.blocks_of
    monkeypatch.setattr(boosting, "blocks_of", lambda *a: made.append(blocks_of(*a)) or made[-1])
    models = {n: presets.make(n, {**SMALL, "trees": 12}) for n in ("xgboost", "random_forest", "lightgbm")}
    vote = ensembles.WeightedVote(models).fit(classified)
    assert len(made) == 1 and not made[0].is_cached
    for name in ("xgboost", "lightgbm"):
        assert vote.fitted[name].tree_list() == models[name].fit(classified).tree_list()


def test_meta_learner_reads_written_probabilities(classified):
    """Base models score the blend part once, before the meta-learner's passes over its rows."""
    plans = []

    class Meta(presets.BoostedTrees):
        def binned(self, dataset):
            plans.append(dataset._jdf.queryExecution().optimizedPlan().toString())
            return super().binned(dataset)

    blend = ensembles.Blending(two(), meta=Meta(maxIter=3, maxDepth=2)).fit(classified)
    assert len(plans) == 1 and "Python" not in plans[0] and "LogicalRDD" in plans[0]
    assert blend.score(classified) > 0.7


def test_compared_ensembles_are_the_whole_presets(spark, monkeypatch):
    """The query compares all models of the ensemble with their own sizes, on five folds."""
    from wanewatch.catalog import model_queries

    seen = []
    monkeypatch.setattr(model_queries, "_parts", lambda *a: {"train": None, "test": None})
    table = spark.createDataFrame([("stacking", 1.0)], "model string, train_seconds double")
    monkeypatch.setattr(ensembles, "compare_ensembles", lambda models, *a, k=5, **_: seen.append((models, k)) or table)
    model_queries.compare_ensembles(spark, "")
    models, k = seen[0]
    assert k == 5 and list(models) == list(presets.ENSEMBLE)
    for name, model in models.items():
        trees = "numTrees" if name == "random_forest" else "maxIter"
        assert model.getOrDefault(model.getParam(trees)) == presets.ENSEMBLE[name]["trees"]
        assert model.getOrDefault(model.getParam("maxDepth")) == presets.ENSEMBLE[name]["depth"]


def test_ensembles_compared_from_threads_are_the_same(classified):
    models = {"xgboost": two()["xgboost"], "random_forest": two()["random_forest"]}
    compared = lambda **more: ensembles.compare_ensembles(models, classified, classified, k=3, **more).collect()
    assert compared(parallel=3) == compared()


def test_one_partition_grows_the_trees_of_many(classified, monkeypatch):
    """Rows of one partition need no job a level; a tree is the same on any partitioning."""
    estimator = presets.make("lightgbm", {**SMALL, "trees": 23})
    jobs, grow_trees = [], boosting.grow_trees
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    many = estimator.fit(classified).tree_list()
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 8_192)
    monkeypatch.setattr(boosting, "grow_trees", lambda *a: jobs.append(1) or grow_trees(*a))
    assert estimator.fit(classified).tree_list() == many and len(many) == 23
    assert not jobs  # not grown from the driver
