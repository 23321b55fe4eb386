"""Forests and boosted stumps against plain builders that see all rows at once."""

import math

import numpy as np
import pytest
from conftest import feature_frame
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from wanewatch.plans import boosting, forest, presets, trainer, tuning
from wanewatch.session import fresh_path


def table(n=300, seed=11):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 0) + rng.normal(size=n) * 0.6 > 0.8).astype(int)
    return x, y


def plain_tree(x, y, drawn, factors, s, depth=0, rows=None):
    """Nested (feature, cut, left, right) or the share of class 1, by trying every cut."""
    rows = np.flatnonzero(drawn > 0) if rows is None else rows

    def sides(r):
        return drawn[r][y[r] == 0].sum() * factors[0], drawn[r][y[r] == 1].sum() * factors[1]

    def purity(r):
        a, b = sides(r)
        return (a * a + b * b) / (a + b)

    a, b = sides(rows)
    best = None
    wide = s["maxDepth"] == 0 or depth < s["maxDepth"]
    if wide and a > 0 and b > 0 and len(rows) >= s["minInstancesPerSplit"]:
        for f in range(x.shape[1]):
            for c in np.unique(x[:, f])[:-1]:
                left, right = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                if min(len(left), len(right)) < s["minInstancesPerNode"]:
                    continue
                gain = round((purity(left) + purity(right) - purity(rows)) / (a + b), 12)
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, f, c, left, right
    if best is None:
        return b / (a + b)
    _, f, c, left, right = best
    return f, c, *(plain_tree(x, y, drawn, factors, s, depth + 1, r) for r in (left, right))


def plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize(
    "options",
    [
        {"maxDepth": 3, "classWeights": "none"},
        {"maxDepth": 0, "classWeights": "balanced", "minInstancesPerSplit": 12, "minInstancesPerNode": 4},
        {"maxDepth": 4, "classWeights": "balanced_subsample", "minInstancesPerNode": 3},
    ],
)
def test_trees_equal_a_plain_builder(spark, monkeypatch, options):
    x, y = table()
    monkeypatch.setattr(forest, "CELLS", 256)  # levels take several jobs
    df = feature_frame(spark, x, y).coalesce(1).orderBy("key").coalesce(1)
    made = forest.BootstrapForest(numTrees=3, maxBins=256, featureSubsetStrategy="all", **options)
    fitted = made.fit(df)
    s = made.settings()
    seen = {r["key"]: r["p_f"] for r in trainer.with_probability(df, fitted, "f").collect()}
    total = np.zeros(len(x))
    for t in range(3):
        drawn = forest.drawn_rows(s, t, (0, 0), len(y))
        sums = [drawn[y == c].sum() if s["classWeights"] == "balanced_subsample" else (y == c).sum() for c in (0, 1)]
        factors = (1.0, 1.0) if s["classWeights"] == "none" else (sum(sums) / 2 / sums[0], sum(sums) / 2 / sums[1])
        tree = plain_tree(x, y, drawn, factors, s)
        total += np.array([plain_value(tree, row) for row in x])
    assert [seen[i] for i in range(len(x))] == pytest.approx(list(total / 3), abs=1e-6)


def test_unlimited_depth_reaches_pure_nodes_and_node_limit_holds(spark):
    x, y = table(200)
    _, first = np.unique(x, axis=0, return_index=True)
    x, y = x[first], y[first]
    df = feature_frame(spark, x, y)
    options = {"numTrees": 1, "maxBins": 256, "featureSubsetStrategy": "all", "bootstrap": False}
    whole = forest.BootstrapForest(**options).fit(df)
    scored = trainer.with_probability(df, whole, "f")
    assert scored.where(F.col("p_f") != F.col("label")).count() == 0
    small = forest.BootstrapForest(maxNodes=7, **options).fit(df).tree_list()[0]
    assert len(small["feature"]) == 7
    assert len(whole.tree_list()[0]["feature"]) > 7
    assert whole.featureImportances.toArray().sum() == pytest.approx(1)


def test_forest_edges(spark, classified):
    empty = classified.where("key < 0")
    nothing = forest.BootstrapForest(numTrees=2).fit(empty)
    assert nothing.transform(empty).count() == 0 and nothing.getNumTrees == 2
    one = forest.BootstrapForest(numTrees=2, classWeights="balanced_subsample").fit(classified.where("label = 1"))
    assert {r["p_f"] for r in trainer.with_probability(classified, one, "f").collect()} == {1.0}
    with pytest.raises(ValueError):
        forest.BootstrapForest(classWeights="other").fit(classified)
    with pytest.raises(ValueError):
        forest.BootstrapForest(featureSubsetStrategy="other").fit(classified)


def test_forest_is_a_stage(spark, classified):
    fitted = Pipeline(stages=[forest.BootstrapForest(numTrees=4, maxDepth=4)]).fit(classified)
    path = fresh_path(spark, "forest-stage")
    fitted.write().save(path)
    again = PipelineModel.load(path)
    rows = lambda m: sorted((r["key"], r["p_f"]) for r in trainer.with_probability(classified, m, "f").collect())
    assert rows(again) == rows(fitted)
    assert trainer.evaluate(trainer.with_probability(classified, fitted, "f"), "p_f")["roc_auc"] > 0.85


def plain_stumps(x, y, rounds, rate):
    w, out = np.ones(len(y)), []
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            for c in np.unique(x[:, f])[:-1]:
                pure, says, error = 0.0, [], 0.0
                for side in (x[:, f] <= c, x[:, f] > c):
                    zero, one = w[side & (y == 0)].sum(), w[side & (y == 1)].sum()
                    pure += (zero**2 + one**2) / (zero + one)
                    says.append(int(one > zero))
                    error += min(zero, one)
                if best is None or pure / w.sum() > best[0] + 1e-12:
                    best = pure / w.sum(), f, c, says, error / w.sum()
        _, f, c, says, error = best
        if error >= 0.5 and out:
            break
        vote = rate * math.log((1 - error) / error)
        out.append((f, c, *says, vote))
        said = np.where(x[:, f] <= c, says[0], says[1])
        w = w * np.exp(vote * (said != y))
    return out


@pytest.mark.parametrize("block", [64, 8192])
def test_stumps_equal_a_plain_builder(spark, monkeypatch, block):
    x, y = table()
    monkeypatch.setattr(boosting, "BLOCK_ROWS", block)
    fitted = presets.Samme(rounds=23, rate=0.7, maxBins=256).fit(feature_frame(spark, x, y))
    want, trees = plain_stumps(x, y, 23, 0.7), fitted.tree_list()
    assert [(t["feature"][0], t["cut"][0]) for t in trees] == [w[:2] for w in want]
    scale = sum(abs(w[4]) for w in want)
    for t, (_, _, left, right, vote) in zip(trees, want, strict=True):
        assert t["value"][1:] == pytest.approx([2 * (2 * v - 1) * vote / scale for v in (left, right)], abs=1e-5)


def test_stumps_of_odd_tables(spark, classified):
    same = classified.withColumn("label", F.lit(1))
    p = trainer.with_probability(same, presets.Samme(rounds=5).fit(same), "s")
    assert p.where("p_s < 0.5").count() == 0
    empty = classified.where("key < 0")
    assert presets.Samme(rounds=3).fit(empty).transform(classified).count() == 400


def test_kept_search_is_measured_from_its_files(spark, classified, tmp_path):
    assert len(tuning.combinations(tuning.REDUCED["random_forest"])) == 32
    settings = tuning.combinations({"numTrees": [2], "maxDepth": [0, 2], "classWeights": ["none", "balanced_subsample"]})
    path = str(tmp_path / "kept")
    found = tuning.search_kept("random_forest", classified, settings, path, 2).collect()
    assert len(found) == 4 and [r["f1_mean"] for r in found] == sorted((r["f1_mean"] for r in found), reverse=True)
    kept = spark.read.parquet(path)
    assert kept.groupBy("setting").count().where("count = 400").count() == 4
    leaves = kept.groupBy("setting").agg(F.count_distinct("p").alias("n")).collect()
    assert {r["setting"]: r["n"] > 2 * 4 * 4 for r in leaves} == {0: False, 1: False, 2: False, 3: False}
    assert kept.where("setting >= 2 and p not in (0, 0.5, 1)").count() > 0  # leaves of two levels are mixed
    for r in found:
        rows = kept.where(F.col("setting") == r["setting"]).toPandas()
        f1 = []
        for _, g in rows.groupby("fold"):
            hit = ((g.p > 0.5) & (g.label == 1)).sum()
            f1.append(2 * hit / ((g.p > 0.5).sum() + (g.label == 1).sum()))
        assert r["f1_mean"] == pytest.approx(np.mean(f1))
    again = tuning.search_kept("random_forest", classified, settings, path, 2).collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in found]


def test_trees_go_out_once_a_level(spark, classified, monkeypatch):
    """Jobs of a level share one broadcast, which is given up after it; small jobs give the same trees."""
    made = lambda: forest.BootstrapForest(numTrees=3, maxDepth=5).fit(classified).tree_list()
    whole, seen, count = made(), [], forest.count_nodes
    monkeypatch.setattr(forest, "count_nodes", lambda blocks, sent, *a: seen.append(sent) or count(blocks, sent, *a))
    monkeypatch.setattr(forest, "CELLS", 1)
    assert made() == whole
    assert len({s._jbroadcast.id() for s in seen}) <= 5 < len(seen)
    assert not any(s._jbroadcast.isValid() for s in seen)
    monkeypatch.setattr(forest, "SMALL_TABLE", 0)  # splits are picked in the tasks
    monkeypatch.setattr(forest, "CELLS", 1 << 20)
    assert made() == whole


@pytest.mark.parametrize(
    "options",
    [
        {"classWeights": "balanced_subsample", "minInstancesPerSplit": 5},
        {"maxDepth": 6, "minInstancesPerNode": 3},
        {"maxNodes": 41, "classWeights": "balanced"},
    ],
)
def test_rows_dealt_out_by_node_give_the_same_trees(spark, monkeypatch, options):
    """Beyond a number of cells a level no longer passes over all rows; large nodes wait until they are smaller."""
    df = feature_frame(spark, *table(900, 5)).persist()
    made = lambda: forest.BootstrapForest(numTrees=3, **options).fit(df).tree_list()
    whole, passes, count = made(), [], forest.count_nodes
    monkeypatch.setattr(forest, "count_nodes", lambda blocks, sent, wanted, *a: passes.append(wanted) or count(blocks, sent, wanted, *a))
    monkeypatch.setattr(forest, "DEALT_CELLS", 1)
    assert made() == whole
    assert [[node for _, node in p] for p in passes] == [[0, 0, 0]]
    monkeypatch.setattr(forest, "NODE_ROWS", 200)
    monkeypatch.setattr(forest, "DEALT_ROWS", 700)  # one tree at a time
    monkeypatch.setattr(forest, "SENT_ROWS", 50)
    assert made() == whole
    cached = set(spark.sparkContext._jsc.getPersistentRDDs())
    assert made() == whole and set(spark.sparkContext._jsc.getPersistentRDDs()) == cached


def test_searched_settings_share_the_binned_rows_of_a_fold(spark, classified, tmp_path, monkeypatch):
    blocks, blocks_of = [], forest.blocks_of
    monkeypatch.setattr(forest, "blocks_of", lambda *a: blocks.append(blocks_of(*a)) or blocks[-1])
    settings = tuning.combinations({"numTrees": [2], "maxDepth": [0, 2], "classWeights": ["none", "balanced"]})
    path = str(tmp_path / "shared")
    tuning.search_kept("random_forest", classified, settings, path, 2).collect()
    assert len(blocks) == 2 and not any(b.is_cached for b in blocks)
    apart = str(tmp_path / "apart")
    tuning.search_kept("random_forest", classified, settings[3:], apart, 2).collect()
    rows = lambda p: sorted((r["key"], r["p"]) for r in spark.read.parquet(p).collect())
    assert rows(f"{path}/setting=3") == rows(f"{apart}/setting=0")
