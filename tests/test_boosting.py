"""Penalised boosting against a plain builder that sees all rows at once."""

import math

import numpy as np
import pytest
from conftest import feature_frame
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wanewatch.plans import boosting, presets
from wanewatch.session import fresh_path

UNIT = float(1 << 24)


def table(n=500, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)), 1)  # few distinct values, so all of them are cut points
    y = (x[:, 0] + 0.5 * x[:, 1] * (x[:, 2] > 0) + rng.normal(size=n) * 0.7 > 0).astype(int)
    return x, y


def plain_tree(x, cuts, g, h, s):
    """Recursive search for the best split; best-first if asked for."""
    t = lambda v: math.copysign(max(abs(v) - s["regAlpha"], 0), v)
    score = lambda r: t(g[r].sum() / UNIT) ** 2 / (h[r].sum() / UNIT + s["regLambda"])

    def split(rows):
        best = None
        for f in range(x.shape[1]):
            for c in cuts[f]:
                a, b = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                if min(len(a), len(b)) < s["minInstancesPerNode"] or not len(a) or not len(b):
                    continue
                if min(h[a].sum(), h[b].sum()) < s["minHessian"] * UNIT:
                    continue
                worth = (score(a) + score(b) - score(rows)) / 2 - s["gamma"]
                if worth > 1e-12 and (best is None or worth > best[0] + 1e-12):
                    best = worth, f, c, a, b
        return best

    leaf = lambda rows: -s["stepSize"] * t(g[rows].sum() / UNIT) / (h[rows].sum() / UNIT + s["regLambda"])
    root = {"rows": np.arange(len(x)), "depth": 0}
    leaves = [root]
    while True:
        ready = []
        for node in leaves:
            if "best" not in node:
                node["best"] = split(node["rows"]) if node["depth"] < s["maxDepth"] else None
            if node["best"]:
                ready.append(node)
        if not ready or (s["maxLeaves"] and len(leaves) >= s["maxLeaves"]):
            break
        node = max(ready, key=lambda n: n["best"][0]) if s["growth"] == "leaf" else ready[0]
        for side, rows in (("left", node["best"][3]), ("right", node["best"][4])):
            node[side] = {"rows": rows, "depth": node["depth"] + 1}
        leaves = [n for n in leaves if n is not node] + [node["left"], node["right"]]

    def shown(node):
        if "left" not in node:
            return round(leaf(node["rows"]), 9)
        return node["best"][1], round(node["best"][2], 9), shown(node["left"]), shown(node["right"])

    value = np.zeros(len(x))
    for node in leaves:
        value[node["rows"]] = leaf(node["rows"])
    return shown(root), value


def shown(tree, node=0):
    if tree["feature"][node] < 0:
        return round(tree["value"][node], 9)
    return (
        tree["feature"][node], round(tree["cut"][node], 9),
        shown(tree, tree["left"][node]), shown(tree, tree["right"][node]),
    )


SETTINGS = [
    dict(growth="level", regLambda=1.0, regAlpha=0.0, gamma=0.0, minHessian=1.0, maxDepth=4),
    dict(growth="level", regLambda=2.0, regAlpha=3.0, gamma=1.5, minHessian=5.0, maxDepth=4),
    dict(growth="leaf", regLambda=0.0, regAlpha=0.5, gamma=0.0, minHessian=0.001, maxDepth=5, maxLeaves=7, minInstancesPerNode=20),
]


@pytest.mark.parametrize("options", SETTINGS)
def test_trees_equal_a_plain_builder(spark, options):
    x, y = table()
    df = feature_frame(spark, x, y)
    estimator = boosting.BoostedTrees(maxIter=13, maxBins=256, stepSize=0.3, **options)
    trees = estimator.fit(df).tree_list()
    assert estimator.fit(df.repartition(5)).tree_list() == trees  # any partitioning gives the same
    s, cuts = estimator.settings(), [np.unique(c)[:-1] for c in x.T]
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    for tree in trees:
        p = 0.5 * (1 + np.tanh(0.5 * margin))
        want, value = plain_tree(x, cuts, np.rint((p - y) * UNIT), np.rint(p * (1 - p) * UNIT), s)
        assert shown(tree) == want
        margin += value


def test_scores_weights_and_round_trip(spark):
    x, y = table(300)
    df = feature_frame(spark, x, y).withColumn("weight", F.when(F.col("label") == 1, 2.0).otherwise(1.0))
    stage = boosting.BoostedTrees(maxIter=12, maxDepth=3, subsamplingRate=0.7, featureShare=0.6)
    stage = stage.copy({stage.weightCol: "weight"})
    model = Pipeline(stages=[stage]).fit(df)
    path = fresh_path(spark, "boosted")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    p = vector_to_array("probability")[1]
    one, two = ({r["key"]: r["p"] for r in m.transform(df).select("key", p.alias("p")).collect()} for m in (model, again))
    assert one == two and len(one) == 300
    made = model.stages[0]
    assert one == pytest.approx({i: 1 / (1 + math.exp(-m)) for i, m in enumerate(made.margins(x))})
    accuracy = np.mean([(one[i] > 0.5) == y[i] for i in range(300)])
    assert accuracy > 0.8 and made.featureImportances[0] == max(made.featureImportances)
    assert sum(made.featureImportances) == pytest.approx(1)


def test_odd_tables(spark):
    nan = float("nan")
    x = np.array([[1.0, 2.0, nan], [1.0, 3.0, 0.0], [1.0, 2.0, nan], [1.0, 5.0, 1.0]] * 30)
    y = np.array([0, 1, 0, 1] * 30)
    model = boosting.BoostedTrees(maxIter=3).fit(feature_frame(spark, x, y))
    assert model.featureImportances[0] == 0  # a constant column splits nothing
    assert (model.margins(x) > 0).tolist() == (y == 1).tolist()
    one = boosting.BoostedTrees(maxIter=3).fit(feature_frame(spark, x, np.ones(120, int)))
    assert (one.margins(x) > 5).all()
    with pytest.raises(ValueError):
        boosting.BoostedTrees(growth="sideways").fit(feature_frame(spark, x, y))
    with pytest.raises(ValueError):
        boosting.BoostedTrees(maxBins=300).fit(feature_frame(spark, x, y))


def test_presets_take_effect(spark):
    first, second = (presets.predictor_models()[n].settings() for n in ("xgboost", "lightgbm"))
    assert (first["growth"], first["gamma"], first["regAlpha"], first["regLambda"], first["minHessian"]) == ("level", 0.1, 0.01, 1.0, 1.0)
    assert (second["growth"], second["maxLeaves"], second["minInstancesPerNode"], second["regAlpha"]) == ("leaf", 31, 20, 0.01)
    assert presets.make("lightgbm").settings()["minInstancesPerNode"] == 20
    x, y = table()
    tree = presets.make("lightgbm", {"trees": 1, "leaves": 4}).fit(feature_frame(spark, x, y)).tree_list()[0]
    assert tree["feature"].count(-1) == 4
