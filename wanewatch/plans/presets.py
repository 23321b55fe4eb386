"""Classifier presets over Spark's own estimators and the boosting of this library.

Two of the three boosted presets penalise leaves; one of them grows its trees level by level, the
other by the worthiest leaf. The third is Spark's own boosted-tree estimator.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.plans.boosting import (
    FEW,
    FIXED_POINT,
    BoostedTrees,
    BoostedTreesModel,
    bin_edges,
    blocks_of,
    empty_tree,
    values_of,
    with_thresholds,
)
from wanewatch.session import cut_lineage

SEED = 42
# Fixed value: where the logistic fit stops.
TOLERANCE = 1e-4
REROOT = 10

# Default training presets (trees, depth, rate).
DEFAULTS = {
    "xgboost": {"trees": 100, "depth": 6, "rate": 0.1},
    "lightgbm": {"trees": 100, "depth": 6, "rate": 0.1},
    "random_forest": {"trees": 100, "depth": 10, "min_leaf": 3},
    "gradient_boosting": {"trees": 100, "depth": 5, "rate": 0.1},
    "logistic_regression": {"c": 1.0, "rounds": 1000},
    "adaboost": {"trees": 100, "rate": 0.1},
}
# Presets of the four-model ensemble.
ENSEMBLE = {
    "xgboost": {"trees": 200, "depth": 7, "rate": 0.1},
    "lightgbm": {"trees": 200, "depth": 7, "rate": 0.1},
    "random_forest": {"trees": 200, "depth": 15},
    "gradient_boosting": {"trees": 150, "depth": 5, "rate": 0.1},
}
# Presets of the three-model predictor.
PREDICTOR = {
    "xgboost": {
        "trees": 200,
        "depth": 5,
        "rate": 0.1,
        "rows": 0.8,
        "features": "0.8",
        "hessian": 1.0,
        "l1": 0.01,
        "l2": 1.0,
        "gamma": 0.1,
    },
    "lightgbm": {
        "trees": 200,
        "depth": 5,
        "rate": 0.1,
        "rows": 0.8,
        "features": "0.8",
        "leaves": 31,
        "min_leaf": 20,
        "l1": 0.01,
        "l2": 1.0,
    },
    "random_forest": {
        "trees": 200,
        "depth": 12,
        "min_leaf": 4,
        "features": "sqrt",
        "weighted": True,
    },
}
# What the two penalised boosted models take where a preset says nothing.
PENALISED = {
    "xgboost": {"growth": "level", "l1": 0.0, "l2": 1.0, "gamma": 0.0, "hessian": 1.0},
    "lightgbm": {
        "growth": "leaf",
        "leaves": 31,
        "min_leaf": 20,
        "l1": 0.0,
        "l2": 0.0,
        "gamma": 0.0,
        "hessian": 0.001,
    },
}


def make(name: str, options: dict[str, object] | None = None, **more) -> Estimator:
    """Estimator of a preset; options override its values."""
    o = {**PENALISED.get(name, {}), **DEFAULTS.get(name, {}), **(options or {}), **more}
    if name in PENALISED:
        share = str(o.get("features", "all"))
        made = BoostedTrees(
            maxIter=int(o["trees"]),
            maxDepth=int(o["depth"]),
            maxLeaves=int(o.get("leaves", 0)),
            stepSize=float(o["rate"]),
            subsamplingRate=float(o.get("rows", 1.0)),
            featureShare=1.0 if share == "all" else float(share),
            regLambda=float(o["l2"]),
            regAlpha=float(o["l1"]),
            gamma=float(o["gamma"]),
            minHessian=float(o["hessian"]),
            minInstancesPerNode=int(o.get("min_leaf", 1)),
            growth=str(o["growth"]),
            seed=SEED,
        )
    elif name == "gradient_boosting":
        made = GBTClassifier(
            maxIter=int(o["trees"]),
            maxDepth=int(o["depth"]),
            stepSize=float(o["rate"]),
            subsamplingRate=float(o.get("rows", 1.0)),
            featureSubsetStrategy=str(o.get("features", "all")),
            minInstancesPerNode=int(o.get("min_leaf", 1)),
            seed=SEED,
        )
    elif name == "random_forest":
        made = RandomForestClassifier(
            numTrees=int(o["trees"]),
            maxDepth=int(o["depth"]),
            minInstancesPerNode=int(o.get("min_leaf", 1)),
            featureSubsetStrategy=str(o.get("features", "sqrt")),
            seed=SEED,
        )
    elif name == "logistic_regression":
        made = SummedLogistic(c=float(o["c"]), maxIter=int(o["rounds"]))
    elif name == "adaboost":
        made = Samme(rounds=int(o["trees"]), rate=float(o["rate"]))
    else:
        raise ValueError(f"unknown model: {name}")
    if o.get("weighted") and made.hasParam("weightCol"):
        made = made.copy({made.getParam("weightCol"): "weight"})
    return made


def default_models(**shrink) -> dict[str, Estimator]:
    """The six presets; ``shrink`` overrides e.g. trees and depth for a quick run."""
    return {name: make(name, shrink_options(name, shrink)) for name in DEFAULTS}


def shrink_options(name: str, shrink: dict[str, object]) -> dict[str, object]:
    return {k: v for k, v in shrink.items() if k in DEFAULTS[name]}


def ensemble_models(**shrink) -> dict[str, Estimator]:
    return {n: make(n, {**o, **shrink_options(n, shrink)}) for n, o in ENSEMBLE.items()}


def predictor_models(**shrink) -> dict[str, Estimator]:
    return {n: make(n, {**o, **shrink_options(n, shrink)}) for n, o in PREDICTOR.items()}


class SummedLogistic(Estimator, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """Logistic regression whose penalty is weighed against the summed loss: 1 / (C n)."""

    c = Param(Params._dummy(), "c", "inverse penalty", typeConverter=TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "rounds", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, c: float = 1.0, maxIter: int = 1000):
        super().__init__()
        self._setDefault(c=1.0, maxIter=1000)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        weighted = self.isDefined(self.weightCol)
        size = F.sum(self.getWeightCol()) if weighted else F.count("*")
        n = max(dataset.agg(size).first()[0] or 0, 1)
        made = LogisticRegression(
            regParam=1.0 / (self.getOrDefault(self.c) * n),
            standardization=False,
            maxIter=self.getOrDefault(self.maxIter),
            tol=TOLERANCE,
        )
        return (made.setWeightCol(self.getWeightCol()) if weighted else made).fit(dataset)


class Samme(Estimator, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted stumps: after each round the weight of missed rows grows.

    Rows are binned blocks (see ``boosting``). A round is one job: it moves the kept weights by the
    last stump, keeps them in place of the ones before and adds them up by (feature, bin, class); stump,
    error and vote follow from these sums. Every ``REROOT`` rounds the weights are worked
    out from the first blocks again, so a lost block replays few steps.
    """

    rounds = Param(Params._dummy(), "rounds", "stumps", typeConverter=TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "learning rate", typeConverter=TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins, 256 at most", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, rounds: int = 100, rate: float = 0.1, maxBins: int = 64):
        super().__init__()
        self._setDefault(rounds=100, rate=0.1, maxBins=64)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        weight = F.col(self.getWeightCol()) if self.isDefined(self.weightCol) else F.lit(1.0)
        rows = cut_lineage(
            dataset.select(
                vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), weight.cast("double").alias("w")
            )
        )
        edges = bin_edges(rows, self.getOrDefault(self.maxBins))
        total, count = rows.agg(F.sum("w"), F.count("*")).first()
        first = blocks_of(rows, edges, 0.0, count)
        stumps, votes = boost_stumps(
            first, [len(e) + 1 for e in edges], total or 0.0, self.getOrDefault(self.rounds), self.getOrDefault(self.rate)
        )
        first.unpersist()
        scale = sum(abs(v) for v in votes) or 1.0
        trees = [
            {**t, "value": [(0.0 if f >= 0 else 2 * (2 * c - 1) * v / scale) for f, c in zip(t["feature"], t["value"])]}
            for t, v in zip(stumps, votes)
        ]
        made = BoostedTreesModel()
        made._set(trees=json.dumps([with_thresholds(t, edges) for t in trees]), base=0.0, width=len(edges))
        return made


def boost_stumps(first, cuts: list[int], total: float, rounds: int, rate: float):
    """Stumps with leaves of 0 or 1, and their votes."""
    stumps, votes = [], []
    if not cuts or total <= 0:
        return stumps, votes
    width, blocks, before, shift = max(cuts), first, first, 0.0
    for i in range(rounds):
        sums = stump_sums(blocks, len(cuts), width, shift)
        if before is not first:
            before.unpersist()
        stump, error = best_stump(sums, np.array(cuts))
        if error >= 0.5 and stumps:
            break
        bounded = min(max(error, 1e-10), 1 - 1e-10)
        stumps.append(stump)
        votes.append(rate * math.log((1 - bounded) / bounded))
        if error <= 0.0 or error >= 0.5:
            break
        # the mean weight stays near one, whatever the number of rounds
        shift += math.log(float(sums[0].sum()) / FIXED_POINT / total)
        if i % REROOT == REROOT - 1:
            moved = first.map(_missed(stumps, votes))
        else:
            moved = blocks.map(_missed(stumps[-1:], votes[-1:]))
        before, blocks = blocks, moved.persist(StorageLevel.MEMORY_AND_DISK)
    for kept in (before, blocks):
        if kept is not first:
            kept.unpersist()
    return stumps, votes


def _missed(stumps, votes):
    """Adds the votes of the stumps that miss a row to the logarithm of its weight."""

    def moved(block):
        name, cells, y, w, grown = block
        for stump, vote in zip(stumps, votes):
            grown = grown + vote * (values_of(stump, cells) != y)
        return name, cells, y, w, grown

    return moved


def stump_sums(blocks, features: int, width: int, shift: float) -> np.ndarray:
    """Integer weights (feature, bin, class)."""

    def of(part):
        out = np.zeros(features * width * 2, np.int64)
        for _, cells, y, w, grown in part:
            mass = np.rint(w * np.exp(grown - shift) * FIXED_POINT)
            at = (np.arange(features) * width + cells) * 2 + (y == 1)[:, None]
            out += np.bincount(at.ravel(), np.repeat(mass, features), len(out)).astype(np.int64)
        yield out

    sums = blocks.mapPartitions(of)
    found = sums.reduce(np.add) if sums.getNumPartitions() <= FEW else sums.treeReduce(np.add)
    return found.reshape(features, width, 2)


def best_stump(sums: np.ndarray, cuts: np.ndarray) -> tuple[dict, float]:
    """The split of the lowest Gini impurity and the weighted share of rows it misses.

    Of equal impurity the first feature and bin win; a leaf says the class with more weight, 0 if
    both have the same. Without any split the stump is one leaf.
    """
    left = sums.cumsum(1) / FIXED_POINT
    whole = left[:, -1:, :]
    right = whole - left
    mass = float(whole[0, 0].sum())

    def purity(side):
        return (side**2).sum(-1) / np.where(side.sum(-1) > 0, side.sum(-1), np.inf)

    pure = np.round((purity(left) + purity(right)) / mass, 12)
    allowed = (np.arange(sums.shape[1]) < cuts[:, None] - 1) & (left.sum(-1) > 0) & (right.sum(-1) > 0)
    pure = np.where(allowed, pure, -np.inf)
    f, b = divmod(int(pure.argmax()), sums.shape[1])
    if not np.isfinite(pure[f, b]):
        sides = [whole[0, 0]]
        stump = {**empty_tree(), "value": [float(sides[0][1] > sides[0][0])]}
    else:
        sides = [left[f, b], right[f, b]]
        says = [float(one > zero) for zero, one in sides]
        stump = {
            "feature": [f, -1, -1], "cut": [b, 0, 0], "left": [1, -1, -1], "right": [2, -1, -1],
            "value": [0.0, *says], "gain": [float(pure[f, b] - purity(whole[0, 0]) / mass), 0.0, 0.0],
        }
    return stump, float(sum(min(side) for side in sides) / mass)
