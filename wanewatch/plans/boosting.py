"""Second-order boosting with penalised leaves, over histograms that Spark sums up.

Rows are binned once and kept by Spark as blocks of small integers. For a level of a tree, every
task adds the gradients and hessians of its rows by (node, feature, bin), and ``treeReduce`` sums
these histograms; their size follows from the settings, not from the rows. Gradients are rounded
to whole multiples of 2^-24 first: sums of integers do not depend on the order of tasks, so the
same rows give the same trees on any partitioning. A table of one partition grows its trees in one task.

A split is worth ``(T(Gl)^2 / (Hl + l2) + T(Gr)^2 / (Hr + l2) - T(G)^2 / (H + l2)) / 2 - gamma``
with ``T`` shrinking towards zero by ``l1``; a leaf gives ``-rate T(G) / (H + l2)``. With
``growth='level'`` every split of positive worth is made, with ``'leaf'`` the worthiest first, up
to ``maxLeaves``. For that, splits are looked up level by level down to ``maxDepth``, one job a
level, and the best-first order is taken from them afterwards.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIXED_POINT = float(1 << 24)
BLOCK_ROWS = 8_192
KEPT_TREES = 10  # trees whose margins are worked out again in every job before they are written down
SKETCH = 10_000
FEW = 32


def _param(name: str, doc: str, converter):
    return Param(Params._dummy(), name, doc, typeConverter=converter)


class BoostedTrees(Estimator, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """Binary classifier on ``features`` and ``label``; settings are Spark's names where it has them."""

    maxIter = _param("maxIter", "trees", TypeConverters.toInt)
    maxDepth = _param("maxDepth", "levels of splits", TypeConverters.toInt)
    maxLeaves = _param("maxLeaves", "leaves of a tree, 0 for no limit", TypeConverters.toInt)
    maxBins = _param("maxBins", "bins of a feature, 256 at most", TypeConverters.toInt)
    stepSize = _param("stepSize", "learning rate", TypeConverters.toFloat)
    subsamplingRate = _param("subsamplingRate", "share of rows a tree sees", TypeConverters.toFloat)
    featureShare = _param("featureShare", "share of features a tree sees", TypeConverters.toFloat)
    regLambda = _param("regLambda", "squared penalty of a leaf", TypeConverters.toFloat)
    regAlpha = _param("regAlpha", "absolute penalty of a leaf", TypeConverters.toFloat)
    gamma = _param("gamma", "worth a split has to exceed", TypeConverters.toFloat)
    minHessian = _param("minHessian", "least hessian of a child", TypeConverters.toFloat)
    minInstancesPerNode = _param("minInstancesPerNode", "least rows of a child", TypeConverters.toInt)
    growth = _param("growth", "'level' or 'leaf'", TypeConverters.toString)
    seed = _param("seed", "of row and feature samples", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, maxIter=100, maxDepth=6, maxLeaves=0, maxBins=64, stepSize=0.1, subsamplingRate=1.0,
        featureShare=1.0, regLambda=1.0, regAlpha=0.0, gamma=0.0, minHessian=1.0,
        minInstancesPerNode=1, growth="level", seed=42,
    ):
        super().__init__()
        self._setDefault(
            maxIter=100, maxDepth=6, maxLeaves=0, maxBins=64, stepSize=0.1, subsamplingRate=1.0,
            featureShare=1.0, regLambda=1.0, regAlpha=0.0, gamma=0.0, minHessian=1.0,
            minInstancesPerNode=1, growth="level", seed=42,
        )
        self._set(**self._input_kwargs)

    def settings(self) -> dict[str, object]:
        own = [p for p in self.params if p.name != "weightCol"]
        return {p.name: self.getOrDefault(p) for p in own}

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        return self.fit_binned(self.binned(dataset))

    def binning(self) -> tuple[int, str | None]:
        """Estimators that agree in this learn from the same ``binned`` rows."""
        if self.getOrDefault(self.growth) not in ("level", "leaf"):
            raise ValueError(f"unknown growth: {self.getOrDefault(self.growth)}")
        return self.getOrDefault(self.maxBins), self.getWeightCol() if self.isDefined(self.weightCol) else None

    def binned(self, dataset: DataFrame) -> Binned:
        bins, name = self.binning()
        weight = F.col(name) if name else F.lit(1.0)
        rows = dataset.select(
            vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), weight.cast("double").alias("w")
        )
        ones, total, count, width = rows.agg(
            F.sum(F.col("y") * F.col("w")), F.sum("w"), F.count("*"), F.max(F.size("x"))
        ).first()
        edges = bin_edges(rows, bins, width or 0)
        share = min(max((ones or 0.0) / (total or 1.0), 1e-6), 1 - 1e-6)
        base = math.log(share / (1 - share))
        return Binned(edges, base, blocks_of(rows, edges, base, count))

    def fit_binned(self, table: Binned, last: bool = True) -> BoostedTreesModel:
        """The model of binned rows, which are given up as soon as no later fit needs them."""
        s, edges, cuts = self.settings(), table.edges, [len(e) + 1 for e in table.edges]
        if table.blocks.getNumPartitions() == 1:
            trees = table.blocks.mapPartitions(lambda part: [grow_trees(Held(list(part)), cuts, s, False)]).collect()[0]
            if last:
                table.blocks.unpersist()
        else:
            trees = grow_trees(table.blocks, cuts, s, last)
        made = BoostedTreesModel()
        real = [with_thresholds(t, edges) for t in trees]
        made._set(trees=json.dumps(real), base=table.base, width=len(edges))
        return made


@dataclass
class Binned:
    """Rows as blocks of bin numbers, see ``blocks_of``, with the edges of the bins and the margin rows start from."""

    edges: list[np.ndarray]
    base: float
    blocks: RDD


def bin_edges(rows: DataFrame, bins: int, width: int | None = None) -> list[np.ndarray]:
    """Ascending cut points of every feature: a value is in the bin of the first cut not below it.

    Cut points are values of the column at equal shares of the rows, from a mergeable sketch;
    the result has one short list per feature.
    """
    if not 2 <= bins <= 256:
        raise ValueError("maxBins lies between 2 and 256")
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = (
        rows.select(F.posexplode("x").alias("i", "v")).where(~F.isnan("v")).groupBy("i")
        .agg(F.percentile_approx("v", shares, SKETCH).alias("q"), F.max("v").alias("high"))
    )
    if width is None:
        width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    out = [np.zeros(0)] * width
    for r in found.collect():
        cuts = np.unique(np.array(r["q"], float))
        out[r["i"]] = cuts[cuts < r["high"]]
    return out


def blocks_of(rows: DataFrame, edges: list[np.ndarray], base: float, count: int):
    """RDD of (number, bins, label, weight, margin) blocks, kept in memory or on disk.

    A small table is drawn together into partitions of about a block, as every level is a job.
    """

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
            y, w = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("y", "w"))
            cells = np.empty(x.shape, np.uint8)
            for i, cuts in enumerate(edges):
                cells[:, i] = np.searchsorted(cuts, x[:, i])  # NaN is beyond all cuts
            for a in range(0, len(cells), BLOCK_ROWS):
                part = slice(a, a + BLOCK_ROWS)
                yield pa.record_batch(
                    {"n": pa.array([len(cells[part])], pa.int32()), "cells": [cells[part].tobytes()],
                     "y": [y[part].tobytes()], "w": [w[part].tobytes()]}
                )

    made = rows.mapInArrow(run, "n int, cells binary, y binary, w binary")

    def unpack(part, records):
        for k, r in enumerate(records):
            cells = np.frombuffer(r["cells"], np.uint8).reshape(r["n"], len(edges))
            yield (part, k), cells, np.frombuffer(r["y"]), np.frombuffer(r["w"]), np.full(r["n"], base)

    blocks = made.rdd.mapPartitionsWithIndex(unpack)
    parts = min(blocks.getNumPartitions(), max(1, -(-count // BLOCK_ROWS)))
    return blocks.coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)


def _with_margin(trees):
    def moved(block):
        number, cells, y, w, margin = block
        return number, cells, y, w, margin + sum(values_of(t, cells) for t in trees)

    return moved


def place(tree: dict, cells: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Node every row ends in, from the root or the node it is known to pass."""
    at = np.zeros(len(cells), np.int64) if start is None else start.astype(np.int64)
    feature, cut = np.array(tree["feature"]), np.array(tree["cut"])
    left, right = np.array(tree["left"]), np.array(tree["right"])
    rows = np.arange(len(cells))
    while len(rows):
        rows = rows[feature[at[rows]] >= 0]
        node = at[rows]
        at[rows] = np.where(cells[rows, feature[node]] <= cut[node], left[node], right[node])
    return at


def values_of(tree: dict, cells: np.ndarray) -> np.ndarray:
    return np.array(tree["value"])[place(tree, cells)]


def margins_of(trees: list[dict], base: float, x: np.ndarray) -> np.ndarray:
    """Sum of all trees for rows of feature values; a missing value is beyond all cuts."""
    out = np.full(len(x), base)
    beyond = np.where(np.isnan(x), np.inf, x)
    for tree in trees:
        out += values_of(tree, beyond)
    return out


def empty_tree() -> dict[str, list]:
    return {"feature": [-1], "cut": [0], "left": [-1], "right": [-1], "value": [0.0], "gain": [0.0]}


class Held:
    """Blocks in the memory of a task, with what growth asks of an RDD: a table of one partition needs no job a level."""

    def __init__(self, blocks: list):
        self.blocks = blocks

    def map(self, f) -> Held:
        return Held([f(b) for b in self.blocks])

    def mapPartitions(self, f) -> Held:
        return Held(list(f(iter(self.blocks))))

    def reduce(self, f):
        return reduce(f, self.blocks)

    def getNumPartitions(self) -> int:
        return 1

    def persist(self, _level) -> Held:
        return self

    def count(self) -> int:
        return len(self.blocks)

    def unpersist(self) -> None:
        self.blocks = []


def grow_trees(first, cuts: list[int], s: dict, last: bool) -> list[dict]:
    """All trees over the blocks; ``last``: the first blocks are given up as soon as they are not needed."""
    rng = np.random.default_rng(s["seed"])
    blocks, trees, pending = first, [], []
    for number in range(s["maxIter"]):
        count = max(1, math.ceil(s["featureShare"] * len(cuts)))
        chosen = np.sort(rng.choice(len(cuts), count, replace=False)) if count < len(cuts) else np.arange(len(cuts))
        tree = grow(blocks, pending, number, chosen, cuts, s)
        trees.append(tree)
        pending.append(tree)
        if len(pending) == KEPT_TREES and number + 1 < s["maxIter"]:
            moved = blocks.map(_with_margin(pending)).persist(StorageLevel.MEMORY_AND_DISK)
            moved.count()
            if last or blocks is not first:
                blocks.unpersist()
            blocks, pending = moved, []
    if last or blocks is not first:
        blocks.unpersist()
    return trees


def histograms(blocks, pending, tree, nodes, number, chosen, width, s) -> np.ndarray:
    """Integer sums (node, feature, bin, [gradient, hessian, rows]) of the named nodes."""
    rate, seed = s["subsamplingRate"], s["seed"]

    def of(part):
        slot = np.full(len(tree["feature"]), -1)
        slot[nodes] = np.arange(len(nodes))
        total = np.zeros((3, len(nodes) * len(chosen) * width), np.int64)
        for name, cells, y, w, margin in part:
            margin = margin + sum(values_of(t, cells) for t in pending)
            mine = slot[place(tree, cells)]
            if rate < 1:
                mine[np.random.default_rng([seed, number, *name]).random(len(y)) >= rate] = -1
            keep = np.flatnonzero(mine >= 0)
            p = 0.5 * (1 + np.tanh(0.5 * margin[keep]))
            g = np.rint(w[keep] * (p - y[keep]) * FIXED_POINT)
            h = np.rint(w[keep] * p * (1 - p) * FIXED_POINT)
            at = (mine[keep, None] * len(chosen) + np.arange(len(chosen))) * width + cells[keep][:, chosen]
            at, many = at.ravel(), len(chosen)
            # sums of a block stay below 2^53, so they are exact as doubles
            for k, value in enumerate((g, h, np.ones(len(keep)))):
                total[k] += np.bincount(at, np.repeat(value, many), total.shape[1]).astype(np.int64)
        yield total

    sums = blocks.mapPartitions(of)
    # few partitions are added up on the driver, which spares a stage
    found = sums.reduce(np.add) if sums.getNumPartitions() <= FEW else sums.treeReduce(np.add)
    return found.reshape(3, len(nodes), len(chosen), width).transpose(1, 2, 3, 0)


def shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_split(table: np.ndarray, chosen: np.ndarray, cuts: np.ndarray, s: dict) -> tuple | None:
    """(worth, feature, bin, sums of the left child); of equal worth the first feature and bin."""
    l1, l2 = s["regAlpha"], s["regLambda"]
    left = table.cumsum(1)
    whole = left[:, -1:, :]
    right = whole - left

    def score(t):
        h = t[..., 1] / FIXED_POINT + l2
        return shrunk(t[..., 0] / FIXED_POINT, l1) ** 2 / np.where(h > 0, h, np.inf)

    worth = (score(left) + score(right) - score(whole)) / 2 - s["gamma"]
    floor = s["minHessian"] * FIXED_POINT
    allowed = np.arange(table.shape[1]) < cuts[:, None] - 1  # the last bin leaves nothing on the right
    for side in (left, right):
        allowed = allowed & (side[..., 1] >= floor) & (side[..., 2] >= max(s["minInstancesPerNode"], 1))
    worth = np.where(allowed, worth, -np.inf)
    at = int(worth.argmax())
    i, b = divmod(at, table.shape[1])
    if not worth[i, b] > 1e-12:
        return None
    return float(worth[i, b]), int(chosen[i]), b, left[i, b]


def grow(blocks, pending, number, chosen, cuts, s) -> dict:
    """One tree: all worthwhile splits level by level, then the order of growth."""
    tree, widths = empty_tree(), np.array(cuts)[chosen]
    width = int(widths.max(initial=1))
    table = {0: histograms(blocks, pending, tree, [0], number, chosen, width, s)[0]}
    sums = {0: table[0][0].sum(0)}
    level, splits = [0], {}
    for depth in range(s["maxDepth"]):
        fresh = []
        for node in level:
            found = best_split(table[node], chosen, widths, s)
            if found is None:
                continue
            worth, feature, cut, left = found
            a = len(tree["feature"])
            for column, value in zip(("feature", "cut", "left", "right", "value", "gain"), (-1, 0, -1, -1, 0.0, 0.0), strict=True):
                tree[column] += [value, value]
            tree["feature"][node], tree["cut"][node] = feature, cut
            tree["left"][node], tree["right"][node], tree["gain"][node] = a, a + 1, worth
            sums[a], sums[a + 1] = left, sums[node] - left
            splits[node] = worth
            fresh.append((node, a))
        level = [child for _, a in fresh for child in (a, a + 1)]
        if not fresh or depth + 1 == s["maxDepth"]:
            break
        # only left children are counted: the right ones are what their parents have more
        counted = histograms(blocks, pending, tree, [a for _, a in fresh], number, chosen, width, s)
        for (node, a), mine in zip(fresh, counted, strict=True):
            table[a], table[a + 1] = mine, table[node] - mine
            del table[node]
    return pruned(tree, splits, sums, s)


def pruned(tree: dict, splits: dict[int, float], sums: dict[int, np.ndarray], s: dict) -> dict:
    """The tree with the splits its growth makes, renumbered from the root, with leaf values."""
    made, leaves, limit = set(), [0], s["maxLeaves"] or len(tree["feature"])
    while s["growth"] == "leaf" and len(leaves) < limit:
        ready = [n for n in leaves if n in splits]
        if not ready:
            break
        node = max(ready, key=lambda n: (splits[n], -n))
        made.add(node)
        leaves = [n for n in leaves if n != node] + [tree["left"][node], tree["right"][node]]
    if s["growth"] == "level":
        for node in sorted(splits):  # parents come before their children
            if len(made) + 1 < limit:
                made.add(node)
    out = {k: [] for k in tree}
    order, number = [0], {}
    for node in order:
        number[node] = len(number)
        if node in made:
            order += [tree["left"][node], tree["right"][node]]
    for node in order:
        inner = node in made
        g, h, _ = sums[node] / FIXED_POINT
        out["feature"].append(tree["feature"][node] if inner else -1)
        out["cut"].append(tree["cut"][node] if inner else 0)
        out["left"].append(number[tree["left"][node]] if inner else -1)
        out["right"].append(number[tree["right"][node]] if inner else -1)
        out["gain"].append(splits[node] if inner else 0.0)
        below = h + s["regLambda"]
        out["value"].append(0.0 if inner or below <= 0 else float(-s["stepSize"] * shrunk(g, s["regAlpha"]) / below))
    return out


def with_thresholds(tree: dict, edges: list[np.ndarray]) -> dict:
    """Bins replaced by feature values: a row goes left up to the threshold."""
    cut = [float(edges[f][b]) if f >= 0 else 0.0 for f, b in zip(tree["feature"], tree["cut"], strict=True)]
    return {**tree, "cut": cut}


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Trees as JSON; adds ``probability`` and ``prediction``. Rows are scored in Arrow batches."""

    trees = _param("trees", "fitted trees", TypeConverters.toString)
    base = _param("base", "margin before the first tree", TypeConverters.toFloat)
    width = _param("width", "number of features", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(trees="[]", base=0.0, width=0)

    def tree_list(self) -> list[dict]:
        return json.loads(self.getOrDefault(self.trees))

    @property
    def featureImportances(self):
        """Share of every feature in the worth of all splits."""
        total = np.zeros(self.getOrDefault(self.width))
        for tree in self.tree_list():
            for feature, gain in zip(tree["feature"], tree["gain"], strict=True):
                if feature >= 0:
                    total[feature] += gain
        return Vectors.dense(total / (total.sum() or 1.0))

    def margins(self, x: np.ndarray) -> np.ndarray:
        return margins_of(self.tree_list(), self.getOrDefault(self.base), x)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        width, base, trees = self.getOrDefault(self.width), self.getOrDefault(self.base), self.tree_list()

        @F.arrow_udf("double")
        def chance(x: pa.Array) -> pa.Array:
            cells = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), width)
            return pa.array(0.5 * (1 + np.tanh(0.5 * margins_of(trees, base, cells))))

        p = chance(vector_to_array("features"))
        scored = dataset.withColumn("__p", p)
        vector = array_to_vector(F.array(1.0 - F.col("__p"), F.col("__p")))
        return scored.withColumns({"probability": vector, "prediction": (F.col("__p") > 0.5).cast("double")}).drop("__p")
