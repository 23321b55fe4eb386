"""Random forests whose trees weigh the classes of their own bootstrap, over summed histograms.

Rows are binned once and kept as blocks (see ``boosting``). A job counts one level of all trees
together: every task adds its rows by (tree and node, feature, bin) as mass of class 0, mass of
class 1 and rows; the tables are added up by ranges of nodes, and each range picks its own splits. Levels with more
cells than ``CELLS`` take several jobs, so what moves per job is bounded by the settings. Masses are whole
multiples of 2^-24, so sums do not depend on the order of tasks.

Once a level has more than ``DEALT_CELLS`` cells, the drawn rows of its nodes are dealt out, every node whole to one
task (nodes of more than ``NODE_ROWS`` rows are counted as before until they are smaller). From there on a level
is one job without a shuffle: a task finds the open nodes of its rows and picks their splits, and only
these come back. Trees are dealt out together as far as ``DEALT_ROWS`` rows go.

A row's weight in a tree is Poisson(1), drawn from (seed, tree, block); the input is written first,
so a block that is worked out again after an executor is lost holds the same rows. Class weights never
touch the rows: they scale the two masses when splits are compared, and with
``classWeights='balanced_subsample'`` they follow from the masses of a tree's own root.

A tree is as large as ``maxDepth`` (0: down to pure nodes, ``DEEPEST`` levels at most),
``minInstancesPerSplit``, ``minInstancesPerNode`` and ``maxNodes`` let it be; when nodes run out, those with
most rows are split first. No row is left out by any of them.
"""

from __future__ import annotations

import heapq
import json
import math
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.plans.boosting import (
    FEW,
    FIXED_POINT,
    _param,
    bin_edges,
    blocks_of,
    empty_tree,
    place,
    values_of,
    with_thresholds,
)
from wanewatch.session import cut_lineage

CELLS = 1 << 20  # cells (node, feature, bin) counted by one job
PAIRS = 1 << 20  # (row, feature) pairs a task looks at together
DEALT_CELLS = 1 << 16  # cells of a level beyond which rows are dealt out by node
DEALT_ROWS = 1 << 24  # rows, once per tree, dealt out together
NODE_ROWS = 1 << 18  # rows of a node that are dealt to one task
SENT_ROWS = 1 << 17  # rows a task gathers before it sends them
SMALL_TABLE = 1 << 15
DEEPEST = 30
WEIGHINGS = ("none", "balanced", "balanced_subsample")


class BootstrapForest(Estimator, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """Binary classifier on ``features`` and ``label``; an empty table gives trees of one leaf."""

    numTrees = _param("numTrees", "trees", TypeConverters.toInt)
    maxDepth = _param("maxDepth", "levels of splits, 0 for no limit", TypeConverters.toInt)
    maxBins = _param("maxBins", "bins of a feature, 256 at most", TypeConverters.toInt)
    maxNodes = _param("maxNodes", "nodes of a tree", TypeConverters.toInt)
    minInstancesPerNode = _param("minInstancesPerNode", "least rows of a child", TypeConverters.toInt)
    minInstancesPerSplit = _param("minInstancesPerSplit", "least rows of a node that is split", TypeConverters.toInt)
    featureSubsetStrategy = _param("featureSubsetStrategy", "'sqrt', 'log2' or 'all'", TypeConverters.toString)
    classWeights = _param("classWeights", "one of " + ", ".join(WEIGHINGS), TypeConverters.toString)
    bootstrap = _param("bootstrap", "draw rows per tree", TypeConverters.toBoolean)
    seed = _param("seed", "of row and feature samples", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, numTrees=100, maxDepth=0, maxBins=64, maxNodes=65_536, minInstancesPerNode=1,
        minInstancesPerSplit=2, featureSubsetStrategy="sqrt", classWeights="none", bootstrap=True, seed=42,
    ):
        super().__init__()
        self._setDefault(
            numTrees=100, maxDepth=0, maxBins=64, maxNodes=65_536, minInstancesPerNode=1,
            minInstancesPerSplit=2, featureSubsetStrategy="sqrt", classWeights="none", bootstrap=True, seed=42,
        )
        self._set(**self._input_kwargs)

    def settings(self) -> dict[str, object]:
        return {p.name: self.getOrDefault(p) for p in self.params if p.name != "weightCol"}

    def _fit(self, dataset: DataFrame) -> BootstrapForestModel:
        return self.fit_binned(self.binned(dataset))

    def binning(self) -> tuple[int, str | None]:
        """Estimators that agree in this learn from the same ``binned`` rows."""
        if self.getOrDefault(self.classWeights) not in WEIGHINGS:
            raise ValueError(f"unknown class weights: {self.getOrDefault(self.classWeights)}")
        return self.getOrDefault(self.maxBins), self.getWeightCol() if self.isDefined(self.weightCol) else None

    def binned(self, dataset: DataFrame) -> BinnedRows:
        bins, name = self.binning()
        weight = F.col(name) if name else F.lit(1.0)
        rows = cut_lineage(
            dataset.select(
                vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), weight.cast("double").alias("w")
            )
        )
        edges = bin_edges(rows, bins)
        zero, one, count = rows.agg(
            F.sum(F.when(F.col("y") != 1, F.col("w"))), F.sum(F.when(F.col("y") == 1, F.col("w"))), F.count("*")
        ).first()
        return BinnedRows(edges, (zero or 0.0, one or 0.0), blocks_of(rows, edges, 0.0, count))

    def fit_binned(self, table: BinnedRows, last: bool = True) -> BootstrapForestModel:
        """The model of binned rows, which are given up if no later fit needs them."""
        self.binning()  # of settings that are allowed
        trees = grow_forest(table.blocks, [len(e) + 1 for e in table.edges], table.totals, self.settings())
        if last:
            table.blocks.unpersist()
        made = BootstrapForestModel()
        made._set(trees=json.dumps([with_thresholds(t, table.edges) for t in trees]), width=len(table.edges))
        return made


@dataclass
class BinnedRows:
    """Rows as blocks of bin numbers, see ``blocks_of``, with the edges of the bins and the mass of both classes."""

    edges: list[np.ndarray]
    totals: tuple[float, float]
    blocks: RDD


def subset_size(strategy: str, features: int) -> int:
    sizes = {"sqrt": math.isqrt(features), "log2": int(math.log2(features or 1)), "all": features}
    if strategy not in sizes:
        raise ValueError(f"unknown feature subset: {strategy}")
    return max(1, sizes[strategy])


def balance(zero: float, one: float) -> tuple[float, float]:
    """Factors that give both classes half of the mass; a class without rows keeps its own."""
    total = zero + one
    return (total / (2 * zero) if zero > 0 else 1.0, total / (2 * one) if one > 0 else 1.0)


def drawn_rows(s: dict, tree: int, block: tuple, n: int) -> np.ndarray:
    """How often a tree takes every row of a block."""
    if not s["bootstrap"]:
        return np.ones(n)
    return np.random.default_rng([s["seed"], tree, *block]).poisson(1.0, n).astype(float)


def packed(tree: dict) -> dict[str, np.ndarray]:
    """What places and scores rows, as arrays; cut points keep their type."""
    kinds = {"feature": np.int32, "cut": None, "left": np.int32, "right": np.int32, "value": float}
    return {c: np.array(tree[c], kind) for c, kind in kinds.items()}


def count_nodes(blocks, sent, wanted, picked, width, cuts, factors, s) -> list[tuple]:
    """(sums [mass 0, mass 1, rows], best split or none) of the wanted nodes, in their order.

    Tables of integer sums (node, feature of its subset, bin, [mass 0, mass 1, rows]) are added up by
    ranges of nodes and the splits picked where the sums are, so the driver sees no table unless all
    of them are small. ``sent`` is a broadcast of the packed trees, one for all jobs of a level. ``wanted`` are
    (tree, node) in the order of the trees, ``picked`` their feature subsets.
    """
    many = picked.shape[1]
    order = np.array([t for t, _ in wanted])
    jobs = []
    for t in np.unique(order):
        mine = np.flatnonzero(order == t)
        jobs.append((int(t), np.array([wanted[i][1] for i in mine]), picked[mine], int(mine[0])))
    cells_of_all = len(wanted) * many * width

    def of(part):
        trees = sent.value
        total = np.zeros((3, cells_of_all), np.int64)
        slots = []
        for t, nodes, _, _ in jobs:
            slots.append(np.full(len(trees[t]["feature"]), -1))
            slots[-1][nodes] = np.arange(len(nodes))
        for name, cells, y, w, _ in part:
            for (t, _, features, first), slot in zip(jobs, slots, strict=True):
                drawn = drawn_rows(s, t, name, len(y))
                at = slot[place(trees[t], cells)]
                keep = np.flatnonzero((at >= 0) & (drawn > 0))
                mass = np.rint(w * drawn * FIXED_POINT)
                here = total[:, first * many * width : (first + len(features)) * many * width]
                add_rows(here, at[keep], features, cells[keep], y[keep] == 1, mass[keep], width)
        yield total

    sums = blocks.mapPartitions(of)
    light = sums.getNumPartitions() <= FEW and cells_of_all <= SMALL_TABLE
    shape, least = (3, len(wanted), many, width), s["minInstancesPerNode"]

    def judge(first, tables):
        tables = tables.transpose(1, 2, 3, 0)
        some = slice(first, first + len(tables))
        whole = tables[:, 0].sum(1)
        factor = [root_factors(w, factors[t], s) if node == 0 else factors[t] for w, (t, node) in zip(whole, wanted[some])]
        return judged_nodes(whole, gini_splits(tables, cuts[picked[some]], np.array(factor), least), picked[some])

    if light:
        return judge(0, sums.reduce(np.add).reshape(shape))
    step = -(-len(wanted) // min(len(wanted), sums.getNumPartitions()))

    def pieces(totals):
        for total in totals:
            for a in range(0, len(wanted), step):
                yield a, total.reshape(shape)[:, a : a + step]

    def judged(items):
        for a, tables in items:
            yield a, judge(a, tables)

    added = sums.mapPartitions(pieces).reduceByKey(np.add, min(sums.getNumPartitions(), -(-len(wanted) // step)))
    return [found for _, part in sorted(added.mapPartitions(judged).collect(), key=lambda p: p[0]) for found in part]


def add_rows(total, at, features, cells, one, mass, width) -> None:
    """Add rows to tables (mass 0, mass 1, rows) by (node, feature of its subset, bin); ``at`` is a row's node."""
    many = features.shape[1]
    step = max(1, PAIRS // many)
    for a in range(0, len(at), step):
        some = slice(a, a + step)
        cell = (at[some, None] * many + np.arange(many)) * width
        cell = (cell + np.take_along_axis(cells[some], features[at[some]], 1)).ravel()
        heavy, is_one = mass[some], one[some]
        # sums of so many rows stay below 2^53, so they are exact as doubles
        for k, value in enumerate((heavy * ~is_one, heavy * is_one, np.ones(len(heavy)))):
            total[k] += np.bincount(cell, np.repeat(value, many), total.shape[1]).astype(np.int64)


def judged_nodes(whole, best, picked) -> list[tuple]:
    """(sums, (gain, feature, bin, sums of the left child) or none) of every node, as plain numbers."""
    gain, place_of, cut, left = best
    feature = picked[np.arange(len(picked)), place_of]
    plain = (c.tolist() for c in (whole, gain, feature, cut, left))
    return [(w, (g, f, b, below) if g > 0 else None) for w, g, f, b, below in zip(*plain, strict=True)]


def deal_rows(blocks, sent, nodes, s):
    """RDD of tables (tree, node, bins, is of class 1, mass), one a partition: the drawn rows of the given nodes.

    ``nodes`` are (tree, node, rows). A node is whole in one partition, the one that had fewest rows when
    it was dealt, the largest nodes first.
    """
    total = sum(n for _, _, n in nodes)
    parts = max(blocks.getNumPartitions(), -(-total // NODE_ROWS))
    loads, homes = [(0, p) for p in range(parts)], {}
    for t, node, n in sorted(nodes, key=lambda x: -x[2]):
        load, p = heapq.heappop(loads)
        homes.setdefault(t, []).append((node, p))
        heapq.heappush(loads, (load + n, p))
    homes = {t: np.array(found).T for t, found in homes.items()}

    def of(part):
        trees, slots, ready, size = sent.value, {}, [], 0
        for t, (mine, home) in homes.items():
            slots[t] = np.full(len(trees[t]["feature"]), -1)
            slots[t][mine] = home
        for name, cells, y, w, _ in part:
            for t, slot in slots.items():
                drawn = drawn_rows(s, t, name, len(y))
                node = place(trees[t], cells)
                home = slot[node]
                keep = np.flatnonzero((home >= 0) & (drawn > 0))
                mass = np.rint(w * drawn * FIXED_POINT)[keep]
                ready.append((home[keep], np.full(len(keep), t, np.int32), node[keep].astype(np.int32), cells[keep], y[keep] == 1, mass))
                size += len(keep)
                if size >= SENT_ROWS:
                    yield from _by_home(ready)
                    ready, size = [], 0
        yield from _by_home(ready)

    def table(items):
        found = [rows for _, rows in items]
        if found:
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            order = np.argsort(columns[0], kind="stable")
            yield tuple(c[order] for c in columns)

    dealt = blocks.mapPartitions(of).partitionBy(parts, lambda home: home)
    return dealt.mapPartitions(table).persist(StorageLevel.MEMORY_AND_DISK)


def _by_home(ready):
    """(home, columns of its rows) of gathered rows."""
    if ready:
        home, *columns = (np.concatenate(c) for c in zip(*ready, strict=True))
        order = np.argsort(home, kind="stable")
        homes, first = np.unique(home[order], return_index=True)
        for p, rows in zip(homes.tolist(), np.split(order, first[1:]), strict=True):
            yield p, tuple(c[rows] for c in columns)


def judge_dealt(dealt, sent, many, width, cuts, factors, s) -> dict[tuple, tuple]:
    """What ``count_nodes`` says of the open nodes of dealt rows, by (tree, node)."""
    least, group = s["minInstancesPerNode"], max(1, DEALT_CELLS // (many * width))

    def of(part):
        trees = sent.value
        for tree, start, cells, one, mass in part:
            for t in [t for t in np.unique(tree).tolist() if t in trees]:
                a, b = np.searchsorted(tree, (t, t + 1))
                at = place(trees[t], cells[a:b], start[a:b])
                keep = np.flatnonzero(trees[t]["open"][at])
                keep = keep[np.argsort(at[keep], kind="stable")]
                nodes, first = np.unique(at[keep], return_index=True)
                keep, at, first = keep + a, at[keep], np.append(first, len(keep))
                for i in range(0, len(nodes), group):
                    some = nodes[i : i + group]
                    these = slice(first[i], first[i + len(some)])
                    mine = keep[these]
                    picked = np.array([_subset(s["seed"], t, node, len(cuts), many) for node in some.tolist()])
                    total = np.zeros((3, len(some) * many * width), np.int64)
                    add_rows(total, np.searchsorted(some, at[these]), picked, cells[mine], one[mine], mass[mine], width)
                    tables = total.reshape(3, len(some), many, width).transpose(1, 2, 3, 0)
                    factor = np.repeat([factors[t]], len(some), 0)
                    best = gini_splits(tables, cuts[picked], factor, least)
                    yield t, some.tolist(), judged_nodes(tables[:, 0].sum(1), best, picked)

    found = {}
    for t, nodes, judged in dealt.mapPartitions(of).collect():
        found |= zip([(t, node) for node in nodes], judged, strict=True)
    return found


def root_factors(sums: np.ndarray, given: tuple[float, float], s: dict) -> tuple[float, float]:
    """Class factors of a tree, which may follow from the masses of its root."""
    return balance(*(sums[:2] / FIXED_POINT)) if s["classWeights"] == "balanced_subsample" else given


def gini_splits(tables: np.ndarray, cuts: np.ndarray, factors: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(gain per mass, place in the subset, bin, sums of the left child) of every node; a gain of 0 is no split.

    The gain is the fall of the Gini impurity; of equal gain the first feature and bin win.
    """
    left = tables.cumsum(2)
    whole = left[:, :, -1:, :]
    right = whole - left
    zero, one = (factors[:, k, None, None] for k in (0, 1))

    def purity(sums):
        a, b = sums[..., 0] / FIXED_POINT * zero, sums[..., 1] / FIXED_POINT * one
        return (a * a + b * b) / np.where(a + b > 0, a + b, np.inf)

    mass = (whole[:, 0, 0, 0] * factors[:, 0] + whole[:, 0, 0, 1] * factors[:, 1]) / FIXED_POINT
    fall = (purity(left) + purity(right) - purity(whole)) / np.where(mass > 0, mass, np.inf)[:, None, None]
    allowed = np.arange(tables.shape[2]) < cuts[..., None] - 1
    allowed &= (left[..., 2] >= max(least, 1)) & (right[..., 2] >= max(least, 1))
    gain = np.where(allowed, np.round(fall, 12), 0.0).reshape(len(tables), -1)
    best, nodes = gain.argmax(1), np.arange(len(tables))
    i, b = np.divmod(best, tables.shape[2])
    return np.maximum(gain[nodes, best], 0.0) * mass, i, b, left[nodes, i, b]


def grow_forest(blocks, cuts: list[int], totals: tuple[float, float], s: dict) -> list[dict]:
    """All trees, level by level."""
    cuts = np.array(cuts, np.int64)
    trees = [empty_tree() for _ in range(s["numTrees"])]
    if not len(cuts) or sum(totals) <= 0:
        return trees
    many, width = subset_size(s["featureSubsetStrategy"], len(cuts)), int(cuts.max())
    group, deepest = max(1, CELLS // (many * width)), s["maxDepth"] or DEEPEST
    factors = [balance(*totals) if s["classWeights"] == "balanced" else (1.0, 1.0)] * len(trees)

    def send(level):
        """Trees with open nodes go out once a level; within a level no counted node changes."""
        out = {}
        for t, mine in groupby(level, key=lambda f: f[0]):
            out[t] = {**packed(trees[t]), "open": np.zeros(len(trees[t]["feature"]), bool)}
            out[t]["open"][[node for _, node, _ in mine]] = True
        return blocks.context.broadcast(out)

    def counted(level, sent):
        for a in range(0, len(level), group):
            wanted = [(t, node) for t, node, _ in level[a : a + group]]
            picked = np.array([_subset(s["seed"], t, node, len(cuts), many) for t, node in wanted])
            yield from zip(wanted, count_nodes(blocks, sent, wanted, picked, width, cuts, factors, s), strict=True)

    def grown(level, judged):
        """The next level: children that may be split again, those with most rows first within a tree."""
        fresh = []
        for t, node, _ in level:
            whole, found = judged[t, node]
            if node == 0:
                factors[t] = root_factors(np.array(whole), factors[t], s)
                trees[t]["value"][0] = _share(whole, factors[t])
                if whole[2] < s["minInstancesPerSplit"]:
                    continue
            if len(trees[t]["feature"]) + 2 > s["maxNodes"]:
                continue
            if found is not None:
                fresh += _split(trees[t], t, node, found, whole, factors[t])
        after = [f[:3] for f in fresh if f[3] and f[2] >= max(s["minInstancesPerSplit"], 2 * s["minInstancesPerNode"])]
        return sorted(after, key=lambda f: (f[0], -f[2], f[1]))

    level, depth = [(t, 0, 0) for t in range(len(trees))], 0
    while level and depth < deepest and (depth == 0 or len(level) * many * width <= DEALT_CELLS):
        sent = send(level)
        level = grown(level, dict(counted(level, sent)))
        sent.destroy()
        depth += 1
    for part in _together(level):
        dealt, kept, below = [], [], depth
        here: set[tuple[int, int]] = set()  # open nodes whose rows are dealt out
        while part and below < deepest:
            sent = send(part)
            light = [f for f in part if f[:2] not in here and f[2] <= NODE_ROWS]
            if light:
                dealt.append(deal_rows(blocks, sent, light, s))
                kept.append(sent)  # rows that are lost are dealt out again by the same trees
                here |= {f[:2] for f in light}
            judged = dict(counted([f for f in part if f[:2] not in here], sent))
            if dealt:
                judged |= judge_dealt(blocks.context.union(dealt), sent, many, width, cuts, factors, s)
            after = grown(part, judged)
            from_here = {(t, trees[t][side][node]) for t, node in here for side in ("left", "right")}
            part, here = after, {f[:2] for f in after if f[:2] in from_here}
            if not light:
                sent.destroy()
            below += 1
        for rows, sent in zip(dealt, kept, strict=True):
            rows.unpersist()
            sent.destroy()
    return trees


def _together(level: list[tuple]) -> list[list[tuple]]:
    """The open nodes of as many trees at a time as have ``DEALT_ROWS`` rows in them, of one at least."""
    parts, size = [], 0
    for _, mine in groupby(level, key=lambda f: f[0]):
        mine = list(mine)
        rows = sum(n for _, _, n in mine)
        if not parts or size + rows > DEALT_ROWS:
            parts.append([])
            size = 0
        parts[-1] += mine
        size += rows
    return parts


def _subset(seed: int, tree: int, node: int, features: int, many: int) -> np.ndarray:
    if many == features:
        return np.arange(features)
    return np.sort(np.random.default_rng([seed, tree, node, features]).choice(features, many, replace=False))


def _share(sums: np.ndarray, factors: tuple[float, float]) -> float:
    """Weighed share of class 1."""
    a, b = sums[0] * factors[0], sums[1] * factors[1]
    return float(b / (a + b)) if a + b > 0 else 0.0


def _split(tree: dict, t: int, node: int, found: tuple, whole, factors) -> list[tuple]:
    """Write a split down; (tree, node, rows, holds both classes) of the two children."""
    gain, feature, cut, left = found
    a = len(tree["feature"])
    tree["feature"][node], tree["cut"][node], tree["gain"][node] = feature, cut, gain
    tree["left"][node], tree["right"][node] = a, a + 1
    out = []
    for child, sums in ((a, left), (a + 1, [w - below for w, below in zip(whole, left, strict=True)])):
        for column, value in zip(("feature", "cut", "left", "right", "value", "gain"), (-1, 0, -1, -1, _share(sums, factors), 0.0), strict=True):
            tree[column].append(value)
        out.append((t, child, sums[2], sums[0] > 0 and sums[1] > 0))
    return out


class BootstrapForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Trees as JSON; ``probability`` is the mean of the leaves. Rows are scored in Arrow batches."""

    trees = _param("trees", "fitted trees", TypeConverters.toString)
    width = _param("width", "number of features", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(trees="[]", width=0)

    def tree_list(self) -> list[dict]:
        return json.loads(self.getOrDefault(self.trees))

    @property
    def getNumTrees(self) -> int:
        return len(self.tree_list())

    @property
    def featureImportances(self):
        """Mean over the trees of every feature's share in a tree's gain."""
        total = np.zeros(self.getOrDefault(self.width))
        for tree in self.tree_list():
            mine = np.zeros(len(total))
            for feature, gain in zip(tree["feature"], tree["gain"], strict=True):
                if feature >= 0:
                    mine[feature] += gain
            total += mine / (mine.sum() or 1.0)
        return Vectors.dense(total / (total.sum() or 1.0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        width, trees = self.getOrDefault(self.width), [packed(t) for t in self.tree_list()]

        @F.pandas_udf("double")
        def chance(x: pd.Series) -> pd.Series:
            cells = np.array(x.tolist(), float).reshape(len(x), width)
            cells = np.where(np.isnan(cells), np.inf, cells)
            return pd.Series(sum((values_of(t, cells) for t in trees), np.zeros(len(x))) / max(len(trees), 1))

        scored = dataset.withColumn("__p", chance(vector_to_array("features")))
        vector = array_to_vector(F.array(1.0 - F.col("__p"), F.col("__p")))
        return scored.withColumns({"probability": vector, "prediction": (F.col("__p") > 0.5).cast("double")}).drop("__p")
