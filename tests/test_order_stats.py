import numpy as np
import pytest
from pyspark.sql import functions as F

from wanewatch.operators import evaluate, neighbors, order_stats, rebalance, split


def test_quantiles_match_numpy_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=4000), np.full(2000, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = order_stats.quantiles(order_stats.long_form(df, ["x"]), probs)["x"]
    assert np.allclose(found, np.percentile(values, [p * 100 for p in probs]))


def test_missed_bracket_is_searched_again(spark, monkeypatch):
    """With a sketch far too coarse the full pass still gives the exact value."""
    monkeypatch.setattr(order_stats, "SKETCH_ACCURACY", 3)
    monkeypatch.setattr(order_stats, "GRID_STEPS", 100)
    monkeypatch.setattr(order_stats, "SLACK", 0.0)
    values = list(range(1000))
    df = spark.createDataFrame([("g", v) for v in values], "g string, x bigint").repartition(5)
    sizes, found = order_stats.ranks_of(df, lambda _g, _n: [0, 137, 500, 999])
    assert sizes == {"g": 1000} and found["g"] == {0: 0, 137: 137, 500: 500, 999: 999}


def test_wide_brackets_are_narrowed_until_few_values_are_left(spark, monkeypatch):
    """With room for five values per sort every bracket needs rounds; a hot value holds a third."""
    rng = np.random.default_rng(11)
    hot = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25)])
    data = {"a": hot, "b": rng.integers(0, 40, 2000).astype(float), "c": np.array([7.0])}
    rows = [(g, float(v)) for g, values in data.items() for v in values]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    monkeypatch.setattr(order_stats, "SORTED_VALUES", 5)
    monkeypatch.setattr(order_stats, "TREE_LEVELS", 2)
    monkeypatch.setattr(order_stats, "SLACK", 0.2)
    asked = lambda _g, n: sorted({0, n // 7, n // 2, n - 1})
    sizes, found = order_stats.ranks_of(df, asked)
    for g, values in data.items():
        ordered = np.sort(values)
        assert sizes[g] == len(values)
        assert found[g] == {r: ordered[r] for r in asked(g, len(values))}


@pytest.mark.parametrize("limit", [3, 40, 10_000])
def test_running_totals_at_any_depth(spark, limit, monkeypatch):
    monkeypatch.setattr(order_stats, "TREE_LEVELS", 2)
    rng = np.random.default_rng(12)
    rows = [(g, float(x), int(n)) for g, size in (("a", 300), ("b", 7), ("c", 1)) for x, n in zip(rng.permutation(size), rng.integers(0, 9, size))]
    df = spark.createDataFrame(rows, "g string, x double, n bigint").repartition(5)
    made = order_stats.running_before(df, ["g"], "x", ["n"], limit)
    assert made.columns == ["g", "x", "n", "before_n"]
    expected = {(g, x): sum(m for h, y, m in rows if h == g and y < x) for g, x, _ in rows}
    assert {(r["g"], r["x"]): r["before_n"] for r in made.collect()} == expected
    assert order_stats.running_before(df.where("g = 'a'").drop("g"), [], "x", ["n"], limit).count() == 300
    assert order_stats.running_before(df.limit(0), ["g"], "x", ["n"], limit).count() == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert order_stats.medians(df, ["x"]) == {"x": None}


def labelled(spark, n=600, rare=3):
    return spark.createDataFrame(
        [(str(i), int(i % rare == 0)) for i in range(n)], "id string, label int"
    ).repartition(3)


def test_split_sizes_are_exact_and_stable(spark):
    shares = {"train": 0.7, "val": 0.1, "test": 0.2}
    a = split.stratified_split(labelled(spark), "id", "label", shares)
    b = split.stratified_split(labelled(spark).repartition(5), "id", "label", shares)
    counted = {(r["label"], r["part"]): r["n"] for r in a.groupBy("label", "part").agg(F.count("*").alias("n")).collect()}
    assert counted[0, "test"] == 80 and counted[1, "test"] == 40
    assert counted[0, "val"] == 40 and counted[1, "train"] == 140
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_folds_cover_each_row_once(spark):
    df = split.folds(labelled(spark, 303), "id", "label", 5)
    assert df.count() == 303 and df.where("fold is null").count() == 0
    per = df.groupBy("label", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in per if r["label"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_tiny_class_in_folds(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 0)], "id string, label int")
    made = split.folds(df, "id", "label", 5)
    assert made.count() == 3 and made.where("fold is null").count() == 0


def test_undersample_and_weights(spark):
    df = labelled(spark, 500, 10)
    sizes = {r["label"]: r["count"] for r in split.undersample(df, "id", "label").groupBy("label").count().collect()}
    assert sizes == {0: 50, 1: 50}
    weights = {r["label"]: r["weight"] for r in split.class_weights(df, "label").distinct().select("label", "weight").collect()}
    assert weights[0] == pytest.approx(500 / (2 * 450)) and weights[1] == pytest.approx(5.0)


def vectors(spark, m, labels=None):
    labels = [0] * len(m) if labels is None else labels
    rows = [(i, [float(x) for x in v], int(labels[i])) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "id bigint, v array<double>, label int").repartition(3)


@pytest.mark.parametrize("block", [25, 4000])
def test_neighbours_match_brute_force(spark, block):
    """Clusters, and one spot that holds a third of all points."""
    rng = np.random.default_rng(2)
    m = np.concatenate([rng.normal(size=(60, 3)), rng.normal(size=(60, 3)) + 9, np.ones((60, 3))])
    gaps = np.sqrt(((m[:, None] - m[None]) ** 2).sum(2))
    np.fill_diagonal(gaps, np.inf)
    expected = {
        (i, int(j), r + 1)
        for i in range(len(m))
        for r, j in enumerate(np.lexsort((np.arange(len(m)), gaps[i]))[:4])
    }
    found = neighbors.nearest(vectors(spark, m), "id", "v", 4, block_rows=block)
    assert {(r["id"], r["neighbor"], r["rank"]) for r in found.collect()} == expected


def test_copies_beyond_k_get_the_lowest_ids(spark):
    found = neighbors.nearest(vectors(spark, [[1.0, 1.0]] * 50 + [[2.0, 2.0]]), "id", "v", 3)
    rows = {}
    for r in found.collect():
        rows.setdefault(r["id"], []).append((r["rank"], r["neighbor"]))
    assert len(rows) == 51
    assert sorted(rows[40]) == [(1, 0), (2, 1), (3, 2)]
    assert sorted(rows[1]) == [(1, 0), (2, 2), (3, 3)]
    assert sorted(rows[50]) == [(1, 0), (2, 1), (3, 2)]


def test_neighbours_of_small_groups(spark):
    m = [[0.0], [1.0], [5.0]]
    found = neighbors.nearest(vectors(spark, m, [0, 0, 1]), "id", "v", 5, group="label")
    assert sorted((r["id"], r["neighbor"]) for r in found.collect()) == [(0, 1), (1, 0)]


def test_smote_raises_the_minority_between_its_rows(spark):
    rng = np.random.default_rng(3)
    labels = (np.arange(120) % 8 == 0).astype(int)
    m = rng.normal(size=(120, 2)) + labels[:, None] * 20
    made = rebalance.rebalance(vectors(spark, m, labels), "id", "label", "v", "SMOTE")
    rows = made.collect()
    assert sum(r["label"] for r in rows) == 105 and len(rows) == 210
    low, high = m[labels == 1].min(0), m[labels == 1].max(0)
    for r in rows:
        if r["copy"]:
            assert (np.array(r["v"]) >= low - 1e-9).all() and (np.array(r["v"]) <= high + 1e-9).all()


def test_adasyn_and_its_fallback(spark):
    rng = np.random.default_rng(4)
    labels = (np.arange(100) % 5 == 0).astype(int)
    mixed = vectors(spark, rng.normal(size=(100, 2)), labels)
    made = rebalance.rebalance(mixed, "id", "label", "v", "ADASYN")
    assert abs(made.where("label = 1").count() - 80) <= 20
    apart = vectors(spark, rng.normal(size=(100, 2)) + labels[:, None] * 50, labels)
    assert rebalance.rebalance(apart, "id", "label", "v", "ADASYN").where("label = 1").count() == 80


def test_one_row_class_cannot_be_interpolated(spark):
    with pytest.raises(ValueError):
        rebalance.smote(vectors(spark, [[0.0], [1.0], [2.0]], [0, 0, 1]), "id", "label", "v")


def test_other_strategy_changes_nothing(spark):
    df = vectors(spark, [[0.0], [1.0], [2.0]], [0, 0, 1])
    assert rebalance.rebalance(df, "id", "label", "v", "other").count() == 3


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()
    return wins / (len(pos) * len(neg))


def test_auc_with_ties_and_many_values(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 900)
    p = np.where(np.arange(900) % 3 == 0, 0.5, rng.random(900))
    df = spark.createDataFrame(
        [("m", int(a), float(b)) for a, b in zip(y, p)], "model string, label int, p double"
    ).repartition(4)
    found = evaluate.roc_auc(df, "label", "p", ["model"]).first()["roc_auc"]
    assert found == pytest.approx(brute_auc(y, p))


def test_metrics_of_a_group_without_scores(spark, monkeypatch):
    """Missing and NaN scores have no class; a group of them alone keeps its row; small ranges."""
    monkeypatch.setattr(order_stats, "SORTED_VALUES", 4)
    rng = np.random.default_rng(6)
    y, p = rng.integers(0, 2, 200), rng.random(200)
    rows = [("m", int(a), float(b)) for a, b in zip(y, p)] + [("m", 1, None), ("m", 0, float("nan")), ("m", None, 0.9), ("none", 1, None)]
    df = spark.createDataFrame(rows, "model string, label int, p double").repartition(4)
    found = {r["model"]: r for r in evaluate.metrics(df, "label", "p", ["model"]).collect()}
    assert set(found) == {"m", "none"} and found["none"]["roc_auc"] == found["none"]["tp"] == 0
    m = found["m"]
    said = p > 0.5
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == ((~said & (y == 0)).sum(), (said & (y == 0)).sum(), (~said & (y == 1)).sum(), (said & (y == 1)).sum())
    assert m["roc_auc"] == pytest.approx(brute_auc(y, p))
    empty = evaluate.metrics(df.limit(0), "label", "p", []).first()
    assert empty["tp"] == 0 and empty["roc_auc"] == 0.0 and empty["accuracy"] == 0.0


def test_one_class_gives_zeros(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7)], "label int, p double")
    row = evaluate.metrics(df, "label", "p", []).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 1, 0, 0)
    assert row["roc_auc"] == 0.0 and row["recall"] == 0.0 and row["f1"] == 0.0


def test_known_confusion_matrix(spark):
    df = spark.createDataFrame([(473, 45, 91, 96)], "tn bigint, fp bigint, fn bigint, tp bigint")
    row = evaluate.rates(df).first()
    assert row["accuracy"] == pytest.approx(0.8070921985815603)
    assert row["precision"] == pytest.approx(0.6808510638297872)
    assert row["recall"] == pytest.approx(0.5133689839572193)
    assert row["f1"] == pytest.approx(0.5853658536585366)
    assert row["specificity"] == pytest.approx(0.9131274131274131)


def test_rows_are_sent_to_few_chunks_whatever_the_blocks(spark, monkeypatch):
    """Small blocks in many dimensions: a row goes to each chunk once, not to every block."""
    seen, across = [], neighbors._across
    monkeypatch.setattr(neighbors, "_across", lambda local, *a: seen.append(local) or across(local, *a))
    m = np.random.default_rng(8).normal(size=(1500, 16))
    gaps = np.sqrt(((m[:, None] - m[None]) ** 2).sum(2))
    np.fill_diagonal(gaps, np.inf)
    found = neighbors.nearest(vectors(spark, m), "id", "v", 3, block_rows=8).collect()
    expected = {(i, int(j), r + 1) for i in range(1500) for r, j in enumerate(np.argsort(gaps[i])[:3])}
    assert {(r["id"], r["neighbor"], r["rank"]) for r in found} == expected
    assert seen[0].agg(F.avg(F.size("reach"))).first()[0] <= 20


def test_many_equal_distances_large_values_and_holes(spark):
    """Ties go by id; far-off values keep their order; a vector that is not finite hides no other."""
    rng = np.random.default_rng(9)
    ties = rng.integers(0, 2, (400, 12)).astype(float)
    for m in (ties, ties[:200] * 1e-3 + 1e6, rng.normal(size=(200, 3)) * 1e20):
        gaps = np.sqrt(((m[:, None] - m[None]) ** 2).sum(2))
        np.fill_diagonal(gaps, np.inf)
        expected = {(i, int(j), r + 1) for i in range(len(m)) for r, j in enumerate(np.lexsort((np.arange(len(m)), gaps[i]))[:4])}
        df = vectors(spark, np.concatenate([m, np.full((1, m.shape[1]), np.nan)]))
        found = neighbors.nearest(df, "id", "v", 4, block_rows=32).collect()
        assert {(r["id"], r["neighbor"], r["rank"]) for r in found} == expected


def test_adasyn_searches_once(spark):
    """Hardness, its total and the test for copies read one search; so do the drawn neighbours."""
    rng = np.random.default_rng(4)
    labels = (np.arange(100) % 5 == 0).astype(int)
    rows = spark.sparkContext.accumulator(0)

    def search(*args, **more):
        def counted(batches):
            for pdf in batches:
                rows.add(len(pdf))
                yield pdf

        found = neighbors.nearest(*args, **more)
        return found.mapInPandas(counted, found.schema)

    made = rebalance.adasyn(vectors(spark, rng.normal(size=(100, 2)), labels), "id", "label", "v", search=search)
    assert made.count() > 0 and rows.value == 5 * 100 + 5 * 20


@pytest.mark.parametrize("length", [None, 0.4])
def test_hashing_keeps_the_best_of_a_bucket_only(spark, monkeypatch, length):
    """Same answers as the join over all pairs of a bucket; what is ranked stays near k a row."""
    ranked, seen = neighbors._ranked, []
    monkeypatch.setattr(neighbors, "_ranked", lambda pairs, k: seen.append(pairs) or ranked(pairs, k))
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 100)
    m = np.random.default_rng(10).normal(size=(300, 4)) * 0.4
    df = vectors(spark, np.concatenate([m, m[:1]]))
    points = df.select("id", neighbors.array_to_vector("v").alias("features"))
    model = neighbors.BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=length or 1.2, numHashTables=4, seed=42
    ).fit(points)
    pairs = model.approxSimilarityJoin(points, points, 1.2, "d").select("datasetA.id", F.col("datasetB.id").alias("n"), "d").collect()
    best = {}
    for r in pairs:
        if r["id"] != r["n"]:
            best.setdefault(r["id"], []).append((round(r["d"], 9), r["n"]))
    expected = {(i, n, at + 1) for i, near in best.items() for at, (_, n) in enumerate(sorted(near)[:5])}
    found = neighbors.nearest_by_hashing(df, "id", "v", 5, radius=1.2, bucket_length=length)
    assert {(r["id"], r["neighbor"], r["rank"]) for r in found.collect()} == expected
    if length is None:
        assert seen[0].count() < len(pairs) / 2
