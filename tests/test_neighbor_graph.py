import numpy as np
import pytest
from pyspark.sql import functions as F

from wanewatch.operators import neighbor_graph, rebalance


def vectors(spark, m, labels=None):
    labels = [0] * len(m) if labels is None else labels
    rows = [(i, [float(x) for x in v], int(labels[i])) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "id bigint, v array<double>, label int").repartition(3)


def exact(m, k):
    gaps = np.sqrt(((m[:, None] - m[None]) ** 2).sum(2))
    np.fill_diagonal(gaps, np.inf)
    return np.argsort(gaps, axis=1, kind="stable")[:, :k], gaps


def test_recall_and_growth_of_visits(spark):
    """Three times the rows take far less than nine times the comparisons."""
    visits = {}
    for n in (600, 1800):
        rng = np.random.default_rng(n)
        m = rng.normal(size=(n, 8)) + rng.integers(0, 4, n)[:, None] * 3
        truth, gaps = exact(m, 5)
        found, visits[n] = neighbor_graph.graph_and_visits(
            vectors(spark, m), "id", "v", 5, width=12, trees=3, block_rows=64, rounds=2
        )
        rows = found.collect()
        assert sorted({r["rank"] for r in rows}) == [1, 2, 3, 4, 5] and len(rows) == 5 * n
        assert len({(r["id"], r["neighbor"]) for r in rows}) == 5 * n
        assert all(r["distance"] == pytest.approx(gaps[r["id"], r["neighbor"]]) for r in rows)
        hits = sum(r["neighbor"] in truth[r["id"]] for r in rows)
        assert hits / (5 * n) >= 0.95
    assert visits[1800] < 4 * visits[600]


def test_copies_groups_nulls_and_few_rows(spark):
    m = np.concatenate([np.ones((200, 3)), np.random.default_rng(1).normal(size=(100, 3)) * 5])
    df = vectors(spark, m, [0] * 250 + [1] * 50)
    holes = spark.createDataFrame([(900, None, 0), (None, [1.0, 1.0, 1.0], 0), (901, [1.0, 1.0, 1.0], None)], df.schema)
    found = neighbor_graph.nearest_by_graph(df.unionByName(holes), "id", "v", 3, group="label", width=8, block_rows=32)
    rows = {}
    for r in found.collect():
        rows.setdefault(r["id"], []).append((r["rank"], r["neighbor"], r["distance"]))
    assert set(rows) == set(range(300))
    assert sorted(rows[150]) == [(1, 0, 0.0), (2, 1, 0.0), (3, 2, 0.0)]
    assert all(n >= 250 for i in range(250, 300) for _, n, _ in rows[i])
    assert neighbor_graph.nearest_by_graph(df.where("id = 7"), "id", "v").count() == 0
    assert neighbor_graph.nearest_by_graph(df.limit(0), "id", "v").count() == 0
    two = neighbor_graph.nearest_by_graph(df.where(F.col("id").isin(7, 260)), "id", "v")
    assert sorted((r["id"], r["neighbor"]) for r in two.collect()) == [(7, 260), (260, 7)]


def test_rebalancing_with_the_graph(spark):
    rng = np.random.default_rng(3)
    labels = (np.arange(160) % 8 == 0).astype(int)
    m = rng.normal(size=(160, 2)) + labels[:, None] * 20
    df = vectors(spark, m, labels)
    one = rebalance.smote(df, "id", "label", "v", search=neighbor_graph.nearest_by_graph)
    other = rebalance.smote(df, "id", "label", "v")
    key = lambda made: sorted((r["id"], r["copy"], r["neighbor"]) for r in made.collect())
    assert key(one) == key(other) and one.count() == 120
