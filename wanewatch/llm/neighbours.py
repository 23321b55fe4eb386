"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded, hash-chosen sample of the vectors. A vector is represented by its
``length`` nearest pivots in order. It belongs to the cell of its first pivot; cells are cut
into blocks of at most ``block_rows`` vectors, and in a block every pivot has an inverted file
with the vectors that hold it and its place in their order. A query visits the cells of its
``visits`` nearest pivots, adds up the footrule distance along the inverted files of its own
pivots, keeps the closest ``share`` of a block, and ranks those by their exact inner product.
All rows are indexed; queries come in blocks, so a task holds two bounded blocks.

Cases: vectors that are null, all zero, or hold a null or non-finite number take no part, nor
do those of another length than the most common one; equal vectors tie and the smaller id wins;
repeated ids count as rows of their own, but a query never finds its own id; a query that found
too few in its cells is searched in all of them; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.llm.common import stored

PIVOTS, LENGTH, VISITS, SHARE = 64, 32, 56, 0.5
BLOCK_ROWS, QUERY_ROWS = 4096, 2048


def clean(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(vec_id).alias("vec_id"), v.alias("vector")).filter(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0)
    )
    top = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (top["n"] if top else 0))


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` nearest pivots of every vector, nearest first."""
    scaled = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.argsort(-(scaled @ pivots.T), axis=1, kind="stable")[:, :length].astype(np.int16)


def footrule(rows: np.ndarray, queries: np.ndarray, n_pivots: int) -> np.ndarray:
    """(query, row) footrule of the orders; a missing pivot counts as placed behind the last."""
    length = rows.shape[1]
    whole = length * (length + 1) // 2
    out = np.full((len(queries), len(rows)), 2 * whole, np.int32)
    row_at, query_at = (np.full((len(o), n_pivots), -1, np.int16) for o in (rows, queries))
    place = np.arange(length, dtype=np.int16)
    np.put_along_axis(row_at, rows.astype(np.int64), place[None], 1)
    np.put_along_axis(query_at, queries.astype(np.int64), place[None], 1)
    for p in range(n_pivots):  # one inverted file after the other
        posted, asked = np.flatnonzero(row_at[:, p] >= 0), np.flatnonzero(query_at[:, p] >= 0)
        if len(posted) and len(asked):
            a = query_at[asked, p].astype(np.int32)[:, None]
            b = row_at[posted, p].astype(np.int32)[None]
            out[np.ix_(asked, posted)] += np.abs(a - b) - (length - a) - (length - b)
    return out


def best_of_block(
    ids, vectors, rows, query_ids, query_vectors, queries, n_pivots: int, k: int, share: float
) -> pd.DataFrame:
    """The k best rows of a block for every query: footrule first, then exact products."""
    keep = min(len(ids), max(2 * k, math.ceil(share * len(ids))))
    far = footrule(rows, queries, n_pivots)
    far[query_ids[:, None] == ids[None]] = np.iinfo(np.int32).max
    limit = np.partition(far, keep - 1, axis=1)[:, keep - 1 :keep]
    product = query_vectors @ vectors.T
    product[(far > limit) | (far == np.iinfo(np.int32).max)] = -np.inf
    floor = -np.partition(-product, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
    q, r, s = [], [], []
    for i in range(len(query_ids)):
        margin = 1e-9 * max(1.0, abs(floor[i])) if np.isfinite(floor[i]) else 0.0
        near = np.flatnonzero((product[i] >= floor[i] - margin) & np.isfinite(product[i]))
        exact = (vectors[near] * query_vectors[i]).sum(1)  # the same order of sums for equal vectors
        first = np.lexsort((ids[near], -exact))[:k]
        q.append(np.full(len(first), query_ids[i]))
        r.append(ids[near][first])
        s.append(exact[first])
    return pd.DataFrame({"query_id": np.concatenate(q), "vec_id": np.concatenate(r), "score": np.concatenate(s)})


def search(
    df: DataFrame,
    queries: DataFrame,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    length: int = LENGTH,
    visits: int = VISITS,
    share: float = SHARE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found, by inner product."""
    spark = df.sparkSession
    kind = df.schema[vec_id].dataType.simpleString()
    out = f"query_id {kind}, rank int, vec_id {kind}, score double"
    rows = clean(df, vec_id, vector)
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(pivots).collect()
    if not sample:
        return spark.createDataFrame([], out)
    points = np.array([r["vector"] for r in sample])
    points = np.unique(points / np.linalg.norm(points, axis=1, keepdims=True), axis=0)
    n_pivots, n_dims = points.shape
    depth = min(length, n_pivots)

    def index(batches):
        for batch in batches:
            if len(batch):
                order = orders(np.stack(batch["vector"]), points, depth)
                yield batch.assign(order=list(order), cell=order[:, 0])

    schema = f"vec_id {kind}, vector array<double>, order array<short>, cell int"
    indexed = stored(rows.mapInPandas(index, schema), "ann-index")
    sizes = {r["cell"]: r["count"] for r in indexed.groupBy("cell").count().collect()}
    total = sum(sizes.values())
    blocks = {c: -(-n // BLOCK_ROWS) for c, n in sizes.items()}
    asked = clean(queries, vec_id, vector).filter(F.size("vector") == n_dims)

    def route(limit: int):
        def run(batches):
            for batch in batches:
                if not len(batch):
                    continue
                every = orders(np.stack(batch["vector"]), points, n_pivots)
                for a in range(0, len(batch), 1000):
                    part, full = batch.iloc[a : a + 1000], every[a : a + 1000]
                    goals = [[(c, b) for c in row[:limit].tolist() for b in range(blocks.get(c, 0))] for row in full]
                    at = np.repeat(np.arange(len(part)), [len(g) for g in goals])
                    flat = np.array([x for g in goals for x in g], np.int64).reshape(-1, 2)
                    yield pd.DataFrame(
                        {"vec_id": part["vec_id"].to_numpy()[at], "vector": part["vector"].to_numpy()[at],
                         "order": list(full[at, :depth]), "cell": flat[:, 0], "block": flat[:, 1]}
                    )

        return run

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best_of_block(
            left["vec_id"].to_numpy(), np.stack(left["vector"]), np.stack(left["order"]),
            right["vec_id"].to_numpy(), np.stack(right["vector"]), np.stack(right["order"]),
            n_pivots, k, share,
        )

    def found(wanted: DataFrame, limit: int) -> DataFrame:
        groups = max(1, -(-wanted.count() // QUERY_ROWS))
        count = F.create_map(*[F.lit(x) for item in blocks.items() for x in item])
        block = F.pmod(F.xxhash64("vec_id", F.lit(5)), count[F.col("cell")]).cast("long")
        left = indexed.withColumn("block", block).withColumn(
            "part", F.explode(F.array(*[F.lit(i) for i in range(groups)]) if groups <= 64 else F.sequence(F.lit(0), F.lit(groups - 1)))
        )
        right = (
            wanted.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(groups)).cast("int"))
        )
        routed = right.select("part", "vec_id", "vector").mapInPandas(
            _with_part(route(limit)), f"part int, {schema}, block long"
        )
        key = ["cell", "block", "part"]
        best = left.groupBy(*key).cogroup(routed.groupBy(*key)).applyInPandas(
            compare, f"query_id {kind}, vec_id {kind}, score double"
        )
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    columns = ["query_id", "rank", "vec_id", "score"]
    first = stored(found(asked, min(visits, n_pivots)).select(*columns), "ann-found")
    got = first.groupBy("query_id").agg(F.count("*").alias("n"))
    short = asked.join(got, asked["vec_id"] == got["query_id"], "left").filter(
        F.coalesce("n", F.lit(0)) < min(k, total - 1)
    ).select(asked["vec_id"], "vector")
    if visits >= n_pivots or short.isEmpty():
        return first
    again = found(short, n_pivots).select(*columns)
    return first.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").union(again)


def _with_part(run):
    """``run`` on batches of one query group at a time, with the group's number put back."""

    def outer(batches):
        for batch in batches:
            for part, rows in batch.groupby("part"):
                for made in run(iter([rows.drop(columns="part")])):
                    made.insert(0, "part", part)
                    yield made

    return outer
