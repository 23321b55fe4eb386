"""Lloyd clustering with the dimensions dealt out to shards, in whole numbers.

Vectors are scaled to integers and numbered in chunks of ``CHUNK`` rows; a chunk is cut into
blocks of ``WIDTH`` columns. A task works on cells of (block, chunk): it needs the slice of the
centroids that belongs to its block, never whole centroids or whole vectors. In a round

1. every cell gives its exact partial squared distances to all centroid slices;
2. ``reduceByKey`` adds the blocks of a chunk, and the smallest sum picks the centroid;
3. the chosen numbers go back to the cells, where they meet the block's columns without moving
   them (both sides have the same partitioning); every shard adds up its own columns and
   replaces its own slice by the floor of sum / count.

What is shuffled in a round is rows x blocks x centroids partial distances (32 bits each, if they
fit) and one byte or two per row and block on the way back. Cells are kept by Spark in memory or
on disk; a lost executor's cells are read and cut again. The driver holds the slices of the
centroids, k x dimensions numbers, nothing that grows with the rows.

Cases: vectors that are null, of another length, or hold null or non-finite components take no
part, nor do those with a scaled component of 2^27 or more in size, whose squared distances may
not fit 64 bits; repeated ids are rows of their own; a null id hashes like the empty text; fewer
rows than centroids give as many centroids as rows; an empty table gives no rows; sums of
distances beyond 64 bits are null; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.llm.common import spread, stored

CHUNK = 2048
WIDTH = 32
LIMIT = 1 << 27
SCALE = 1024


def whole_vectors(df: DataFrame, id_column: str, vector: str, dimensions: int) -> DataFrame:
    """(vec_id, v) of the vectors that take part, ``v`` as 32-bit integers."""
    x = F.col(vector)
    sound = (F.size(x) == dimensions) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LIMIT / SCALE)
    )
    rows = spread(df).filter(x.isNotNull()).filter(F.coalesce(sound, F.lit(False)))
    scaled = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("int"))
    return rows.select(F.col(id_column).alias("vec_id"), scaled.alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of their id, in that order; ties by components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    best = rows.select("v", F.sha2(name, 256).alias("h")).orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in best], np.int64)


def blocks_of(dimensions: int, width: int) -> list[tuple[int, int]]:
    return [(a, min(a + width, dimensions)) for a in range(0, dimensions, width)]


def partial_distances(cells: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroid slices, in the least width that holds them."""
    out = np.empty((len(cells), len(slices)), np.int64)
    for j, c in enumerate(slices):
        apart = cells - c
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out.astype(np.uint32) if not len(out) or out.max() < 1 << 32 else out


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) + b.astype(np.int64)


def chunks_of(rows: DataFrame, width: int, dimensions: int) -> DataFrame:
    """(chunk, block, cells) rows, and (chunk, -1, ids); a chunk never leaves its task."""
    spans = blocks_of(dimensions, width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a in range(0, len(batch), CHUNK):
                part = batch.iloc[a : a + CHUNK]
                v = np.array(part["v"].tolist(), np.int32).reshape(len(part), dimensions)
                ids = [None if pd.isna(i) else int(i) for i in part["vec_id"].tolist()]
                yield pd.DataFrame(
                    {"chunk": number, "block": range(len(spans)), "n": len(part), "ids": None,
                     "cells": [np.ascontiguousarray(v[:, x:y]).tobytes() for x, y in spans]}
                )
                yield pd.DataFrame({"chunk": [number], "block": [-1], "n": [len(part)], "ids": [ids], "cells": [None]})
                number += 1

    rows = rows.select(F.col("vec_id").cast("long"), "v")
    return rows.mapInPandas(run, "chunk long, block int, n int, ids array<long>, cells binary")


class Lloyd:
    """Centroid slices and the cells they are fitted on."""

    def __init__(self, table: DataFrame, start: np.ndarray, width: int = WIDTH):
        self.spark = table.sparkSession
        self.spans = blocks_of(start.shape[1], width)
        self.slices = [start[:, a:b].copy() for a, b in self.spans]
        cores = self.spark.sparkContext.defaultParallelism
        self.parts = max(cores, table.rdd.getNumPartitions())
        spans = self.spans
        cells = table.filter("block >= 0").select("chunk", "block", "n", "cells").rdd

        def one(r):
            a, b = spans[r["block"]]
            return (r["block"], r["chunk"]), np.frombuffer(r["cells"], np.int32).reshape(r["n"], b - a)

        self.cells = cells.map(one).partitionBy(self.parts).persist(StorageLevel.MEMORY_AND_DISK)

    def distances(self):
        """(chunk, distances to every centroid), summed over the blocks."""
        shared = self.spark.sparkContext.broadcast(self.slices)  # k x dimensions numbers

        def one(cell):
            (block, chunk), rows = cell
            return chunk, partial_distances(rows.astype(np.int64), shared.value[block])

        return self.cells.map(one).reduceByKey(added, self.parts)

    def round(self) -> bool:
        """Assign all rows and replace the slices; False when no slice has moved."""
        blocks, k = len(self.spans), len(self.slices[0])
        kind = np.uint8 if k <= 256 else np.uint32

        def chosen(pair):
            chunk, apart = pair
            number = apart.argmin(1).astype(kind)
            return [((block, chunk), number) for block in range(blocks)]

        def sums(pairs):
            """Of a partition: sums and counts per block, as exact Python numbers."""
            total = {}
            for (block, _), (rows, number) in pairs:
                if block not in total:
                    total[block] = [np.zeros((k, rows.shape[1]), object), np.zeros(k, object)]
                for j in np.unique(number).tolist():
                    mine = rows[number == j]
                    total[block][0][j] += mine.sum(0, dtype=np.int64).astype(object)
                    total[block][1][j] += len(mine)
            return iter(total.items())

        numbers = self.distances().flatMap(chosen).partitionBy(self.cells.getNumPartitions())
        met = self.cells.join(numbers, self.cells.getNumPartitions())
        shards = met.mapPartitions(sums).reduceByKey(lambda a, b: [a[0] + b[0], a[1] + b[1]])
        moved = dict(shards.mapValues(lambda t: floors(*t)).collect())
        before, self.slices = self.slices, []
        for block, old in enumerate(before):
            new, count = moved[block]
            self.slices.append(np.where((count > 0)[:, None], new, old))
        return any((a != b).any() for a, b in zip(before, self.slices, strict=True))

    def centroids(self) -> np.ndarray:
        return np.concatenate(self.slices, axis=1)


def floors(total: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Floor of sum / count of non-empty centroids; the others are left at zero."""
    n = np.where(count == 0, 1, count)
    return (total // n[:, None]).astype(np.int64), count.astype(np.int64)


def cluster(
    df: DataFrame,
    k: int = 8,
    rounds: int = 10,
    seed: int = 3,
    id_column: str = "vec_id",
    vector: str = "embedding",
    dimensions: int = 64,
    width: int = WIDTH,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids.

    A round that moves no slice ends the rounds early: all later ones would repeat it.
    """
    rows = whole_vectors(df, id_column, vector, dimensions)
    table = stored(chunks_of(rows, width, dimensions), "lloyd-chunks")
    start = first_centroids(rows, k, seed)
    schema = "vec_id long, cluster int, distance long"
    if not len(start):
        return df.sparkSession.createDataFrame([], schema), start
    model = Lloyd(table, start, width)
    for _ in range(rounds):
        if not model.round():
            break

    def last(pair):
        chunk, apart = pair
        number = apart.argmin(1)
        best = apart[np.arange(len(apart)), number].astype(np.int64)
        return chunk, number.astype(np.int32).tobytes(), best.tobytes()

    found = df.sparkSession.createDataFrame(
        model.distances().map(last), "chunk long, numbers binary, best binary"
    )
    found = stored(found, "lloyd-found")
    model.cells.unpersist()
    names = table.filter("block = -1").select("chunk", "ids").join(found, "chunk")

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                yield pd.DataFrame(
                    {"vec_id": pd.array([None if pd.isna(i) else int(i) for i in r.ids], "Int64"),
                     "cluster": np.frombuffer(r.numbers, np.int32), "distance": np.frombuffer(r.best, np.int64)}
                )

    return names.mapInPandas(spell, schema), model.centroids()


def digests(centroids: np.ndarray) -> list[str]:
    """sha256 of every centroid's components, as decimals joined by commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]


def with_inertia(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``rows`` with the sums of distances of their cluster and of all, and the centroid's digest."""
    spark = rows.sparkSession
    marks = spark.createDataFrame(list(enumerate(digests(centroids))), "cluster int, centroid_sha256 string")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = rows.groupBy("cluster").agg(wide.alias("s"))  # one row per centroid
    sums = sums.withColumn("t", F.sum("s").over(Window.partitionBy()))
    sums = sums.select("cluster", F.col("s").try_cast("long").alias("cluster_inertia"), F.col("t").try_cast("long").alias("inertia"))
    few = F.broadcast(sums.join(F.broadcast(marks), "cluster"))
    return rows.join(few, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
