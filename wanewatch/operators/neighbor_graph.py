"""k nearest neighbours by a graph that is refined, for tables the exact search is too dear for.

Rows are sorted by the sides of a few random hyperplanes they lie on and cut into blocks of a
fixed size, several times with other planes; the nearest of a row inside its blocks are its first
neighbours. Each round then compares, around every row, the rows that are linked with it, as
neighbours of neighbours are likely neighbours. Work per row is set by the block size, the width
and the rounds, not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.functions.scalars import hash_int
from wanewatch.operators.neighbors import _beyond
from wanewatch.session import cut_lineage

PLANES = 30
EDGES = "id bigint, neighbor bigint, distance double"


def nearest_by_graph(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 5,
    *,
    group: str | None = None,
    width: int = 30,
    trees: int = 4,
    block_rows: int = 256,
    rounds: int = 3,
) -> DataFrame:
    """(id, neighbor, rank, distance): about the k nearest other rows of each row.

    The arguments are those of ``neighbors.nearest``: keys are unique bigints, rows without a key,
    vector or group take no part, equal vectors beyond k + 1 get their answer without a search.
    Distances are exact; a neighbour may be missed. ``width`` is the number of links kept.
    """
    return graph_and_visits(
        df, key, vector, k, group=group, width=width, trees=trees, block_rows=block_rows, rounds=rounds
    )[0]


def graph_and_visits(
    df: DataFrame, key: str, vector: str, k: int = 5, *, group: str | None = None,
    width: int = 30, trees: int = 4, block_rows: int = 256, rounds: int = 3,
) -> tuple[DataFrame, int]:
    """The neighbours and the number of vector comparisons they took."""
    width = max(width, k)
    points = df.select(
        F.col(key).cast("bigint").alias("id"),
        (F.col(group).cast("string") if group else F.lit("all")).alias("grp"),
        F.col(vector).cast("array<double>").alias("v"),
    ).where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.col("grp").isNotNull())
    points = cut_lineage(points)
    same = Window.partitionBy("grp", "v").orderBy("id")
    kept = cut_lineage(
        points.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1).drop("place")
    )
    edges, visits = _counted(_first_links(kept, width, trees, block_rows))
    links = cut_lineage(_shortest(edges, width))
    for turn in range(rounds):
        edges, more = _counted(_local_joins(kept, links, width, turn))
        visits += more
        links = cut_lineage(_shortest(links.unionByName(edges), width))
    w = Window.partitionBy("id").orderBy("distance", "neighbor")
    found = (
        links.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("id", "neighbor", "rank", "distance")
    )
    return found.unionByName(_beyond(points, kept, k)), visits


def _counted(edges: DataFrame) -> tuple[DataFrame, int]:
    """Written edges without the rows that only report comparisons, and the sum of those."""
    edges = cut_lineage(edges)
    reports = edges.where(F.col("id").isNull()).agg(F.sum("neighbor")).first()[0]
    return edges.where(F.col("id").isNotNull()), int(reports or 0)


def _shortest(edges: DataFrame, width: int) -> DataFrame:
    """The ``width`` shortest edges of every row; the same pair counts once."""
    w = Window.partitionBy("id").orderBy("distance", "neighbor")
    return (
        edges.repartition("id")
        .groupBy("id", "neighbor")
        .agg(F.min("distance").alias("distance"))
        .withColumn("place", F.row_number().over(w))
        .where(F.col("place") <= width)
        .drop("place")
    )


def _runs(
    batches: Iterator[pd.DataFrame], keys: list[str], size: int | None = None
) -> Iterator[tuple[pd.DataFrame, np.ndarray, int, int]]:
    """(rows, vectors, start, end) of each run of equal keys in sorted rows, across batches.

    With ``size`` a run is cut into pieces of that many rows. Only an unfinished piece is carried.
    """
    rest = None
    for pdf in batches:
        if rest is not None and len(rest):
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if pdf.empty:
            continue
        m = np.stack(pdf["v"].to_numpy())
        change = np.zeros(len(pdf), dtype=bool)
        for c in keys:
            values = pdf[c].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        starts = np.concatenate([[0], np.flatnonzero(change)])
        ends = np.append(starts[1:], len(pdf))
        for start, end in zip(starts, ends):
            step = size or (end - start)
            last = end == len(pdf)
            for at in range(start, end, step):
                if last and (at + step > end or size is None):
                    start = at
                    break
                yield pdf, m, at, min(at + step, end)
            else:
                start = end
        rest = pdf.iloc[start:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest, np.stack(rest["v"].to_numpy()), 0, len(rest)


def _edge_frame(ids, rows, cols, gaps, visits) -> pd.DataFrame:
    """Edges, and one row without id that reports the comparisons."""
    out = pd.DataFrame({"id": ids[rows], "neighbor": ids[cols], "distance": gaps})
    report = pd.DataFrame({"id": [pd.NA], "neighbor": [visits], "distance": [0.0]})
    return pd.concat(
        [out.astype({"id": "Int64"}), report.astype({"id": "Int64"})], ignore_index=True
    )


def _rough(m: np.ndarray) -> np.ndarray:
    squares = (m**2).sum(1)
    gaps = squares[:, None] + squares[None, :] - 2.0 * m @ m.T
    np.fill_diagonal(gaps, np.inf)
    return gaps


def _first_links(points: DataFrame, width: int, trees: int, block_rows: int) -> DataFrame:
    """Nearest rows inside blocks of rows that lie on the same sides of random hyperplanes.

    The planes halve the way between pairs of rows drawn by hash: 2 * PLANES rows a tree.
    """
    drawn = points.orderBy(hash_int("id"), "id").limit(2 * PLANES * trees).collect()
    if len(drawn) < 2:
        return points.sparkSession.createDataFrame([], EDGES)
    m = np.array([r["v"] for r in drawn], dtype=float)
    draw = np.random.default_rng(7)
    pairs = np.array([draw.choice(len(m), 2, replace=False) for _ in range(PLANES * trees)])
    planes = m[pairs[:, 0]] - m[pairs[:, 1]]
    offsets = (planes * (m[pairs[:, 0]] + m[pairs[:, 1]]) / 2).sum(1)
    places = 2 ** np.arange(PLANES, dtype=np.int64)[::-1]

    def code(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            sides = np.stack(pdf["v"].to_numpy()) @ planes.T > offsets
            for t in range(trees):
                bits = sides[:, t * PLANES : (t + 1) * PLANES]
                yield pdf.assign(tree=t, code=bits @ places)

    def link(batches):
        for pdf, vectors, start, end in _runs(batches, ["grp", "tree"], block_rows):
            ids, m = pdf["id"].to_numpy()[start:end], vectors[start:end]
            size = end - start
            rows = cols = np.zeros(0, dtype=int)
            if size > 1:
                near = min(width, size - 1)
                cols = np.argpartition(_rough(m), near - 1, axis=1)[:, :near].ravel()
                rows = np.repeat(np.arange(size), near)
            gaps = np.sqrt(((m[rows] - m[cols]) ** 2).sum(1))
            yield _edge_frame(ids, rows, cols, gaps, size * size)

    schema = "id bigint, grp string, v array<double>, tree int, code bigint"
    order = ["grp", "tree", "code", "id"]
    dealt = points.mapInPandas(code, schema).repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInPandas(link, EDGES)


def _local_joins(points: DataFrame, links: DataFrame, width: int, turn: int) -> DataFrame:
    """Better edges among the rows linked with a middle row, in either direction.

    The rows around a popular middle are dealt by hash into chunks of about twice the width, other
    ones each round, so a hub is no large group and loses no link.
    """
    around = (
        links.select(F.col("id").alias("mid"), F.col("neighbor").alias("id"))
        .unionByName(links.select(F.col("neighbor").alias("mid"), "id"))
        .distinct()
    )
    sizes = around.groupBy("mid").agg(F.ceil(F.count("*") / (2 * width)).alias("chunks"))
    dealt = around.join(sizes, "mid").select(
        "mid", "id", (hash_int(F.lit(str(turn)), "id") % F.col("chunks")).alias("chunk")
    )
    bounds = links.groupBy("id").agg(
        F.when(F.count("*") >= width, F.max("distance")).otherwise(F.lit(float("inf"))).alias("bound")
    )
    known = points.select("id", "v").join(bounds, "id", "left")

    def compare(batches):
        for pdf, vectors, start, end in _runs(batches, ["mid", "chunk"]):
            ids, m = pdf["id"].to_numpy()[start:end], vectors[start:end]
            bound = pdf["bound"].fillna(np.inf).to_numpy()[start:end]
            rough = _rough(m)
            slack = 1e-9 * (1.0 + (m**2).sum(1).max())
            rows, cols = np.nonzero(rough < (bound**2)[:, None] + slack)
            off = rows != cols
            rows, cols = rows[off], cols[off]
            gaps = np.sqrt(((m[rows] - m[cols]) ** 2).sum(1))
            better = gaps < bound[rows]
            yield _edge_frame(ids, rows[better], cols[better], gaps[better], (end - start) ** 2)

    return (
        dealt.join(known, "id")
        .repartition("mid", "chunk")
        .sortWithinPartitions("mid", "chunk", "id")
        .mapInPandas(compare, EDGES)
    )
