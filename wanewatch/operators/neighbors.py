"""Exact k nearest neighbours, and an approximate form over hashing.

Points are put into the cell of their nearest pivot, and whole cells are dealt into chunks; a cell
larger than a chunk is cut by key hash. A task compares the rows of one chunk: block by block
first, which bounds how far the k-th neighbour can be, then with the parts of the other cells that
can beat that bound. Then chunks meet in pairs, where a bound still asks for it, and each pair
once for both directions. The number of chunks is fixed until a chunk reaches ``CHUNK_BYTES``, so what
is shuffled grows with the rows; beyond that, with the pairs of full chunks. Distances live in numpy
inside a task; no pair of rows is ever emitted beyond the k best of a chunk.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.functions.scalars import hash_int
from wanewatch.session import cut_lineage, lookup_join

BLOCK_ROWS = 2_048
MAX_PIVOTS = 256
CHUNKS = 12  # chunks a table is dealt into, as long as they are no larger than CHUNK_BYTES
CHUNK_BYTES = 32 * 2**20
TILE, SLICE = 256, 4_096  # rows and points of one matrix product
SHORTLIST = 32_768  # distances worked out together
UNIT = {np.float32: 2.0**-24, np.float64: 2.0**-53}


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy()


def _matrix(rows: pa.Table, name: str) -> np.ndarray:
    """Lists of equal length as a matrix."""
    lists = rows.column(name).combine_chunks()
    if not len(lists):
        return np.zeros((0, 0))
    lengths = np.unique(lists.value_lengths().to_numpy(zero_copy_only=False))
    if len(lengths) > 1:
        raise ValueError("vectors differ in length")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


class _Points:
    """Vectors to be searched in: matrices whose product with a row gives q.s - |s|^2 / 2."""

    def __init__(self, m: np.ndarray, ids: np.ndarray):
        self.m, self.ids = m, ids
        norms = (m**2).sum(1)
        self.largest = float(norms[np.isfinite(norms)].max(initial=0.0))
        self.wide = {np.float64: np.concatenate([m, -norms[:, None] / 2], axis=1).T.copy()}
        if self.largest < 1e30:
            self.wide[np.float32] = self.wide[np.float64].astype(np.float32)


def _merge(one, other, ids, k):
    """(row, column, distance) of the k nearest of every row, ties by id; a pair counts once."""
    rows, cols, gaps = (np.concatenate(pair) for pair in zip(one, other, strict=True))
    order = np.lexsort((cols, ids[cols], gaps, rows))
    rows, cols, gaps = rows[order], cols[order], gaps[order]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (cols[1:] != cols[:-1])
    rows, cols, gaps = rows[fresh], cols[fresh], gaps[fresh]
    kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[kept], cols[kept], gaps[kept]


def _none():
    return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)


def _farthest(best, bound, k):
    """Distance beyond which a point is none of a row's k nearest."""
    rows, _, gaps = best
    last = np.full(len(bound), np.inf)
    full = np.bincount(rows, minlength=len(bound)) >= k
    worst = np.zeros(len(bound))
    np.maximum.at(worst, rows, gaps)
    last[full] = worst[full]
    return np.minimum(last, bound)


def _scan(q, q_ids, points: _Points, spans, k, bound, best=None, codes=None):
    """The k nearest of a few rows among spans of points, none farther than ``bound``.

    A product in single precision shortlists, where its error is small beside the bound; else double.
    The shortlist's distances are taken from plain differences, so equal distances compare equal.
    Pairs that agree in one of the ``codes`` of rows and points, columns of integers, are left out.
    """
    best = _none() if best is None else best
    norms = (q**2).sum(1)
    near = _farthest(best, bound, k)
    row = np.concatenate([q, np.ones((len(q), 1))], axis=1)
    slack = {t: 2 * (q.shape[1] + 8) * u * (norms + points.largest) for t, u in UNIT.items()}
    small = np.float32 in points.wide and norms.max(initial=0.0) < 1e30
    for start, end in spans:
        for a in range(start, end, SLICE):
            b = min(a + SLICE, end)
            kind = np.float32 if small and (slack[np.float32] <= 0.05 * near**2).all() else np.float64
            with np.errstate(invalid="ignore", over="ignore"):
                alike = row.astype(kind, copy=False) @ points.wide[kind][:, a:b]
                spare = slack[kind] + 1e-9 * (1.0 + norms + points.largest)
                floor = _below((norms - near**2 - spare) / 2, kind)
                hits = np.flatnonzero(alike >= floor)
                if len(hits) > 4 * k * len(q) and b - a > k:
                    bad = np.isnan(alike) | (q_ids[:, None] == points.ids[None, a:b])
                    for one, other in zip(*(c.T for c in codes), strict=True) if codes else ():
                        bad |= one[:, None] == other[None, a:b]
                    alike[bad] = -np.inf
                    edge = np.partition(alike, b - a - k, axis=1)[:, b - a - k].astype(float) - spare
                    hits = np.flatnonzero(alike >= np.maximum(floor, _below(edge, kind)))
            rows, cols = hits // (b - a), hits % (b - a) + a
            keep = q_ids[rows] != points.ids[cols]
            if codes:
                keep &= ~(codes[0][rows] == codes[1][cols]).any(1)
            rows, cols = rows[keep], cols[keep]
            for i in range(0, len(rows), SHORTLIST):
                r, c = rows[i : i + SHORTLIST], cols[i : i + SHORTLIST]
                gaps = np.sqrt(((q[r] - points.m[c]) ** 2).sum(1))
                close = gaps <= near[r]
                if close.any():
                    best = _merge(best, (r[close], c[close], gaps[close]), points.ids, k)
                    near = _farthest(best, bound, k)
    return best


def _below(values: np.ndarray, kind) -> np.ndarray:
    """A column of the numbers next below, so that rounding to ``kind`` raises none."""
    return np.nextafter(values.astype(kind), kind(-np.inf))[:, None]


def _pivot_distances(m, pivots):
    return np.stack([np.sqrt(((m - p) ** 2).sum(1)) for p in pivots], axis=1)


def nearest(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 5,
    *,
    group: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, neighbor, rank, distance): the k nearest other rows of each row.

    With ``group``, neighbours come from the row's own group only. Keys are unique bigints; rows
    without a key, vector or group take no part.
    Of equal vectors only the k + 1 lowest ids can be anyone's neighbours, as ties go by id:
    the search runs on those, and the copies beyond them get their answer without a search.
    """
    points = df.select(
        F.col(key).cast("bigint").alias("id"),
        (F.col(group).cast("string") if group else F.lit("all")).alias("grp"),
        F.col(vector).cast("array<double>").alias("v"),
    ).where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.col("grp").isNotNull())
    same = Window.partitionBy("grp", "v").orderBy("id")
    kept = (
        points.withColumn("place", F.row_number().over(same))
        .where(F.col("place") <= k + 1)
        .drop("place")
        .persist()
    )
    return _search(kept, k, block_rows).unionByName(_beyond(points, kept, k))


def _beyond(points: DataFrame, kept: DataFrame, k: int) -> DataFrame:
    """Neighbours of the copies that were set aside: the k lowest ids of their own vector."""
    crowds = (
        kept.groupBy("grp", "v")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .where(F.size("ids") > k)
    )
    return (
        lookup_join(points, crowds, ["grp", "v"])
        .where(F.col("id") > F.get("ids", F.lit(k)))
        .select("id", F.posexplode(F.slice("ids", 1, k)).alias("at", "neighbor"))
        .select("id", "neighbor", (F.col("at") + 1).alias("rank"), F.lit(0.0).alias("distance"))
    )


def _search(points: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Chunk search over (id, grp, v) rows."""
    total = points.count()
    n_pivots = int(min(MAX_PIVOTS, max(1, math.isqrt(max(total // block_rows, 1)) * 4)))
    if total <= block_rows:
        n_pivots = 1
    drawn = points.orderBy(hash_int("id"), "id").limit(n_pivots).collect()
    pivots = np.array([r["v"] for r in drawn], dtype=float).reshape(len(drawn), len(drawn[0]["v"]) if drawn else 1)
    finite = np.isfinite(pivots).all(1)
    pivots = pivots[finite] if finite.any() else np.zeros((1, pivots.shape[1]))

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(pa.Table.from_batches([batch]), "v")
            away = _pivot_distances(m, pivots)
            cell = np.where(np.isnan(away), np.inf, away).argmin(1)
            out = batch.append_column("cell", pa.array(cell.astype(np.int32)))
            yield out.append_column("away", pa.array(away[np.arange(len(m)), cell]))

    placed = points.mapInArrow(place, "id bigint, grp string, v array<double>, cell int, away double").persist()
    seen = F.when(~F.isnan("away"), F.col("away"))
    ranges = (
        placed.groupBy("grp", "cell")
        .agg(F.count("*").alias("n"), F.min(seen).alias("near"), F.max(seen).alias("far"))
        .collect()
    )
    most = max(block_rows, min(CHUNK_BYTES // (8 * max(pivots.shape[1], 1)), math.ceil(total / CHUNKS)))
    cells = _dealt(ranges, pivots, most)
    deal = points.sparkSession.createDataFrame(
        [(g, c, first, parts) for g, rows in cells.items() for c, first, parts, _, _ in rows],
        "grp string, cell int, first int, parts int",
    )
    chunked = placed.join(F.broadcast(deal), ["grp", "cell"]).select(
        "id", "grp", "v", "cell", "away", (F.col("first") + hash_int("id") % F.col("parts")).cast("int").alias("chunk")
    )

    def within(rows: pa.Table) -> pa.Table:
        cell, away, ids = (_column(rows, c) for c in ("cell", "away", "id"))
        order = np.lexsort((ids, away, cell))
        cell, away, ids, m = cell[order], away[order], ids[order], _matrix(rows, "v")[order]
        grp, chunk = rows.column("grp")[0].as_py(), rows.column("chunk")[0].as_py()
        held = _Points(m, ids)
        found = [_none()]
        for a in range(0, len(m), block_rows):
            b = min(a + block_rows, len(m))
            for t in range(a, b, TILE):
                part = slice(t, min(t + TILE, b))
                best = _scan(m[part], ids[part], held, [(a, b)], k, np.full(part.stop - t, np.inf))
                found.append((best[0] + t, *best[1:]))
        best = tuple(np.concatenate(c) for c in zip(*found, strict=True))
        if len(m) > block_rows:
            best = _tiles(m, ids, cell, away, held, cell, away, pivots, k, np.full(len(m), np.inf), best)
        near = _farthest(best, np.full(len(m), np.inf), k)
        rows_of, cols, gaps = best
        ends = np.searchsorted(rows_of, np.arange(len(m) + 1)).astype(np.int32)
        reach, sizes = _reach(m, near, cells[grp], chunk, pivots)
        many = len(m)
        return pa.table(
            {
                "id": ids,
                "grp": pa.array([grp] * many, pa.string()),
                "chunk": np.full(many, chunk, np.int32),
                "v": _lists(m),
                "cell": cell,
                "away": away,
                "near": near,
                "reach": pa.ListArray.from_arrays(sizes, pa.array(reach, pa.int32())),
                "found": pa.ListArray.from_arrays(ends, pa.array(ids[cols], pa.int64())),
                "gaps": pa.ListArray.from_arrays(ends, pa.array(gaps, pa.float64())),
            }
        )

    local = chunked.groupBy("grp", "chunk").applyInArrow(
        within,
        "id bigint, grp string, chunk int, v array<double>, cell int, away double, near double, "
        "reach array<int>, found array<bigint>, gaps array<double>",
    )
    several = any(first + parts > 1 for rows in cells.values() for _, first, parts, _, _ in rows)
    if several:
        local = cut_lineage(local)
        placed.unpersist()
    candidates = local.select(
        "id", F.inline(F.arrays_zip(F.col("found").alias("neighbor"), F.col("gaps").alias("distance")))
    )
    if several:
        candidates = candidates.unionByName(_across(local, pivots, k))
    return _ranked(candidates, k)


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("id").orderBy("distance", "neighbor")
    return (
        candidates.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("id", "neighbor", "rank", "distance")
    )


def _dealt(ranges, pivots, most: int) -> dict[str, list[tuple[int, int, int, float, float]]]:
    """(cell, first chunk, chunks, nearest, farthest) of every group's cells.

    Cells are taken in the order of their pivots' distance from the first one and share a chunk as
    long as it has at most ``most`` rows; a larger cell has chunks of its own.
    """
    turn = np.argsort(_pivot_distances(pivots, pivots[:1])[:, 0], kind="stable").argsort()
    cells: dict[str, list[tuple[int, int, int, float, float]]] = {}
    filled: dict[str, tuple[int, int]] = {}
    for r in sorted(ranges, key=lambda r: (r["grp"], turn[r["cell"]])):
        chunk, rows = filled.get(r["grp"], (0, 0))
        parts = math.ceil(r["n"] / most)
        if rows and rows + r["n"] > most:
            chunk, rows = chunk + 1, 0
        cells.setdefault(r["grp"], []).append((r["cell"], chunk, parts, r["near"], r["far"]))
        filled[r["grp"]] = (chunk, rows + r["n"]) if parts == 1 else (chunk + parts, 0)
    return cells


def _lists(m: np.ndarray) -> pa.Array:
    ends = np.arange(0, m.size + 1, max(m.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(m.ravel()))


def _reach(m, near, cells, chunk, pivots):
    """Chunks other than its own with cells a row's bound cannot rule out, and where they end."""
    cell = np.array([c for c, _, _, _, _ in cells])
    low, high = (np.array([c[i] for c in cells], dtype=float) for i in (3, 4))
    chunks = 1 + max(first + parts - 1 for _, first, parts, _, _ in cells)
    holds = np.zeros((len(cells), chunks), dtype=bool)
    for i, (_, first, parts, _, _) in enumerate(cells):
        holds[i, first : first + parts] = True
    found, sizes = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for a in range(0, len(m) if chunks > 1 else 0, TILE):
        away = _pivot_distances(m[a : a + TILE], pivots)[:, cell]
        least = np.maximum(np.maximum(away - high, low - away), 0.0)
        wanted = (least <= near[a : a + TILE, None] + 1e-9) @ holds
        wanted[:, chunk] = False
        found.append(np.nonzero(wanted)[1])
        sizes.append(wanted.sum(1))
    if chunks == 1:
        sizes.append(np.zeros(len(m), np.int64))
    return np.concatenate(found), np.cumsum(np.concatenate(sizes)).astype(np.int32)


def _tiles(m, ids, cell, away, held: _Points, s_cell, s_away, pivots, k, near, best):
    """Rows against points, both sorted by (cell, distance from its pivot), a tile of rows at a time.

    Of each cell only the points take part whose distance from the pivot a row's bound allows.
    """
    listed, starts = np.unique(s_cell, return_index=True)
    ends = np.append(starts[1:], len(s_cell))
    found = [_none()]
    rows_of = best[0]
    for t in range(0, len(m), TILE):
        part = slice(t, min(t + TILE, len(m)))
        a, b = np.searchsorted(rows_of, [part.start, part.stop])
        mine = (best[0][a:b] - t, best[1][a:b], best[2][a:b])
        bound = near[part]
        to = _pivot_distances(m[part], pivots[listed])
        limit = _farthest(mine, bound, k)[:, None] + 1e-9
        lows, highs = (to - limit).min(0), (to + limit).max(0)
        spans = []
        for start, end, low, high in zip(starts, ends, lows, highs, strict=True):
            if not np.isnan(low):
                x = start + np.searchsorted(s_away[start:end], low, "left")
                y = start + np.searchsorted(s_away[start:end], high, "right")
                if x < y and spans and x - spans[-1][1] <= TILE:
                    spans[-1] = (spans[-1][0], y)
                elif x < y:
                    spans.append((x, y))
            else:
                spans.append((start, end))
        own = cell[t]
        spans.sort(key=lambda span: abs(int(s_cell[span[0]]) - int(own)))
        mine = _scan(m[part], ids[part], held, spans, k, bound, mine)
        found.append((mine[0] + t, *mine[1:]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


ANSWER = "id bigint, neighbor bigint, distance double"


def _answers(*parts) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["id", "neighbor", "distance"])


def _renewed(df: DataFrame) -> DataFrame:
    """The same columns under identities of their own, for a table that meets itself."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _across(local: DataFrame, pivots, k: int) -> DataFrame:
    """Candidates from the chunks each row still has to search.

    Two chunks meet once. A row goes there if it asks, or if a row of the other chunk does.
    """
    asking = (
        local.select("grp", F.col("chunk").alias("by"), F.explode("reach").alias("chunk"))
        .groupBy("grp", "chunk").agg(F.collect_set("by").alias("askers"))
    )
    empty = F.array().cast("array<int>")
    sent = (
        local.join(F.broadcast(asking), ["grp", "chunk"], "left")
        .withColumn("other", F.explode(F.array_union("reach", F.coalesce("askers", empty))))
        .select(
            "grp", "id", "v", "cell", "away", "near",
            F.array_contains("reach", F.col("other")).alias("asks"),
            F.least("chunk", "other").alias("one"),
            F.greatest("chunk", "other").alias("two"),
            (F.col("chunk") < F.col("other")).alias("first"),
        )
    )

    def side(rows: pa.Table):
        cell, away, ids = (_column(rows, c) for c in ("cell", "away", "id"))
        order = np.lexsort((ids, away, cell))
        m = _matrix(rows, "v")[order]
        return m, ids[order], cell[order], away[order], _column(rows, "near")[order], _column(rows, "asks")[order]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _answers((np.zeros(0), np.zeros(0), np.zeros(0)))
        one, two, out = side(left), side(right), []
        for (m, ids, cell, away, near, asks), (s, s_ids, s_cell, s_away, _, _) in ((one, two), (two, one)):
            if asks.any():
                held = _Points(s, s_ids)
                rows, cols, gaps = _tiles(
                    m[asks], ids[asks], cell[asks], away[asks], held, s_cell, s_away, pivots, k, near[asks], _none()
                )
                out.append((ids[asks][rows], s_ids[cols], gaps))
        return _answers(*out)

    pair = ["grp", "one", "two"]
    return (
        sent.where("first").drop("first").groupBy(*pair)
        .cogroup(_renewed(sent.where("not first").drop("first")).groupBy(*pair))
        .applyInArrow(search, ANSWER)
    )


def nearest_by_hashing(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 5,
    *,
    radius: float,
    bucket_length: float | None = None,
    tables: int = 4,
) -> DataFrame:
    """Approximate form for tables where the exact search is too dear.

    Random-projection buckets; neighbours farther than ``radius`` or never sharing a bucket
    are missed, so rows may have fewer than k neighbours. Rows meet in their buckets; a bucket is
    cut into chunks by key hash and its chunks meet in pairs, so neither a wide bucket nor the
    pairs within the radius are ever written: only the k best of a chunk pair are.
    """
    points = df.select(
        F.col(key).cast("bigint").alias("id"),
        array_to_vector(F.col(vector).cast("array<double>")).alias("features"),
    ).where(F.col("id").isNotNull() & F.col(vector).isNotNull())
    model = BucketedRandomProjectionLSH(
        inputCol="features",
        outputCol="hashes",
        bucketLength=bucket_length or radius,
        numHashTables=tables,
        seed=42,
    ).fit(points)
    hashed = model.transform(points).select(
        "id",
        vector_to_array("features").alias("v"),
        F.array(*[F.get(vector_to_array(F.col("hashes")[t]), F.lit(0)) for t in range(tables)]).alias("hashes"),
    )
    hashed = cut_lineage(hashed.distinct())
    total, width = hashed.agg(F.count("*"), F.max(F.size("v"))).first()
    most = max(BLOCK_ROWS, min(CHUNK_BYTES // (8 * (width or 1)), math.ceil(total / CHUNKS)))
    buckets = hashed.select("id", "v", "hashes", F.posexplode("hashes").alias("tab", "bucket"))
    sizes = buckets.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    chunk = (hash_int("id") % F.col("parts")).cast("int")
    sent = (
        lookup_join(buckets, sizes, ["tab", "bucket"])
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "tab", "bucket", "id", "v", "hashes",
            F.least("chunk", "other").alias("one"),
            F.greatest("chunk", "other").alias("two"),
            (F.col("chunk") <= F.col("other")).alias("first"),
        )
    )

    def best(one, two, tab):
        (m, ids, codes), (s, s_ids, s_codes) = one, two
        held, out = _Points(s, s_ids), [_none()]
        for t in range(0, len(m), TILE):
            part = m[t : t + TILE], ids[t : t + TILE]
            # a pair that has met in an earlier table does not count again
            met = (codes[t : t + TILE, :tab], s_codes[:, :tab]) if tab else None
            rows, cols, gaps = _scan(*part, held, [(0, len(s))], k, np.full(len(part[0]), radius), codes=met)
            near = gaps < radius
            out.append((part[1][rows[near]], s_ids[cols[near]], gaps[near]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        sides = [
            (_matrix(rows, "v"), _column(rows, "id"), _matrix(rows, "hashes")) if rows.num_rows else None for rows in (left, right)
        ]
        tab = (left if left.num_rows else right).column("tab")[0].as_py()
        one, two = sides
        out = [_none()]
        if one is not None and two is not None:
            out += [best(one, two, tab), best(two, one, tab)]
        elif one is not None and left.column("one")[0].as_py() == left.column("two")[0].as_py():
            out.append(best(one, one, tab))
        return _answers(*out)

    pair = ["tab", "bucket", "one", "two"]
    pairs = (
        sent.where("first").drop("first").groupBy(*pair)
        .cogroup(_renewed(sent.where("not first").drop("first")).groupBy(*pair))
        .applyInArrow(search, ANSWER)
    )
    return _ranked(pairs, k)
