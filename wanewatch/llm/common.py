"""Helpers shared by the operators: worker caches, text access, prefix sums, components."""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wanewatch.session import cut_lineage, fresh_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, floor: int = 1) -> DataFrame:
    """Deal rows out again when a small input has fewer partitions than the cluster has cores."""
    have, want = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if floor <= have < want else df


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, row_bytes, most: int = 24 << 20) -> DataFrame:
    """``df`` marked for broadcast if the sum of ``row_bytes`` over its rows is at most ``most``."""
    total = df.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= most else df


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process, across tasks."""
    module = sys.modules.setdefault("wanewatch_worker", types.ModuleType("wanewatch_worker"))
    return module.__dict__.setdefault("cache", {})


def kept(key, make: Callable):
    """``make()`` once per worker process."""
    cache = worker_cache()
    if key not in cache:
        cache[key] = make()
    return cache[key]


def text_bytes(value) -> bytes:
    """UTF-8 bytes of a text; null is empty."""
    return value.encode("utf-8") if isinstance(value, str) else b""


def text_list(column: pd.Series) -> list[str]:
    """Texts of a pandas column; null is empty."""
    return [v if isinstance(v, str) else "" for v in column.tolist()]


def id_crc32(value) -> int:
    """crc32 of an integer id as decimal text; a null id counts as empty text."""
    return zlib.crc32(b"" if value is None else str(value).encode())


def crc_mod(column: Column, mod: int) -> Column:
    """``crc32(id as text) mod n`` as a column; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % mod


def bounded_groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to at most ``most`` (or hold one item)."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def prefix_sums(df: DataFrame, by: list[str], order: str, value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` along the integer ``order`` within ``by``.

    One row per (by, order) is expected. Two levels: runs of 1024 consecutive orders are
    summed first, so no window sees more than the number of runs or 1024 rows.
    """
    run = f"__{out}_run"
    rows = df.withColumn(run, F.floor(F.col(order) / 1024))
    keys = [F.col(c) for c in by]
    level = Window.partitionBy(*keys).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        rows.groupBy(*by, run)
        .agg(F.sum(value).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(level), F.lit(0)))
        .drop("__n")
    )
    inside = (
        Window.partitionBy(*keys, run).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    match = [rows[c].eqNullSafe(runs[c]) for c in [*by, run]]
    joined = rows.join(runs, match, "inner")
    return joined.select(*[rows[c] for c in df.columns], (F.col("__in") + F.col("__before")).alias(out))


def components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """(node, component) of undirected integer edges (a, b); component is the smallest node.

    Each round hangs every node below the smallest node of its neighbourhood (once for larger
    neighbours, once for smaller ones), until nothing moves. Edge lists only shrink to stars.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    stars = cut(pairs.filter("a < b").distinct())
    mark = None
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.filter("b > a").join(low, "a").select(F.col("low").alias("a"), "b")
            .filter("a < b").distinct()
        )
        # every larger node with its smaller neighbours: b -> a
        low = large.groupBy("b").agg(F.min("a").alias("low"))
        joined = large.join(low, "b")
        small = joined.select(F.col("low").alias("a"), "b").union(
            joined.select(F.col("low").alias("a"), F.col("a").alias("b"))
        )
        stars = cut(small.filter("a < b").distinct())
        now = stars.agg(
            F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)),
            F.coalesce(F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31))), F.lit(0)),
        ).first()
        if mark == now:
            break
        mark = now
    nodes = stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.union(stars.select(F.col("a"), F.col("a")).distinct())
