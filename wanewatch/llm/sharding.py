"""Sharding by proportional stratified interleaving.

Rows of every source are ranked in a seeded shuffle; (rank + 1/2) / rows of the source is a row's
fractional rank. Sorted by it, any stretch of rows holds the sources in the mixture's
proportions; cut into equal stretches, every shard does, and counts differ by one at most.

Both rankings are counted, not gathered: rows fall into about sqrt(n) cells of the shuffle key
(per source) or of the fractional rank, cell counts are summed up, and a window ranks rows only
inside a cell. No window sees a whole source, however many rows it has.

Cases: a null text has no bytes (size 16); a null source is a source; rows that agree in every
column read are interchangeable; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanewatch.llm.common import prefix_sums, spread, stored

UNIT = 1 << 53
ROW_BYTES = 16  # added to the text's bytes


def interleave(
    df: DataFrame,
    shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 1,
) -> DataFrame:
    """(doc_id, source, size, text_crc32, fraction, position, shard, slot)."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = spread(df).select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source))).alias("stratum"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    rows = stored(
        rows.withColumn("key", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11)), "shard-rows"
    )
    total = rows.count()
    cells = max(1, math.isqrt(total))

    def cell(share):
        return F.least(F.floor(share * cells), F.lit(cells - 1)).cast("long")

    rows = rows.withColumn("cell", cell(F.col("key") / F.lit(UNIT)))
    counts = rows.groupBy("stratum", "cell").agg(F.count("*").alias("n"))
    sums = counts.groupBy("stratum").agg(F.sum("n").alias("of"))
    counts = prefix_sums(counts, ["stratum"], "cell", "n", "base").join(sums, "stratum")
    inside = Window.partitionBy("stratum", "cell").orderBy("key", "doc_id", "text_crc32", "size")
    ranked = (
        rows.withColumn("row", F.row_number().over(inside))
        .join(counts.select("stratum", "cell", "base", "of"), ["stratum", "cell"])
        .withColumn("rank", F.col("base") + F.col("row") - 1)
        .withColumn("fraction", (F.col("rank") + 0.5) / F.col("of"))
        .select("doc_id", "source", "stratum", "size", "text_crc32", "rank", "fraction")
        .withColumn("cell", cell(F.col("fraction")))
    )
    counts = ranked.groupBy("cell").agg(F.count("*").alias("n"))
    counts = prefix_sums(counts, [], "cell", "n", "base").select("cell", "base")
    inside = Window.partitionBy("cell").orderBy("fraction", "stratum", "rank")
    placed = (
        ranked.withColumn("row", F.row_number().over(inside))
        .join(counts, "cell")
        .withColumn("position", F.col("base") + F.col("row") - 1)
    )
    many, n = F.lit(shards).cast("long"), F.lit(max(total, 1)).cast("long")
    shard = F.expr(f"(position * {shards}L) div {max(total, 1)}L")
    return (
        placed.withColumn("shard", shard)
        # the first position of shard s is ceil(s * n / shards)
        .withColumn("slot", F.col("position") - F.floor((F.col("shard") * n + many - 1) / many))
        .select(
            "doc_id", "source", "size", "text_crc32", "fraction", "position",
            F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        )
    )
