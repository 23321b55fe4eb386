"""SimHash near-duplicates with pivot distance tables.

A fingerprint bit is the majority of the XXH64 bits of a text's word shingles. The 64 bits form
three blocks; fingerprints at two or fewer differing bits agree in one block at least. For every
block, the Hamming distances to ``PIVOTS`` reference patterns are computed once: equal blocks
have equal distances, so the rounded-down table of one block is the key under which linked
fingerprints meet. Inside a key, a pair is dropped when any of the distances to all references
differs by more than the allowed bits (triangle inequality); survivors are verified.

Equal fingerprints are one node, so copies never form pairs. Keys with more than ``HOT`` nodes
take an exact way without pairs: two fingerprints at most two bits apart share a fingerprint
within one bit of both, so every node is posted under itself and its 64 single-bit neighbours;
such a posting holds at most 65 nodes, all linked to each other.

Cases: a null, empty or wordless text has fingerprint zero, linked like any other; one or two
words are one shingle; a row with a null id links others but has no component id itself; repeated
rows share a component; an empty table gives no rows; other columns are not read. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanewatch.llm.common import bounded_groups, components, sized, spread, stored, text_bytes
from wanewatch.llm.words import words_of

BLOCKS = [(0, 22), (22, 43), (43, 64)]
PIVOTS = 24  # references per block
BITS_APART = 2
HOT = 256  # nodes of a key beyond which no pairs are looked at
BATCH_BYTES = 500_000
SLICE = 65_536  # shingles whose bits are counted at once


def fingerprints(texts: list[bytes], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """64-bit fingerprints of lower-cased texts."""
    w = words_of([t.lower() for t in texts], codes=False)
    count = w.count()
    out = np.zeros(len(texts), np.uint64)
    if not len(w.begin):
        return out
    # words joined by one space each
    width = w.end - w.begin
    new_end = np.cumsum(width + 1) - 1
    new_begin = new_end - width
    keep = np.zeros(len(w.data), bool)
    edge = np.zeros(len(w.data) + 1, np.int8)
    edge[w.begin], edge[w.end] = 1, -1
    keep = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    keep[w.end[w.end < len(keep)]] = True
    packed = w.data[keep].copy()
    packed[new_end[new_end < len(packed)]] = 32
    packed = packed.tobytes()
    last = np.cumsum(count)
    first = last - count
    n = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    size = np.minimum(count, shingle)
    doc = np.repeat(np.arange(len(texts)), n)
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    digest, ones = xxhash.xxh64_intdigest, np.zeros((len(texts), 64), np.int64)
    for k in range(0, len(at), SLICE):
        some, mine = at[k : k + SLICE], doc[k : k + SLICE]
        hashes = [
            digest(packed[a:b], seed)
            for a, b in zip(new_begin[some].tolist(), new_end[some + size[mine] - 1].tolist(), strict=True)
        ]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edge = np.flatnonzero(np.diff(mine, prepend=-1))
        ones[mine[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    major = (2 * ones > n[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def references() -> tuple[np.ndarray, np.ndarray]:
    """(patterns, masks) of all blocks: random fingerprints cut to their block."""
    masks = [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in BLOCKS]
    rng = np.random.default_rng(64)
    made = rng.integers(0, 2**64, (len(BLOCKS), PIVOTS), dtype=np.uint64)
    mask = np.repeat(np.array(masks, np.uint64), PIVOTS)
    return made.ravel() & mask, mask


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """(fingerprint, reference) Hamming distances inside the reference's block."""
    pattern, mask = references()
    return np.bitwise_count((prints[:, None] & mask) ^ pattern).astype(np.int8)


def block_keys(prints: np.ndarray) -> np.ndarray:
    """(fingerprint, block) keys: the block's distances read as digits."""
    table = pivot_table(prints).astype(np.uint64).reshape(len(prints), len(BLOCKS), PIVOTS)
    key = np.zeros((len(prints), len(BLOCKS)), np.uint64)
    for j in range(PIVOTS):
        key = key * np.uint64(0x9E3779B97F4A7C15) + table[:, :, j]
    return key.view(np.int64)


def linked(prints: np.ndarray, apart: int = BITS_APART) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the links between up to HOT fingerprints (index pairs)."""
    n, table = len(prints), pivot_table(prints)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found = []
    for i in range(n - 1):
        close = i + 1 + np.flatnonzero((np.abs(table[i + 1 :] - table[i]) <= apart).all(1))
        for j in close[np.bitwise_count(prints[close] ^ prints[i]) <= apart].tolist():
            if (a := find(i)) != (b := find(j)):
                root[b] = a
                found.append((i, j))
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def text_tag(text: str):
    """64-bit hash of a text; null is empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def with_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, tag, print) of every row; the fingerprint is a signed 64-bit integer."""
    source = spread(df).select(F.col(doc_id).alias("doc_id"), text_tag(text).alias("tag"), F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_bytes(t) for t in batch["text"].tolist()]
            for a, b in bounded_groups([len(t) for t in texts], BATCH_BYTES):
                out = batch.iloc[a:b][["doc_id", "tag"]].copy()
                out["print"] = fingerprints(texts[a:b], shingle).view(np.int64)
                yield out

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInPandas(run, f"doc_id {kind}, tag long, print long")


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints at two or fewer bits.

    ``nodes`` has (print, node), a fingerprint once.
    """

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = block_keys(batch["print"].to_numpy(np.int64).view(np.uint64))
            for k in range(len(BLOCKS)):
                yield pd.DataFrame(
                    {"block": k, "key": keys[:, k], "print": batch["print"], "node": batch["node"]}
                )

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group in batch["members"]:
                prints = np.array([m["print"] for m in group], np.int64).view(np.uint64)
                node = np.array([m["node"] for m in group], np.int64)
                i, j = linked(prints)
                if len(i):
                    yield pd.DataFrame({"a": node[i], "b": node[j]})

    posts = nodes.mapInPandas(post, "block int, key long, print long, node long")
    sizes = posts.groupBy("block", "key").agg(F.count("*").alias("n")).filter("n > 1")
    posts = stored(posts.join(sizes, ["block", "key"]), "simhash-posts")
    # pair tests cost far more than their rows weigh: the count keeps them on all cores
    parts = max(nodes.sparkSession.sparkContext.defaultParallelism, nodes.rdd.getNumPartitions())
    member = F.struct("print", "node")
    small = (
        posts.filter(F.col("n") <= HOT).repartition(parts, "block", "key").groupBy("block", "key")
        .agg(F.collect_list(member).alias("members")).select("members")
        .mapInPandas(pairs, "a long, b long")
    )
    around = F.array(F.col("print"), *[F.col("print").bitwiseXOR(F.lit((1 << k) if k < 63 else -(1 << 63))) for k in range(64)])
    hot = posts.filter(F.col("n") > HOT).select("print", "node").distinct()
    stars = (
        hot.select("node", F.explode(around).alias("middle")).groupBy("middle")
        .agg(F.min("node").alias("a"), F.collect_list("node").alias("all")).filter(F.size("all") > 1)
        .select("a", F.explode("all").alias("b")).filter("a < b").distinct()
    )
    return small.union(stars)


def grouped(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, tag, print, component_id) of every row; the component's smallest id names it.

    Nodes are numbered by fingerprint: an id on several texts links none of them.
    """
    prints = stored(with_fingerprints(df, doc_id, text, shingle), "simhash-prints")
    nodes = stored(
        prints.groupBy("print").agg(F.min("doc_id").cast("long").alias("least"))
        .withColumn("node", F.col("print")),
        "simhash-nodes",
    )
    groups = components(links(nodes))
    placed = nodes.join(groups, "node", "left").select("print", "least", F.col("component"))
    names = placed.filter("component is not null").groupBy("component").agg(F.min("least").alias("name"))
    named = placed.join(names, "component", "left").select(
        "print", F.coalesce("name", "least").alias("component_id")
    )
    return prints.join(named, "print", "left").select(
        "doc_id", "tag", "print", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, print, component_id) of every row; the component's smallest id names it."""
    return grouped(df, doc_id, text, shingle).select("doc_id", "print", "component_id")


def one_per_group(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` that stay: the smallest id of every component, once; null ids stay."""
    gone = grouped(df, doc_id, text).filter(F.col("doc_id") != F.col("component_id"))
    rows = stored(gone.select(F.col("doc_id").alias("__gone"), F.col("tag").alias("__tag")).distinct(), "simhash-gone")
    same = (F.col(doc_id) == F.col("__gone")) & (text_tag(text) == F.col("__tag"))
    rest = df.join(sized(rows, F.lit(24)), same, "left_anti")
    # an id that repeats keeps its smallest text, of equal ones the smallest row hash
    again = rest.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__again"))
    again = again.agg(F.count("*").alias("__n")).filter("__n > 1").select("__again")
    if again.isEmpty():
        return rest
    same = F.col(doc_id) == F.col("__again")
    plain = [f.name for f in rest.schema if not isinstance(f.dataType, T.MapType)]
    order = F.struct(F.col(text), F.xxhash64(*plain))
    chosen = rest.join(again, same, "left_semi").groupBy(doc_id)
    chosen = chosen.agg(F.min_by(F.struct(*rest.columns), order).alias("__row")).select("__row.*")
    return rest.join(again, same, "left_anti").union(chosen)
