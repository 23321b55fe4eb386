"""Repeated word spans by De Bruijn compaction.

Windows of ``SPAN`` words are the edges of a De Bruijn graph (their first and last words but one
are its nodes). A word goes if an edge covers it that also starts earlier in the order of
(doc_id, start). Edges are never shipped one by one:

1. The ``KMER``-word piece with the smallest hash of a window is its minimiser. Neighbouring
   windows with the same one form a run, about one run for eight words. Equal windows have equal
   minimisers, so only runs whose minimiser occurs again can hold a repeated edge.
2. Those runs travel to the bucket of their minimiser with the 128-bit hashes of their windows.
   There every repeated edge gets its source, the first place where it starts. Edges of a run
   whose sources follow each other are one piece of a nonbranching path: no second way leads in
   or out between them.
3. A join on (document, source, position) hangs every piece to the piece before it, across
   buckets; a path is what hangs together. Its source coordinates verify it as one span: piece by
   piece, both places have moved on by the same number of words.

Buckets with more than ``HOT`` runs are not gathered: of equal runs only the first is kept (the
others start later, all of them), and the windows of those are counted by hash with partial
aggregation. Whole-text copies are settled before by 128-bit hash. Texts are dealt out once, into
a table bucketed by document number, and stay where they are when marks are joined to them.

Cases: a null or empty text has no words; texts below ``SPAN`` words lose none; rows with the same
id and text are one document and judged alike; a null id comes first in the order; of two texts
under one id the earlier start counts as earlier; an empty table gives no rows. Ids are integers.
Output: the ``keep`` columns, ``kept`` (words joined by one space), ``n_words``, ``n_removed`` and
``spans`` (first and last word but one of every removed run); ``keep`` columns are renamed
inside, so other columns cannot clash as long as ``keep`` has none of these four names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanewatch.llm.common import bounded_groups, sized, spread, stored, text_bytes
from wanewatch.llm.suffix_dedup import FIRST, _slide, _whole, merge_runs
from wanewatch.llm.words import Words, words_of
from wanewatch.session import fresh_path

SPAN, KMER = 20, 6
HOT = 1_000  # runs of a minimiser beyond which its bucket is not gathered
BATCH_BYTES = 1_000_000
BUCKET_RUNS = 50_000  # runs settled at once
TOGETHER = 200_000  # runs of a minimiser that are looked at together before it counts as hot
LONG_WORD = 512
SALT = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
TURN = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
PLACE = "doc long, pos long, at int"
PIECE = "doc long, start int, stop int, src long, src_at int"


def joined(a: np.ndarray, b: np.ndarray, family: int) -> np.ndarray:
    """Hash of the sequence a, b."""
    x = a * SALT[family] + b
    x = (x ^ (x >> np.uint64(29))) * TURN[family]
    return x ^ (x >> np.uint64(32))


def word_hashes(w: Words, family: int) -> np.ndarray:
    """64-bit hash of every word, eight bytes at a time."""
    size = w.end - w.begin
    view = np.ndarray((len(w.raw) + 1,), "<u8", w.raw + b"\0" * 8, 0, (1,))
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    out = size.astype(np.uint64) * TURN[1 - family]
    left, at = np.arange(len(size)), w.begin
    step = 0
    while len(left):
        rest = size[left] - step
        cells = view[at[left] + step] & mask[np.minimum(rest, 8)]
        out[left] = joined(out[left], cells, family)
        step += 8
        left = left[rest > 8]
        if step >= LONG_WORD:
            for i in left.tolist():
                out[i] = xxhash.xxh3_64_intdigest(w.raw[w.begin[i] : w.end[i]], seed=family)
            break
    return out


def spans(h: np.ndarray, width: int, family: int) -> np.ndarray:
    """Hash of every ``width`` neighbours, by doubling."""
    out, done, power, size = None, 0, h, 1
    while size <= width:
        if width & size:
            if out is None:
                out, done = power, size
            else:
                n = max(min(len(out), len(power) - done), 0)
                out, done = joined(out[:n], power[done : done + n], family), done + size
        power = joined(power[: max(len(power) - size, 0)], power[size:], family)
        size *= 2
    return out


def runs_of(w: Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, minimiser) of all runs; windows are numbered by word."""
    n = len(w.begin) - SPAN + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none
    small = spans(first, KMER, 0)
    low = _slide(small, SPAN - KMER + 1, np.minimum)
    at = np.flatnonzero(w.doc[:n] == w.doc[SPAN - 1 :])
    if not len(at):
        return none, none, none, none
    # a run ends where its minimiser drops out or a smaller one comes in
    new = np.append(True, (np.diff(at) > 1) | (low[at[1:]] != low[at[:-1]]) | (small[at[:-1]] == low[at[:-1]]))
    head = np.flatnonzero(new)
    start = at[head]
    return w.doc[start], start, np.diff(np.append(head, len(at))), low[start].view(np.int64)


def settle_pieces(runs: pd.DataFrame) -> pd.DataFrame:
    """Pieces of later edges, of runs (doc, pos, at, edges) that hold all places of their edges."""
    edges = np.frombuffer(b"".join(runs["edges"].tolist()), np.uint64).reshape(-1, 2)
    row, inside = listed(runs["edges"])
    doc, pos = runs["doc"].to_numpy()[row], runs["pos"].to_numpy()[row]
    at = runs["at"].to_numpy()[row].astype(np.int64) + inside
    order = np.lexsort((doc, at, pos, edges[:, 1], edges[:, 0]))
    ranked = edges[order]
    new = np.append(True, (ranked[1:] != ranked[:-1]).any(1))
    source = np.empty(len(row), np.int64)
    source[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = (pos > pos[source]) | ((pos == pos[source]) & (at > at[source]))
    shift, src = at - at[source], doc[source]
    follows = np.append(
        False, later[:-1] & (row[1:] == row[:-1]) & (shift[1:] == shift[:-1]) & (src[1:] == src[:-1])
    )
    head = np.flatnonzero(later & ~follows)
    total = np.append(0, np.cumsum(later))
    # a piece's edges are neighbours: between two heads only its own edges are later ones
    count = np.diff(np.append(total[head], total[-1]))
    return pd.DataFrame({"doc": doc[head], "start": at[head], "stop": at[head] + count, "src": src[head], "src_at": at[source[head]]})


def listed(edges: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(run, place in the run) of every edge."""
    size = edges.map(len).to_numpy() // 16
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)


def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of a partition that has all runs of its minimisers."""
    rows = _whole(batches)
    if not len(rows):
        return
    rows = rows.sort_values("key", kind="stable").reset_index(drop=True)
    edge = np.flatnonzero(np.diff(rows["key"].to_numpy(), prepend=np.nan, append=np.nan) != 0)
    for x, y in bounded_groups(np.diff(edge).tolist(), BUCKET_RUNS):
        yield settle_pieces(rows.iloc[edge[x] : edge[y]])


def hot_pieces(rows: DataFrame) -> DataFrame:
    """Pieces of runs (doc, pos, at, edges) whose minimisers very many runs share."""
    half = F.conv(F.substring(F.sha2("edges", 256), 1, 15), 16, 10).cast("long")
    rows = rows.select("doc", "pos", "at", "edges", F.xxhash64("edges").alias("c1"), half.alias("c2"))
    first = stored(
        rows.groupBy("c1", "c2").agg(F.min(F.struct("pos", "at", "doc")).alias("f"), F.first("edges").alias("edges"))
        .select("c1", "c2", "f.*", "edges"),
        "debruijn-first",
    )
    source = [F.col("doc").alias("src"), F.col("pos").alias("src_pos"), F.col("at").alias("src_at")]
    later = (F.col("pos") > F.col("src_pos")) | ((F.col("pos") == F.col("src_pos")) & (F.col("at") > F.col("src_at")))
    columns = ["doc", F.col("at").alias("start"), "stop", "src", "src_at"]
    copies = rows.join(first.select("c1", "c2", *source), ["c1", "c2"]).filter(later)
    copies = copies.withColumn("stop", (F.col("at") + F.length("edges") / 16).cast("int"))

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            edges = np.frombuffer(b"".join(batch["edges"].tolist()), np.int64).reshape(-1, 2)
            row, inside = listed(batch["edges"])
            rest = batch[["doc", "pos", "at"]].iloc[row]
            yield rest.assign(at=rest["at"] + inside, w1=edges[:, 0], w2=edges[:, 1])

    alone = first.select("doc", "pos", "at", "edges").mapInPandas(single, f"w1 long, w2 long, {PLACE}")
    firsts = alone.groupBy("w1", "w2").agg(F.min(F.struct("pos", "at", "doc")).alias("f"), F.count("*").alias("n"))
    firsts = firsts.filter("n > 1").select("w1", "w2", "f.*").select("w1", "w2", *source)
    found = alone.join(firsts, ["w1", "w2"]).filter(later).withColumn("stop", (F.col("at") + 1).cast("int"))
    return copies.select(*columns).union(found.select(*columns))


def paths(pieces: DataFrame) -> DataFrame:
    """Pieces that hang together, as one row each: (doc, start, stop) and the path's source."""
    walk = ["doc", "src", "shift"]
    pieces = stored(pieces.withColumn("shift", F.col("start") - F.col("src_at")).drop("src_at"), "debruijn-pieces")
    before = pieces.select(*walk, F.col("stop").alias("start"), F.lit(1).alias("hangs"))
    linked = pieces.join(before, [*walk, "start"], "left").withColumn("head", F.col("hangs").isNull().cast("int"))
    along = Window.partitionBy("doc").orderBy("start")  # the pieces of one document
    linked = linked.withColumn("path", F.sum("head").over(along))
    return linked.groupBy("doc", "path").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.first("src").alias("src"), F.first("shift").alias("shift")
    )


def recurring(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of minimisers that a partition (all runs of its minimisers) has more than once."""
    rows = _whole(batches)
    if len(rows):
        _, which, count = np.unique(rows["key"].to_numpy(), return_inverse=True, return_counts=True)
        rows["hot"] = count[which] > HOT
        rows = rows[count[which] > 1]
        for a in range(0, len(rows), 100_000):
            yield rows.iloc[a : a + 100_000][["doc", "at", "hot"]]


def repeated_paths(docs: DataFrame) -> DataFrame:
    """Later occurrences of repeated paths in documents (doc, pos, text) without copies."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, docs = [text_bytes(t) for t in batch["text"].tolist()], batch["doc"].to_numpy()
            for a, b in bounded_groups([len(t) for t in texts], BATCH_BYTES):
                w = words_of(texts[a:b], codes=False)
                doc, start, _, key = runs_of(w, word_hashes(w, 0))
                base = np.cumsum(w.count()) - w.count()
                yield pd.DataFrame({"key": key, "doc": docs[a:b][doc], "at": start - base[doc]})

    found = stored(docs.select("doc", "text").mapInPandas(find, "key long, doc long, at int"), "debruijn-runs")
    # a minimiser that no task has so often is gathered: TOGETHER runs at most (two a task, if more)
    often = max(2, TOGETHER // max(found.rdd.getNumPartitions(), 1))

    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = _whole(batches)
        if len(keys):
            key, count = np.unique(keys["key"].to_numpy(), return_counts=True)
            yield pd.DataFrame({"key": key[count >= often]})

    hot = sized(stored(found.select("key").mapInPandas(frequent, "key long").distinct(), "debruijn-hot"), F.lit(16))
    usual = found.join(hot, "key", "left_anti").repartition("key").mapInPandas(recurring, "doc long, at int, hot boolean")
    marks = usual.union(found.join(hot, "key").select("doc", "at", F.lit(True)))
    marks = marks.groupBy("doc").agg(F.collect_list(F.struct("at", "hot")).alias("marks"))

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_bytes(t) for t in batch["text"].tolist()]
            docs, pos, marks = batch["doc"].to_numpy(), batch["pos"].to_numpy(), batch["marks"].tolist()
            for a, b in bounded_groups([len(t) for t in texts], BATCH_BYTES):
                w = words_of(texts[a:b], codes=False)
                one = word_hashes(w, 0)
                doc, start, size, key = runs_of(w, one)
                base = np.cumsum(w.count()) - w.count()
                places = np.array([base[i] + m["at"] for i, ms in enumerate(marks[a:b]) for m in ms], np.int64)
                order = np.argsort(places)
                hot = np.array([m["hot"] for ms in marks[a:b] for m in ms], bool)[order]
                mine = np.searchsorted(start, places[order])
                edges = np.stack([spans(one, SPAN, 0), spans(word_hashes(w, 1), SPAN, 1)], 1).tobytes()
                doc, start, size, key = doc[mine], start[mine], size[mine], key[mine]
                yield pd.DataFrame(
                    {"key": key, "hot": hot, "doc": docs[a:b][doc], "pos": pos[a:b][doc], "at": start - base[doc],
                     "edges": [edges[16 * x : 16 * (x + m)] for x, m in zip(start.tolist(), size.tolist(), strict=True)]}
                )

    rows = docs.join(marks, "doc").mapInPandas(carry, f"key long, hot boolean, {PLACE}, edges binary")
    rows = stored(rows, "debruijn-edges")
    usual = rows.filter("not hot").select("key", "doc", "pos", "at", "edges").repartition("key")
    return paths(usual.mapInPandas(settle, PIECE).union(hot_pieces(rows.filter("hot").drop("key", "hot"))))


def numbered(df: DataFrame, keep: list[str], doc_id: str, text: str) -> DataFrame:
    """(doc, pos, text, __k0, ...): all rows, numbered, in a table bucketed by that number."""
    spark, name = df.sparkSession, f"debruijn_{uuid.uuid4().hex}"
    rows = df.select(
        F.monotonically_increasing_id().alias("doc"), F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST)).alias("pos"),
        F.coalesce(F.col(text), F.lit("")).alias("text"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)],
    )
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    writer = rows.repartition(buckets, "doc").write.option("path", fresh_path(spark, "debruijn-docs"))
    writer.option("compression", "zstd").bucketBy(buckets, "doc").sortBy("doc").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay in the shared folder
    return table


def remove_spans(df: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``keep`` columns, ``kept``, ``n_words``, ``n_removed``, ``spans`` of every row."""
    table = numbered(spread(df), keep, doc_id, text)
    prints = stored(
        table.select("doc", "pos", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")), "debruijn-texts"
    )
    groups = prints.groupBy("h1", "h2").agg(F.min(F.struct("pos", "doc")).alias("first"), F.count("*").alias("c"))
    groups = sized(stored(groups.filter("c > 1").select("h1", "h2", "first"), "debruijn-groups"), F.lit(40))
    # copies lose all windows; rows of the first copy's id are one document with it
    copies = stored(
        prints.join(groups, ["h1", "h2"]).filter("doc <> first.doc")
        .select("doc", (F.col("pos") > F.col("first.pos")).alias("copy"), F.col("first.doc").alias("leader")),
        "debruijn-copies",
    )
    fresh = table.select("doc", "pos", "text").join(sized(copies.select("doc"), F.lit(16)), "doc", "left_anti")
    gone = repeated_paths(fresh)
    gone = gone.groupBy("doc").agg(F.collect_list(F.struct("start", (F.col("stop") + SPAN - 1).alias("stop"))).alias("runs"))
    gone = stored(gone, "debruijn-gone")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.lit(2**31 - 1).alias("stop")))
    alike = copies.filter("not copy").select(F.col("doc").alias("own"), F.col("leader").alias("doc"))
    runs = gone.union(copies.filter("copy").select("doc", whole)).union(gone.join(alike, "doc").select("own", "runs"))
    rows = table.join(runs, "doc", "left").select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], F.col("text").alias("__text"), F.col("runs").alias("__runs")
    )
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    fields = [rows.schema[c] for c in keep] + [
        T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("spans", span),
    ]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept, size, lost, places = [], [], [], []
            for text, runs in zip(batch["__text"].tolist(), batch["__runs"].tolist(), strict=True):
                words, left, edges = text_bytes(text).split(), [], []
                if runs is not None and len(words) >= SPAN:
                    edges = merge_runs(runs, len(words)).tolist()
                at = 0
                for a, b in edges:
                    left += words[at:a]
                    at = b
                left += words[at:]
                kept.append(b" ".join(left).decode())
                size.append(len(words))
                lost.append(len(words) - len(left))
                places.append([{"start": a, "stop": b} for a, b in edges])
            out = batch.drop(columns=["__text", "__runs"])
            yield out.assign(kept=kept, n_words=size, n_removed=lost, spans=places)

    return rows.mapInPandas(cut, T.StructType(fields))
