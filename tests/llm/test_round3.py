"""Clustering, fill-in-the-middle and word spans against brute force, edge cases included."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wanewatch.llm import debruijn, infill, lloyd, queries, simhash, suffix_dedup, token_files

FOLDER = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, __text string, pos long, output string"


def units(text: str) -> list[str]:
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text)


def texts_of_all_kinds() -> list[str]:
    rnd = random.Random(2)
    letters = ["a", "Z", "z", "A", "@", "[", "`", "{", "é", "漢", "😀", " ", "\n", "\0", "\x7f", "<P>", "ā"]
    made = ["", "a", "aaaaaaaa", "aaaaaaa ", "é" * 4, "漢" * 5000, "x" * 4099, "<M>", "a<S>b", "ab cd", "\0" * 9]
    return made + ["".join(rnd.choices(letters[: rnd.randint(1, 17)], k=rnd.randint(0, 60))) for _ in range(1500)]


def test_units_match_the_pattern():
    texts = texts_of_all_kinds()
    made = infill.Units([t.encode() for t in texts])
    want = [units(t) for t in texts]
    assert made.n.tolist() == [len(u) for u in want]
    rnd = random.Random(1)
    for _ in range(5):
        at = [rnd.randint(0, len(u)) for u in want]
        assert made.cut(np.array(at)).tolist() == [len("".join(u[:k]).encode()) for u, k in zip(want, at, strict=True)]
    assert infill.Units([]).n.tolist() == []


def expected_form(i, text: str):
    h = [int(hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    u = units(text)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(u), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill_rows_and_round_trip(spark):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts_of_all_kinds())] + [(None, "ab cd", None, None, None), (3, None, "x", 2, "z")]
    df = spark.createDataFrame(rows, DDL).repartition(3)
    keep = df.select("doc_id", "text", F.col("pos"))
    got = infill.fill_in_middle(keep, ["doc_id", "text", "pos"]).withColumn("back", infill.restored()).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["text"] or ""
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == expected_form(r["doc_id"], text)
        assert r["back"] == text
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(df.limit(0), ["doc_id"]).count() == 0


def brute_lloyd(rows, k, rounds, seed):
    rows = sorted(rows, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in rows[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in rows]
        for j in range(len(c)):
            group = [v for (_, v), g in zip(rows, mine) if g == j]
            if group:
                c[j] = [sum(x) // len(group) for x in zip(*group)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in rows), key=str), c


@pytest.mark.parametrize("width", [3, 4, 7])
def test_lloyd_against_brute_force(spark, width, monkeypatch):
    monkeypatch.setattr(lloyd, "CHUNK", 16)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 7)).astype(np.float32) * 3
    x[60:90] = x[0]  # a third of the rows are one vector
    rows = [(i % 110, x[i].tolist()) for i in range(120)] + [(None, x[5].tolist()), (7, x[5].tolist())]
    bad = [(900, None), (901, [1.0] * 6), (902, [float("nan")] + [1.0] * 6), (903, [None] + [1.0] * 6), (904, [float("inf")] + [0.0] * 6), (905, [1e30] + [0.0] * 6), (906, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(3)
    got, centroids = lloyd.cluster(df, 5, 6, 3, dimensions=7, width=width)
    whole = [(i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]) for i, v in rows]
    want, c = brute_lloyd(whole, 5, 6, 3)
    assert sorted(map(tuple, got.collect()), key=str) == want and centroids.tolist() == c
    sums = lloyd.with_inertia(got, centroids).collect()
    assert {r["inertia"] for r in sums} == {sum(d for _, _, d in want)}


def test_lloyd_edges(spark):
    two = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.25, 0.0])], "vec_id long, embedding array<double>")
    rows, c = lloyd.cluster(two, 8, 3, dimensions=2)
    assert len(c) == 2 and {r["distance"] for r in rows.collect()} == {0}
    rows, c = lloyd.cluster(two.limit(0), dimensions=2)
    assert lloyd.with_inertia(rows, c).count() == 0


def test_lloyd_moves_no_cells(spark):
    """The way back to the cells shuffles assignments only."""
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = lloyd.whole_vectors(df, "vec_id", "embedding", 64)
    model = lloyd.Lloyd(lloyd.chunks_of(rows, 32, 64), lloyd.first_centroids(rows, 4, 3))
    other = spark.sparkContext.parallelize([((0, 0), 1)]).partitionBy(model.parts)
    met = model.cells.join(other, model.parts)
    assert met.getNumPartitions() == model.parts
    assert met.toDebugString().decode().count("PairwiseRDD") == 2  # one for either side, none for the join


def brute_spans(rows, span=20):
    """Kept words by id; ``rows`` in order of their place."""
    seen, want = {}, {}
    for i, t in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - span + 1):
            if seen.setdefault(tuple(w[s : s + span]), (i, s)) != (i, s):
                gone[s : s + span] = [True] * span
        want[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return want


def odd_corpus(n: int) -> list[tuple]:
    rnd = random.Random(9)
    base = [[rnd.choice(["a", "b", "cc", "é漢", "longer-word-than-eight", "q" * 600]) for _ in range(rnd.randint(10, 200))] for _ in range(6)]
    rows = []
    for i in range(n):
        t = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 2)):
            t[rnd.randrange(len(t))] = f"w{rnd.randrange(50)}"
        t += [f"u{i}"] * rnd.choice([0, 1, 45]) + rnd.choice(base)[rnd.randint(0, 9) :] + ["x", "y"] * rnd.choice([0, 30])
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(t)))
    return rows + [(n + 1, None), (n + 2, ""), (n + 3, " \n"), (n + 4, rows[0][1]), (None, rows[1][1]), (n + 5, " ".join(["k"] * 50))]


@pytest.mark.parametrize("hot", [debruijn.HOT, 6, 0])
def test_spans_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(debruijn, "HOT", hot)
    monkeypatch.setattr(debruijn, "TOGETHER", hot)
    rows = odd_corpus(150)
    df = spark.createDataFrame([(i, t, "a", 1, "b") for i, t in rows], DDL).repartition(4)
    got = debruijn.remove_spans(df, ["doc_id", "pos", "output"]).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got} == brute_spans(rows)
    assert all(sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)
    assert debruijn.remove_spans(df.limit(0), ["doc_id"]).count() == 0


def test_spans_of_repeated_rows(spark):
    rnd = random.Random(3)
    one, two, three = (" ".join(f"{rnd.random()}" for _ in range(40)) for _ in range(3))
    rows = [(1, one)] * 3 + [(None, two)] * 2 + [(3, one), (4, three), (4, three + " x"), (5, "a b c"), (6, "a b c")]
    got = debruijn.remove_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ["doc_id"])
    lost = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in got.collect()), key=str)
    want = [(1, 40, 0)] * 3 + [(None, 40, 0)] * 2 + [(3, 40, 40), (4, 40, 0), (4, 41, 0), (5, 3, 0), (6, 3, 0)]
    assert lost == sorted(want, key=str)


def test_contracts_of_the_queries(spark):
    kinds = {
        "op11_lloyd": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
        "op12_infill": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
        "op13_debruijn": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    }
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = brute_spans(docs)
    for name, kind in kinds.items():
        df = queries.QUERIES[name](spark, FOLDER)
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) == kind
        if name == "op13_debruijn":
            got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}
            assert got == {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, (n, g, k) in want.items()}
        if name == "op12_infill":
            texts = dict(docs)
            for r in df.collect():
                form = expected_form(r["doc_id"], texts[r["doc_id"]] or "")
                assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == form[:4]
                assert r["output_sha256"] == hashlib.sha256(form[4].encode()).hexdigest()
                assert r["restored_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_links_go_through_rows_without_id(spark, monkeypatch):
    """A middle row without an id joins two documents further apart than the bound."""
    prints = {"a": 0, "b": 0b11, "c": 0b1111, "d": 0xFF0000}
    monkeypatch.setattr(simhash, "with_fingerprints", lambda df, *_: df.select("doc_id", F.xxhash64("text").alias("tag"), "print"))
    rows = [(1, "a"), (None, "b"), (3, "c"), (None, "d")]
    df = spark.createDataFrame([(i, t, prints[t]) for i, t in rows], "doc_id long, text string, print long")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert got == {(1, 1), (None, None), (3, 1)}


def test_stages_take_columns_of_any_name(spark):
    """Columns named like every helper pass the stages untouched."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    clash = ["pos", "tag", "kept", "n_bytes", "n_removed", "spans", "runs", "__text", "__runs", "__pos", "__tag", "__row",
             "score", "n_words", "base_failed", "chance", "print", "component_id", "__gone", "doc", "__c0", "leader"]
    for k, c in enumerate(clash):
        docs = docs.withColumn(c, F.concat(F.lit(f"{k}-"), F.col("doc_id").cast("string")))
    docs = docs.persist()
    made = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, made, FOLDER)
        assert made.columns == docs.columns
        for r in made.collect():
            assert all(r[c] == f"{k}-{r['doc_id']}" for k, c in enumerate(clash)), name
    rows = suffix_dedup.remove_repeats(docs, ["doc_id", "pos", "tag"]).collect()
    assert {(r["pos"], r["tag"]) for r in rows} == {(f"0-{r['doc_id']}", f"1-{r['doc_id']}") for r in rows}
    assert debruijn.remove_spans(docs, ["doc_id", "pos", "tag", "runs", "doc"]).count() == len(rows)


def test_selectors_are_the_densest():
    rng = np.random.default_rng(5)
    for top in (2, 40, 5000, 1 << 20):
        width = token_files.WIDTH_OF[rng.integers(0, min(top, 1 << 17), 700)]
        width[rng.integers(0, 700, 300)] = rng.integers(0, 3)
        padded = np.append(width, np.zeros(240, np.int8))
        want = [
            min(s for s in range(16) if padded[i : i + token_files.COUNTS[s]].max() <= token_files.WIDTHS[s]) for i in range(700)
        ]
        assert token_files.choices(padded, 700).tolist() == want
