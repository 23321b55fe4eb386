"""Operators of wanewatch/llm against brute force on small tables."""

from __future__ import annotations

import base64
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from wanewatch.llm import (
    bpe,
    maxent,
    neighbours,
    packing,
    quality_rules,
    quality_svm,
    sharding,
    simhash,
    suffix_dedup,
    token_files,
    tokens,
)
from wanewatch.session import fresh_path

FOLDER = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long, tag string"
ODD = [
    (None, None, None, None, None, "x"), (7, "", "en", "a", 0, "x"), (7, "", "en", "a", 0, "x"),
    (8, " \n\t", None, "a", 3, "x"), (9, "one two", "en", None, 7, "x"), (10, "é漢😀 " * 3000, "en", "b", 12000, "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").persist()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DDL)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def test_encode_matches_the_libraries(texts):
    rnd = random.Random(3)
    parts = ["'s", "'", "  ", " ", "\n", "\r\n", "'re", "'ll", "a", "Z", "é", "1", "½", "漢", "!", "　", "😀", "\x1c", "\x85", "b" * 70, "\0"]
    many = list(texts.values())[:60] + ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(500)]
    raw = open(tokens.MULTI_FILE, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    first = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    second = Tokenizer.from_file(tokens.GPT_FILE)
    for made, ask in (
        (bpe.Ranks.from_ranks(raw), first.encode_ordinary),
        (bpe.Ranks.from_merges(open(tokens.GPT_FILE, "rb").read()), lambda t: second.encode(t, add_special_tokens=False).ids),
    ):
        ids, count = bpe.encode(many, made)
        stop = np.cumsum(count)
        for text, a, b in zip(many, stop - count, stop, strict=True):
            assert ids[a:b].tolist() == ask(text)
        assert bpe.decode(ids, made)[0] == "".join(many).encode()


def test_added_tokens_keep_their_id():
    second = Tokenizer.from_file(tokens.GPT_FILE)
    end = "<|endoftext|>"
    rnd = random.Random(4)
    many = [f"a {end} b", end, end * 3, f"{end}'s", f"it'{end}s", f"x \n{end}\n x", "<|endoftext", "", f" {end} ", "é漢" + end]
    many += ["".join(rnd.choices([end, " ", "a", "'s", "é", "\n", "<|", "1"], k=rnd.randint(0, 12))) for _ in range(300)]
    made = bpe.Ranks.from_merges(open(tokens.GPT_FILE, "rb").read())
    ids, count = bpe.encode(many, made)
    stop = np.cumsum(count)
    for text, a, b in zip(many, stop - count, stop, strict=True):
        assert ids[a:b].tolist() == second.encode(text, add_special_tokens=False).ids
    assert 50256 in ids and bpe.decode(ids, made)[0] == "".join(many).encode()


@pytest.mark.parametrize("top", [2, 300, 50_257, 2**32 - 1])
def test_simple8b_round_trip(top):
    rng = np.random.default_rng(top)
    ids = rng.integers(0, top, 20_000).astype(np.uint32)
    ids[rng.integers(0, len(ids), 20)] = 2**32 - 1
    assert (token_files.decode_page(**token_files.encode_page(ids)) == ids).all()


def test_token_files(spark, docs, texts, odd, empty):
    path = fresh_path(spark, "t")
    token_files.write_tokens(docs, path)
    tokenizer, at = Tokenizer.from_file(tokens.GPT_FILE), 0
    for r in token_files.read_tokens(spark, path).orderBy("doc_id").collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [2]
        assert r["start"] == at
        at += r["n_tokens"]
    for df, n in ((odd, 6), (empty, 0)):
        path = fresh_path(spark, "t")
        token_files.write_tokens(df, path)
        assert token_files.read_tokens(spark, path).count() == n


@pytest.mark.parametrize("weights", [None, {"src0": 0.1, "src1": 0.5, "src2": 0.4}])
def test_packing(docs, texts, weights):
    tokenizer = Tokenizer.from_file(tokens.GPT_FILE)
    rows = packing.pack(docs, weights=weights).toPandas()
    for i, g in rows.sort_values("start").groupby("doc_id"):
        assert np.frombuffer(b"".join(g["ids"]), "<u4").tolist() == tokenizer.encode(texts[i], add_special_tokens=False).ids + [1]
        assert g["start"].tolist() == np.append(0, np.cumsum(g["length"]))[:-1].tolist()
    for i, g in rows.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == np.append(0, np.cumsum(g["length"]))[:-1].tolist()
        assert g["length"].sum() == 2048 or i == rows["sequence_id"].max()


def test_packing_schedule_keeps_the_mixture():
    plan = packing.Schedule([5_000_000, 70_001, 3, 930_000])
    spent = plan.spent(np.arange(0, plan.total + 2048, 2048))
    assert (np.diff(spent, axis=0) >= 0).all()
    want = np.minimum(np.arange(0, plan.total + 2048, 2048), plan.total)
    assert (spent.sum(1) == want).all()
    # every queue owes less than one token, so the clock runs ahead by less than one a queue
    share = want[:, None] / plan.total * np.array([5_000_000, 70_001, 3, 930_000])
    assert np.abs(spent - share).max() < 4


@pytest.mark.parametrize("weights", [None, [0.5, 0.3, 0.0, 0.1, 0.1]])
def test_packing_places_every_token_of_small_queues(weights):
    totals = [3_000_000, 1_000_000, 1, 50, 7_000]
    plan = packing.Schedule(totals, weights)
    queue = np.repeat(np.arange(5), [60_000, 20_000, 1, 1, 140])
    length = np.array(totals)[queue] // np.bincount(queue)[queue]
    position = np.concatenate([np.cumsum(length[queue == q]) - length[queue == q] for q in range(5)])
    doc, start, count, window, offset = packing.cut(queue, position, length, plan, 2048)
    assert (np.bincount(doc, count, len(queue)) == length).all()
    fill = np.bincount(window, count)
    assert (fill[:-1] == 2048).all() and fill[-1] == sum(totals) % 2048
    assert len(set(zip(window.tolist(), offset.tolist()))) == len(window)
    # a lone token among so many that the windows between its queue's turns are never listed
    for total in (10**9, 10**13):
        plan = packing.Schedule([total, 3])
        doc, start, count, window, offset = packing.cut(np.array([1]), np.array([0]), np.array([3]), plan, 2048)
        assert count.tolist() == [1, 1, 1] and start.tolist() == [0, 1, 2]


def test_packing_keeps_weights_of_many_sources(spark):
    rows = [(i, "a b c d e f g h " * 20, f"s{i % 2}" if i < 400 else f"t{i}") for i in range(440)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(df, size=256, weights={"s0": 0.75, "s1": 0.25}, max_queues=8).toPandas()
    assert got["length"].sum() == got.drop_duplicates("doc_id")["doc_tokens"].sum()
    got["s"] = [r if r < 400 else -1 for r in got["doc_id"]]
    first = got[got["sequence_id"] < 50]
    share = first[first["s"].ge(0) & (first["s"] % 2 == 0)]["length"].sum() / first["length"].sum()
    assert share == pytest.approx(0.75, abs=0.01) and (first["s"] >= 0).all()


def test_rules_counts(spark, docs, texts, odd, empty):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality_rules.train(docs, labels)
    for r in quality_rules.apply_rules(docs, model, ["doc_id"]).collect():
        text = texts[r["doc_id"]]
        w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
        grams = Counter(zip(w, w[1:], w[2:]))
        hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r["n_words"] == len(w) and r["word_chars"] == sum(len(x.decode()) for x in w)
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_repeat_words"] == len(hit)
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality_rules.apply_rules(odd, None, ["doc_id"]).count() == 6
    assert quality_rules.apply_rules(empty, model, ["doc_id"]).count() == 0
    assert quality_rules.train(empty, labels) is None


def test_classifiers_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_svm.train(docs, labels, where=lambda c: c % 5 != 0)
    rows = quality_svm.score(docs, model, ["doc_id"]).join(labels, "doc_id").filter("doc_id % 5 = 0").toPandas()
    assert ((rows["score"] >= 0.3) == rows["quality"]).mean() > 0.9
    assert rows["score"].between(0, 1).all()


def test_classifier_edges(spark, odd, empty):
    labels = spark.createDataFrame([(7, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality_svm.train(odd, labels) is None
    assert {r["score"] for r in quality_svm.score(odd, None, ["doc_id"]).collect()} == {0.5}
    assert quality_svm.score(empty, None, ["doc_id"]).count() == 0


def test_sharding(docs, odd, empty):
    rows = sharding.interleave(docs, 40).toPandas()
    sizes = rows.groupby("shard").size()
    assert len(rows) == docs.count() and sizes.max() - sizes.min() <= 1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in rows.groupby("shard"))
    hot = rows[rows["source"] == "src0"].groupby("shard").size().reindex(range(40), fill_value=0)
    assert hot.max() - hot.min() <= 1
    assert sharding.interleave(odd, 40).count() == 6 and sharding.interleave(empty, 40).count() == 0


def fingerprint(text: str) -> int:
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("hot", [simhash.HOT, 1])
def test_simhash(spark, docs, texts, odd, empty, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = {i: fingerprint(t) for i, t in texts.items()}
    root = {i: i for i in prints}
    for i in sorted(prints):
        for j in sorted(prints):
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 2 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert {i: r["print"] % 2**64 for i, r in rows.items()} == prints
    assert {i: r["component_id"] for i, r in rows.items()} == root
    assert simhash.near_duplicates(odd).count() == 6 and simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("hot", [None, 8])
def test_suffix_dedup(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        monkeypatch.setattr(suffix_dedup, "LOCAL_HOT", hot)
    rnd = random.Random(5)
    base = ["".join(rnd.choices("abcdé ", k=rnd.randint(50, 500))) for _ in range(8)]
    rows = []
    for i in range(200):
        t = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 2)):
            t[rnd.randrange(len(t))] = "#"
        rows.append((i, "".join(t) + rnd.choice(["", "x" * rnd.randint(0, 300), "ab" * 120]) + rnd.choice(base)[rnd.randint(0, 40) :]))
    rows += [(300, None), (301, ""), (302, rows[0][1])]
    seen, want = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(b[s : s + 100])
        want[i] = bytes(x for x, g in zip(b, gone) if not g)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(df, ["doc_id"]).collect()
    assert {r["doc_id"]: bytes(r["kept"]) for r in got} == want
    assert suffix_dedup.remove_repeats(df.limit(0), ["doc_id"]).count() == 0


@pytest.mark.parametrize("hot", [None, 8, 2])
def test_suffix_dedup_of_repeated_rows(spark, monkeypatch, hot):
    """Rows of one id and text are one document; of two texts at the same place none is earlier."""
    if hot:
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        monkeypatch.setattr(suffix_dedup, "LOCAL_HOT", hot)
    rnd = random.Random(6)
    one, two, three, line = ("".join(rnd.choices("abcdef ", k=n)) for n in (400, 300, 250, 150))
    rows = [(1, one)] * 2 + [(None, two)] * 2 + [(2, three)] * 12 + [(3, one)] * 2 + [(4, line + "x" * 90), (4, line + "y" * 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeats(df, ["doc_id"]).collect()), key=str)
    want = [(1, 400, 0)] * 2 + [(None, 300, 0)] * 2 + [(2, 250, 0)] * 12 + [(3, 400, 400)] * 2 + [(4, 240, 0)] * 2
    assert got == sorted(want, key=str)


def test_neighbours_recall(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    table = df.toPandas()
    x, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    got = neighbours.search(df, df.filter("vec_id % 20 = 0")).toPandas()
    hits = 0
    for q, g in got.groupby("query_id"):
        s = x @ x[ids == q][0]
        s[ids == q] = -9
        hits += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(g["vec_id"]))
        assert sorted(g["rank"]) == list(range(1, 21))
    assert hits / len(got) >= 0.9
    bad = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0])]
    few = spark.createDataFrame(bad, "vec_id long, embedding array<float>")
    rows = neighbours.search(few, few).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in rows) == [(1, 2), (2, 1)]
    assert neighbours.search(few.limit(0), few).count() == 0


def test_maxent(docs, texts, odd, empty):
    rows = maxent.score(docs).toPandas()
    split = {i: re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) + [None] for i, t in texts.items()}
    c = Counter(x for i, w in split.items() if zlib.crc32(str(i).encode()) % 7 != 2 for x in w)
    n, v = sum(c.values()), len(c)
    for r in rows.itertuples():
        w = split[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    held = rows[rows["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()
    assert maxent.score(odd).count() == 6 and maxent.score(empty).count() == 0


def test_pipeline_stages(spark, docs):
    made = docs
    for name, stage in corpus_pipeline.STAGES:
        before, made = made, stage(spark, made, FOLDER).persist()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns and 0 < made.count() <= before.count()
    assert made.agg({"length": "sum"}).first()[0] > 0


def test_one_row_of_a_repeated_id(spark):
    """The smallest text of an id stays, whatever order the rows come in; null ids all stay."""
    words = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(4)]
    rows = [(3, words[2], "b"), (3, words[1], "c"), (3, words[1], "c"), (5, words[3], "d"), (None, words[0], "e"), (None, None, "f")]
    for turn in range(3):
        df = spark.createDataFrame(rows[turn:] + rows[:turn], "doc_id long, text string, __n string")
        got = sorted(map(tuple, simhash.one_per_group(df).collect()), key=str)
        assert got == sorted([(3, words[1], "c"), (5, words[3], "d"), (None, words[0], "e"), (None, None, "f")], key=str)


def test_an_id_on_two_texts_links_none_of_them(spark):
    """Of an id on a copy and on a clean text only the copy goes."""
    words = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(3)]
    rows = [(1, words[0]), (3, words[0]), (3, words[1]), (4, words[2]), (5, words[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.one_per_group(df).collect())) == [(1, words[0]), (3, words[1]), (4, words[2])]
    named = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert named == {(1, 1), (3, 1), (3, 3), (4, 4), (5, 3)}
