"""Language model: hashed maximum entropy with a class-factored softmax.

Counts. A task numbers the words of a block of documents and keeps the documents as word
numbers. Every distinct word of a block goes once to the partition of its 64-bit hash, where
counts are summed over the corpus, and its count comes back to the block. (Two words in ten
billion share a hash about three times; such words would share a count.)

Model. The ``CLASSES * SLOTS`` most frequent training words form classes by frequency; all
other words are one more class, inside which the smoothed counts decide. A token's class, then
its place in the class, get a softmax over weights of hashed features: the word before, the two
skips behind it, and the pair of words before. Tasks take gradient steps on their training
blocks from common weights; the steps are averaged by tokens and handed out again, in two
rounds that together see every training document once.

Scores are sums of log10 over a text's tokens and its end. The base score is the add-one
estimate of the training counts alone.

Cases: a null or empty text is its end; a null id counts as empty text for the split; repeated
rows count each; without training rows the model is uniform over nothing known (one unknown
word); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanewatch.llm.common import bounded_groups, id_crc32, spread, stored, text_bytes
from wanewatch.llm.words import mixed, words_of

CLASSES, SLOTS = 32, 32
CLASS_ROWS, WORD_ROWS = 1 << 13, 1 << 14  # hashed feature buckets
SKIPS = 3
FEATURES = SKIPS + 1
BLOCK_BYTES = 6_000_000
BATCH = 4096
RATE = 0.15
WARM = 8  # one of so many blocks is in the first round
SLICES = 64
END = np.uint64(0x5DEECE66D5DEECE5)
NOTHING = np.uint64(0x2545F4914F6CDD1D)
BLOCKS = "block long, doc_ids array<{kind}>, counts array<int>, train array<boolean>, codes binary, vocab binary, n_train binary"


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(x.tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number of every token, tokens per text, hash of every number); 0 is the end."""
    w = words_of([t.lower() for t in texts])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, w.pieces), np.uint64, len(w.pieces))
    count = w.count()
    return np.insert(w.code + 1, np.cumsum(count), 0), count + 1, np.append(END, hashes)


def blocks_of(df: DataFrame, held: tuple[int, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents as blocks of word numbers; ``held`` = (modulus, remainder) is not trained on."""
    source = spread(df).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def make(ids: list, texts: list[bytes], number: int) -> pd.DataFrame:
        parts = [numbered(texts[a:b]) for a, b in bounded_groups([len(t) for t in texts], 2_000_000)]
        vocab, code = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
        at = np.cumsum([0] + [len(p[2]) for p in parts])
        codes = np.concatenate([code[a : a + len(p[2])][p[0]] for a, p in zip(at, parts, strict=False)])
        # frequent words get small numbers, which compress well
        order = np.argsort(-np.bincount(codes, minlength=len(vocab)), kind="stable")
        place = np.empty(len(vocab), np.int64)
        place[order] = np.arange(len(vocab))
        codes, vocab = place[codes], vocab[order]
        counts = np.concatenate([p[1] for p in parts])
        train = np.array([id_crc32(i) % held[0] != held[1] for i in ids], bool)
        n_train = np.bincount(codes[np.repeat(train, counts)], minlength=len(vocab))
        row = (
            TaskContext.get().partitionId() << 24 | number, ids, counts, train,
            _pack(codes.astype("<i4")), vocab.astype("<u8").tobytes(), _pack(n_train.astype("<i4")),
        )
        return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, size, number = [], [], 0, 0
        for batch in batches:
            for i, t in zip(batch["doc_id"].tolist(), batch["text"].tolist(), strict=True):
                raw = text_bytes(t)
                if texts and size + len(raw) > BLOCK_BYTES:
                    yield make(ids, texts, number)
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(None if pd.isna(i) else int(i))
                texts.append(raw)
                size += len(raw)
        if texts:
            yield make(ids, texts, number)

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInPandas(run, BLOCKS.format(kind=kind))


def corpus_counts(blocks: DataFrame) -> DataFrame:
    """(block, place, n, lead, hash): training count of every word of every block.

    One row of each word with training tokens is its ``lead``.
    """

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                vocab, n = np.frombuffer(r.vocab, "<i8"), _unpack(r.n_train, "<i4")
                for a in range(0, len(vocab), 100_000):
                    b = min(a + 100_000, len(vocab))
                    yield pd.DataFrame(
                        {"hash": vocab[a:b], "block": r.block, "place": np.arange(a, b, dtype=np.int32), "n": n[a:b]}
                    )

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        _, first, which = np.unique(rows["hash"].to_numpy(), return_index=True, return_inverse=True)
        total = np.bincount(which, rows["n"].to_numpy()).astype(np.int64)
        lead = np.zeros(len(rows), bool)
        lead[first] = total > 0
        out = pd.DataFrame({"block": rows["block"], "place": rows["place"], "n": total[which], "lead": lead})
        out["hash"] = rows["hash"].where(lead, 0)
        for a in range(0, len(out), 200_000):
            yield out.iloc[a : a + 200_000]

    rows = blocks.select("block", "vocab", "n_train").mapInPandas(entries, "hash long, block long, place int, n int")
    return rows.repartition("hash").mapInPandas(sums, "block long, place int, n long, lead boolean, hash long")


def features(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(token, feature) 64-bit keys from the words before, never across texts."""
    n = len(hashes)
    place = np.arange(n) - start
    out = np.empty((n, FEATURES), np.uint64)
    back = []
    for k in range(1, SKIPS + 1):
        word = np.full(n, NOTHING, np.uint64)
        word[k:] = hashes[:-k] if k <= n else hashes[:0]
        word[place < k] = NOTHING
        back.append(word)
        out[:, k - 1] = mixed(word + np.uint64(k))
    out[:, SKIPS] = mixed(back[0] * np.uint64(0xC2B2AE3D27D4EB4F) + back[1])
    return out


class Model:
    """Weights, the class words and the training totals."""

    def __init__(self, top: np.ndarray, top_counts: np.ndarray, total: int, distinct: int):
        order = np.argsort(top)
        self.sorted, self.rank = top[order], order.astype(np.int32)
        self.total, self.distinct = total, distinct
        self.rare = total - int(top_counts.sum()) + distinct - len(top) + 1
        self.class_rows = np.zeros((CLASS_ROWS, CLASSES + 1), np.float32)
        self.word_rows = np.zeros((WORD_ROWS, SLOTS), np.float32)
        # places without a word can't be drawn
        mass = np.zeros(CLASSES * SLOTS)
        mass[: len(top)] = top_counts + 1
        with np.errstate(divide="ignore"):
            self.word_bias = np.maximum(np.log(mass), -60).reshape(CLASSES, SLOTS).astype(np.float32)
            group = np.append(mass.reshape(CLASSES, SLOTS).sum(1), self.rare)
            self.class_bias = np.maximum(np.log(group), -60).astype(np.float32)

    @classmethod
    def of(cls, state: dict) -> Model:
        """A model of its own from another one's state."""
        model = cls.__new__(cls)
        vars(model).update(state)
        model.class_rows, model.word_rows = model.class_rows.copy(), model.word_rows.copy()
        return model

    def words(self, vocab: np.ndarray) -> np.ndarray:
        """Rank of every hash among the class words; CLASSES * SLOTS for all others."""
        out = np.full(len(vocab), CLASSES * SLOTS, np.int32)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, vocab), len(self.sorted) - 1)
            hit = self.sorted[at] == vocab
            out[hit] = self.rank[at[hit]]
        return out

    def forward(self, keys: np.ndarray, word: np.ndarray):
        """Log chances of class and place, and what the gradient needs."""
        kind = word // SLOTS
        rows = (keys & np.uint64(CLASS_ROWS - 1)).astype(np.int64)
        known = np.flatnonzero(kind < CLASSES)
        own = keys[known] ^ (kind[known].astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))
        word_rows = (mixed(own) >> np.uint64(64 - WORD_ROWS.bit_length() + 1)).astype(np.int64)
        a, b = self.class_bias, self.word_bias[kind[known]]
        for k in range(FEATURES):
            a = a + self.class_rows.take(rows[:, k], 0)
            b += self.word_rows.take(word_rows[:, k], 0)
        out = []
        for x in (a, b):
            x -= x.max(1, keepdims=True)
            p = np.exp(x)
            total = p.sum(1, keepdims=True)
            out.append((x - np.log(total), p / total))
        return kind, known, rows, word_rows, out[0], out[1]

    def log_chance(self, keys: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log of class and place; a rare word's share inside its class is not included."""
        kind, known, _, _, (a, _), (b, _) = self.forward(keys, word)
        out = a[np.arange(len(kind)), kind].astype(float)
        out[known] += b[np.arange(len(known)), word[known] % SLOTS]
        return out

    def learn(self, keys: np.ndarray, word: np.ndarray, seen: list[np.ndarray]) -> None:
        """One adaptive gradient step; ``seen`` holds squared gradients by bucket."""
        kind, known, rows, word_rows, (_, p), (_, q) = self.forward(keys, word)
        p[np.arange(len(kind)), kind] -= 1
        q[np.arange(len(known)), word[known] % SLOTS] -= 1
        for table, at, gradient, square in (
            (self.class_rows, rows, p, seen[0]), (self.word_rows, word_rows, q, seen[1]),
        ):
            if not len(at):
                continue
            flat = at.T.ravel()
            used = np.bincount(flat, minlength=len(table)) > 0
            bucket = np.flatnonzero(used)
            place = (np.cumsum(used) - 1)[flat]
            columns = [np.tile(c, FEATURES) for c in gradient.T]
            step = np.stack([np.bincount(place, c, len(bucket)) for c in columns], 1).astype(np.float32)
            square[bucket] += (step**2).mean(1)
            table[bucket] -= RATE * step / np.sqrt(square[bucket] + 1e-6)[:, None]

    def weights(self) -> np.ndarray:
        return np.concatenate([self.class_rows.ravel(), self.word_rows.ravel()])

    def load(self, flat: np.ndarray) -> None:
        cut = self.class_rows.size
        self.class_rows = flat[:cut].reshape(self.class_rows.shape).astype(np.float32)
        self.word_rows = flat[cut:].reshape(self.word_rows.shape).astype(np.float32)


def _tokens(r, model: Model):
    """(word ranks, feature keys, text index, codes) of a block."""
    codes, vocab = _unpack(r.codes, "<i4"), np.frombuffer(r.vocab, "<u8")
    counts = np.asarray(r.counts, np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    start = (np.cumsum(counts) - counts)[doc]
    return model.words(vocab)[codes], features(vocab[codes], start), doc, codes


def train_round(blocks: DataFrame, model: Model) -> Model:
    """Steps of all tasks on their training blocks, averaged by tokens."""
    shared = blocks.sparkSession.sparkContext.broadcast(dict(vars(model)))  # fixed size

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine, n, before = None, 0, None
        for batch in batches:
            for r in batch.itertuples(index=False):
                if mine is None:
                    mine = Model.of(shared.value)
                    before = mine.weights()
                    seen = [np.zeros(CLASS_ROWS, np.float32), np.zeros(WORD_ROWS, np.float32)]
                word, keys, doc, _ = _tokens(r, mine)
                rows = np.flatnonzero(np.asarray(r.train, bool)[doc])
                for a in range(0, len(rows), BATCH):
                    mine.learn(keys[rows[a : a + BATCH]], word[rows[a : a + BATCH]], seen)
                n += len(rows)
        if n:
            moved = ((mine.weights() - before) * n).astype("<f4")
            for k, part in enumerate(np.array_split(moved, SLICES)):
                yield pd.DataFrame([(k, n, _pack(part.astype("<f4")))], columns=["slice", "n", "moved"])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, list] = {}
        for batch in batches:
            for r in batch.itertuples(index=False):
                part = _unpack(r.moved, "<f4").astype(np.float64)
                old = totals.setdefault(r.slice, [0, 0.0])
                totals[r.slice] = [old[0] + r.n, old[1] + part]
        for k, (n, part) in totals.items():
            yield pd.DataFrame([(k, n, part.astype("<f4").tobytes())], columns=["slice", "n", "moved"])

    kind = "slice int, n long, moved binary"
    parts = blocks.mapInPandas(steps, kind).repartition("slice").mapInPandas(add, kind).collect()
    if parts:  # SLICES rows of fixed size
        parts = sorted(parts, key=lambda r: r["slice"])
        model.load(model.weights() + np.concatenate([np.frombuffer(r["moved"], "<f4") / r["n"] for r in parts]))
    return model


def score(df: DataFrame, held: tuple[int, int] = (7, 2), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    blocks = stored(blocks_of(df, held, doc_id, text), "lm-blocks")
    counts = stored(corpus_counts(blocks), "lm-counts")
    leads = counts.filter("lead")
    total, distinct = leads.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = leads.orderBy(F.desc("n"), "hash").limit(CLASSES * SLOTS).select("hash", "n").collect()
    hashes = np.array([r["hash"] for r in top], np.int64).view(np.uint64)
    model = Model(hashes, np.array([r["n"] for r in top], np.int64), total, distinct)
    spread_blocks = F.pmod(F.xxhash64("block"), F.lit(WARM))
    for part in (spread_blocks == 0, spread_blocks != 0):
        model = train_round(blocks.filter(part), model)
    shared = df.sparkSession.sparkContext.broadcast(dict(vars(model)))  # fixed size
    entry = F.struct("place", "n")
    arrays = counts.groupBy("block").agg(F.sort_array(F.collect_list(entry)).alias("c"))
    arrays = arrays.select(F.col("block").alias("b"), F.col("c.n").alias("train_counts"))
    rows = blocks.join(arrays, F.col("block") == F.col("b")).drop("b", "n_train")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model.of(shared.value)
        base_size = np.log10(model.total + model.distinct + 1)
        for batch in batches:
            for r in batch.itertuples(index=False):
                word, keys, doc, codes = _tokens(r, model)
                c = np.asarray(r.train_counts, np.int64)
                size = len(r.counts)
                log_c = np.log10(c + 1.0)[codes]
                base = np.bincount(doc, log_c - base_size, minlength=size)
                chance = np.empty(len(word))
                for a in range(0, len(word), BATCH):
                    chance[a : a + BATCH] = model.log_chance(keys[a : a + BATCH], word[a : a + BATCH])
                chance /= np.log(10)
                rare = word == CLASSES * SLOTS
                chance[rare] += log_c[rare] - np.log10(model.rare)
                out = pd.DataFrame({"doc_id": pd.Series(list(r.doc_ids), dtype=object)})
                out["held_out"] = ~np.asarray(r.train, bool)
                out["n_tokens"] = np.asarray(r.counts, np.int64)
                out["n_known"] = np.bincount(doc, c[codes] > 0, minlength=size).astype(np.int64)
                out["train_tokens"] = model.total
                out["base_score"] = base
                out["score"] = np.bincount(doc, chance, minlength=size)
                yield out

    return rows.mapInPandas(
        run,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
