"""The registered queries of the operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanewatch.llm import (
    debruijn,
    infill,
    lloyd,
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
from wanewatch.llm.common import crc_mod, read
from wanewatch.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, every source at its own share."""
    pieces = packing.pack(read(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document."""
    docs = read(spark, sf_dir, "documents")
    model = quality_rules.train(docs, read(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, model, ["doc_id"])


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes they decode to."""
    docs = read(spark, sf_dir, "documents")
    ids = tokens.encoded(docs, tokens.MULTI_FILE, ["doc_id"])
    back = tokens.decoded(ids, tokens.MULTI_FILE, ["doc_id", "n_tokens", "ids"])
    return back.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to repeats of 100 bytes, and the digest of what is left."""
    rows = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op5_quality_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; ids with crc32 divisible by 5 are never learnt from."""
    docs = read(spark, sf_dir, "documents")
    model = quality_svm.train(
        docs, read(spark, sf_dir, "labels"), where=lambda c: crc_mod(c, 5) != 0
    )
    return quality_svm.score(docs, model, ["doc_id"]).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= quality_svm.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of the same mixture, counts at most one apart."""
    rows = sharding.interleave(read(spark, sf_dir, "documents"), 40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every vector whose id is divisible by 20."""
    rows = read(spark, sf_dir, "embeddings")
    return neighbours.search(rows, rows.filter(F.col("vec_id") % 20 == 0), 20)


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the written token files hold of every document."""
    path = fresh_path(spark, "token-files")
    token_files.write_tokens(read(spark, sf_dir, "documents"), path)
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op10_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document; ids with crc32 mod 7 = 2 are not learnt from."""
    return maxent.score(read(spark, sf_dir, "documents"), held=(7, 2))


@query
def op11_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds over eight centroids, in whole numbers."""
    rows, centroids = lloyd.cluster(read(spark, sf_dir, "embeddings"))
    return lloyd.with_inertia(rows, centroids)


@query
def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, lengths and digests of the fill-in-the-middle output of every document."""
    rows = infill.fill_in_middle(read(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )


@query
def op13_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to repeats of 20 words, and the digest of the words that stay."""
    rows = debruijn.remove_spans(read(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def lloyd_sql(k: int = 8, rounds: int = 10, dimensions: int = 64) -> str:
    """Rounds of assignment and floored means, one pair of tables each."""
    apart = f"list_sum(list_transform(range(1, {dimensions + 1}), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT"
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dimensions}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
  FROM (SELECT v, sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h FROM kept ORDER BY h, v LIMIT {k}))"""
    ]
    for t in range(rounds + 1):
        steps.append(
            f"""a{t} AS MATERIALIZED (
  SELECT r, vec_id, v, min(struct_pack(d := {apart}, c := c)) AS best FROM kept, c{t} GROUP BY r, vec_id, v)"""
        )
        if t < rounds:
            steps.append(
                f"""s{t} AS (
  SELECT best.c AS c, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{t}, range(1, {dimensions + 1}) AS g(i) GROUP BY 1, 2),
c{t + 1} AS MATERIALIZED (
  SELECT c, coalesce(new, m) AS m FROM c{t} LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS new FROM s{t} GROUP BY c) USING (c))"""
            )
    tables = ",\n".join(steps)
    return f"""WITH {tables}
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
  sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c = best.c"""


SQL["op11_lloyd"] = lloyd_sql()

SQL["op12_infill"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS a,
    ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
        OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') AS p,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM parts"""

SQL["op13_debruijn"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM docs, unnest(range(1, len(w) - 18)) AS g(i)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id NULLS FIRST, i) AS rn FROM win) WHERE rn > 1),
gone AS (SELECT doc_id, list(DISTINCT i + j) AS g FROM later, range(20) AS r(j) GROUP BY doc_id),
kept AS (
  SELECT docs.doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed,
    list_filter(w, lambda x, i: NOT list_contains(coalesce(g, []), i)) AS k
  FROM docs LEFT JOIN gone ON docs.doc_id IS NOT DISTINCT FROM gone.doc_id)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept"""
