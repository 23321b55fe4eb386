"""The corpus pipeline: quality rules, quality classifier, near copies, repeated spans, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of ``documents``. ``docs`` is what the stage before has kept, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanewatch.llm import packing, quality_rules, quality_svm, simhash, suffix_dedup
from wanewatch.llm.common import read, stored


def renamed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with generated column names, which no operator's own columns have, and these names."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names


def own_names(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select([F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    model = quality_rules.train(docs, read(spark, sf_dir, "labels"))
    rows, names = renamed(docs)
    judged = quality_rules.apply_rules(rows, model, names, text=names[docs.columns.index("text")])
    return own_names(judged.filter("kept"), docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good."""
    model = quality_svm.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    rows, names = renamed(docs)
    scored = quality_svm.score(rows, model, names, text=names[docs.columns.index("text")])
    return own_names(scored.filter(F.col("score") >= quality_svm.THRESHOLD), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    rows, names = renamed(docs)
    own = dict(zip(docs.columns, names, strict=True))
    return own_names(simhash.one_per_group(rows, own["doc_id"], own["text"]), docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that an earlier place has too."""
    rows, names = renamed(docs)
    own = dict(zip(docs.columns, names, strict=True))
    rest = [own[c] for c in docs.columns if c not in ("text", "n_chars")]
    cut = suffix_dedup.remove_repeats(rows, rest, own["doc_id"], own["text"], as_text=True)
    made = {own["text"]: F.col("kept"), own["n_chars"]: F.length("kept").cast("long")}
    return own_names(cut.select(*rest, *[v.alias(k) for k, v in made.items()]), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("near_copies", near_copies),
    ("suffix_dedup", repeats),
    ("packing", packed),
]
# No SQL: tokens, models and fingerprints are beyond it; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
