"""CSV, JSON-lines and report files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wanewatch.sources.subscribers import SUBSCRIBER_DDL


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Headed CSV; with a schema no extra pass is made to infer one. Blank is NULL."""
    reader = spark.read.option("header", True).option("nullValue", "")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_subscribers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SUBSCRIBER_DDL)


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV folder without a row index; blanks inside values are kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def append_log(df: DataFrame, path: str, partition_by: list[str] | None = None) -> bool:
    """Append rows as JSON lines; nothing is written for an empty batch."""
    if df.isEmpty():
        return False
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)
    return True


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def results_document(
    ranked: DataFrame, *, score: str, target: float, at: Column, model: str = "model"
) -> DataFrame:
    """One row holding timestamp, target, best model and score, flag and all rows.

    ``ranked`` has one row per model, so the list is short.
    """
    order = F.struct(F.coalesce(F.col(score), F.lit(0.0)).alias("s"), F.col(model).alias("m"))
    best = F.max(F.col(score))
    return ranked.agg(
        at.alias("timestamp"),
        F.lit(float(target)).alias("target_metric"),
        F.max_by(model, order).alias("best_model"),
        best.alias("best_score"),
        (best > target).alias("beats_target"),
        F.sort_array(F.collect_list(F.struct(model, *[c for c in ranked.columns if c != model])))
        .alias("results"),
    )


def save_results(
    ranked: DataFrame, path: str, *, score: str, target: float, at: Column, model: str = "model"
) -> None:
    """Ranked rows as CSV below ``path``/csv and the document below ``path``/json."""
    write_csv(ranked, f"{path}/csv")
    write_json(
        results_document(ranked, score=score, target=target, at=at, model=model), f"{path}/json"
    )
