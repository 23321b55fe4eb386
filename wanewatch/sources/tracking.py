"""Append-only tables of runs, metrics and model stages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanewatch.operators.ranking import latest

PARAMS_DDL = "run string, kind string, key string, text string"
METRICS_DDL = "run string, key string, value double"
EVENTS_DDL = "name string, version int, stage string, seq bigint"
NO_STAGE, ARCHIVED, PRODUCTION = "None", "Archived", "Production"


class RunLog:
    """Parameters, tags and scalar metrics of training runs in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def log(
        self,
        run: str,
        params: dict[str, object] | None = None,
        metrics: dict[str, object] | None = None,
        tags: dict[str, object] | None = None,
    ) -> None:
        """Append one run; anything that is not a number is kept as text, metrics only numbers."""
        texts = [(run, "param", k, str(v)) for k, v in (params or {}).items()]
        texts += [(run, "tag", k, str(v)) for k, v in (tags or {}).items()]
        numbers = [
            (run, k, float(v))
            for k, v in (metrics or {}).items()
            if isinstance(v, (int, float)) and not isinstance(v, bool)
        ]
        if texts:
            rows = self.spark.createDataFrame(texts, PARAMS_DDL)
            rows.write.mode("append").parquet(f"{self.path}/runs")
        if numbers:
            rows = self.spark.createDataFrame(numbers, METRICS_DDL)
            rows.write.mode("append").parquet(f"{self.path}/run_metrics")

    def log_metrics(self, metrics: DataFrame) -> None:
        """Append (run, key, value) rows computed by Spark."""
        metrics.select("run", "key", F.col("value").cast("double")).write.mode("append").parquet(
            f"{self.path}/run_metrics"
        )

    def params(self) -> DataFrame:
        return self.spark.read.schema(PARAMS_DDL).parquet(f"{self.path}/runs")

    def metrics(self) -> DataFrame:
        return self.spark.read.schema(METRICS_DDL).parquet(f"{self.path}/run_metrics")


def current_stages(events: DataFrame) -> DataFrame:
    """(name, version, stage, seq): the newest stage of every version."""
    return latest(events, ["name", "version"], ["seq"], ["stage", "seq"])


def latest_versions(events: DataFrame, stages: list[str] | None = None) -> DataFrame:
    """Highest version per model and stage."""
    now = current_stages(events)
    if stages:
        now = now.where(F.col("stage").isin(stages))
    return now.groupBy("name", "stage").agg(F.max("version").alias("version"))


def promotion_events(
    events: DataFrame,
    name: str,
    *,
    version: int | None = None,
    target: str = PRODUCTION,
    archive: bool = False,
    seq: int,
) -> DataFrame:
    """Events that promote a version (the newest if none is given) and archive others."""
    now = current_stages(events.where(F.col("name") == name))
    chosen = now.agg(F.max("version").alias("_v")).where(F.col("_v").isNotNull())
    if version is not None:
        chosen = chosen.withColumn("_v", F.lit(version))
    promoted = chosen.select(
        F.lit(name).alias("name"),
        F.col("_v").cast("int").alias("version"),
        F.lit(target).alias("stage"),
        F.lit(seq).cast("bigint").alias("seq"),
    )
    if not archive:
        return promoted
    replaced = (
        now.where(F.col("stage") == target)
        .join(promoted.select("version"), "version", "left_anti")
        .select(
            "name",
            "version",
            F.lit(ARCHIVED).alias("stage"),
            F.lit(seq).cast("bigint").alias("seq"),
        )
    )
    return replaced.unionByName(promoted)


class Registry:
    """Model versions and their stages as an append-only event table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = f"{path.rstrip('/')}/model_events"

    def events(self) -> DataFrame:
        try:
            return self.spark.read.schema(EVENTS_DDL).parquet(self.path)
        except Exception as error:  # no event yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], EVENTS_DDL)

    def _next(self) -> int:
        return (self.events().agg(F.max("seq")).first()[0] or 0) + 1

    def register(self, name: str) -> int:
        """Add the next version of a model, without a stage."""
        known = self.events().where(F.col("name") == name).agg(F.max("version")).first()[0]
        version = (known or 0) + 1
        row = self.spark.createDataFrame([(name, version, NO_STAGE, self._next())], EVENTS_DDL)
        row.write.mode("append").parquet(self.path)
        return version

    def promote(
        self,
        name: str,
        version: int | None = None,
        target: str = PRODUCTION,
        archive: bool = False,
    ) -> int:
        made = promotion_events(
            self.events(), name, version=version, target=target, archive=archive, seq=self._next()
        ).collect()
        if not made:
            raise ValueError(f"no registered model with name {name}")
        rows = self.spark.createDataFrame(made, EVENTS_DDL)
        rows.write.mode("append").parquet(self.path)
        return max(r["version"] for r in made if r["stage"] == target)

    def latest(self, stages: list[str] | None = None) -> DataFrame:
        return latest_versions(self.events(), stages)


def run_name(model: str, at: datetime) -> str:
    return f"{model}_{at:%Y%m%d_%H%M%S}"
