"""Fitted models, ensemble state and training checkpoints in a shared folder."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DDL = (
    "experiment string, epoch int, seq bigint, path string, metrics map<string,double>, "
    "best_score double, is_best boolean, extra string, saved_at timestamp, live boolean"
)


def save_model(model, path: str) -> None:
    """Persist a fitted pipeline; a bare model is wrapped into one."""
    wrapped = model if isinstance(model, PipelineModel) else PipelineModel([model])
    wrapped.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_state(spark: SparkSession, path: str, state: dict[str, object]) -> None:
    """Small fitted values (weights, names) as one parquet row of JSON."""
    rows = spark.createDataFrame([(json.dumps(state),)], "state string")
    rows.write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> dict[str, object]:
    return json.loads(spark.read.parquet(path).first()["state"])


class Checkpoints:
    """Checkpoint table of one folder: append-only events, newest ``keep`` per experiment live.

    An event with ``live`` false retires a checkpoint; its files stay for the storage's own
    expiry, and the table no longer offers it.
    """

    def __init__(
        self, spark: SparkSession, path: str, experiment: str, keep: int = 5, every: int = 1
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.table = f"{self.path}/checkpoints"
        self.experiment = experiment
        self.keep = keep
        self.every = every

    def history(self) -> DataFrame:
        """Live checkpoints of this experiment."""
        try:
            events = self.spark.read.schema(CHECKPOINT_DDL).parquet(self.table)
        except Exception as error:  # nothing saved yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            events = self.spark.createDataFrame([], CHECKPOINT_DDL)
        mine = events.where(F.col("experiment") == self.experiment)
        newest = F.max_by(F.struct("*"), F.struct(~F.col("live"), F.col("seq"))).alias("r")
        return mine.groupBy("path").agg(newest).select("r.*").where("live")

    def save(
        self,
        epoch: int,
        model=None,
        metrics: dict[str, float] | None = None,
        best_score: float | None = None,
        is_best: bool = False,
        extra: dict[str, object] | None = None,
    ) -> str | None:
        """Write model and row; None when the epoch is skipped. Retires old checkpoints."""
        if epoch % self.every != 0:
            return None
        live = self.history().orderBy(F.col("seq").desc()).limit(self.keep + 1).collect()
        seq = (live[0]["seq"] if live else 0) + 1
        path = f"{self.path}/{self.experiment}/epoch={epoch}-{seq}"
        if model is not None:
            save_model(model, path)
        plain = {k: float(v) for k, v in (metrics or {}).items() if v is not None}
        at = datetime.now(timezone.utc)
        text = json.dumps(extra) if extra else None
        rows = [
            (self.experiment, epoch, seq, path, plain, best_score, is_best, text, at, True)
        ]
        for old in live[self.keep - 1 :]:
            rows.append((*old[:-1], False))
        self.spark.createDataFrame(rows, CHECKPOINT_DDL).coalesce(1).write.mode("append").parquet(
            self.table
        )
        return path

    def latest(self) -> dict | None:
        """Newest live checkpoint, or None."""
        row = self.history().orderBy(F.col("seq").desc()).first()
        return row.asDict(recursive=True) if row else None

    def has_checkpoint(self) -> bool:
        return self.latest() is not None

    def load(self, path: str | None = None) -> dict | None:
        """Checkpoint row with its model under ``model``; the newest when no path is given."""
        row = self.latest()
        if path is not None:
            found = self.history().where(F.col("path") == path).first()
            row = found.asDict(recursive=True) if found else None
        if row is None:
            return None
        return {**row, "model": load_model(row["path"]) if self._has_model(row["path"]) else None}

    def _has_model(self, path: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/metadata")
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)


class TrainingResumer:
    """Continue an iterative job at the epoch after its newest checkpoint."""

    def __init__(
        self, spark: SparkSession, path: str, experiment: str = "training", keep: int = 3,
        every: int = 1,
    ):
        self.checkpoints = Checkpoints(spark, path, experiment, keep, every)
        self.best_score: float | None = None
        self.epoch = 0

    def can_resume(self) -> bool:
        return self.checkpoints.has_checkpoint()

    def resume(self) -> dict | None:
        row = self.checkpoints.load()
        if row:
            self.epoch, self.best_score = row["epoch"], row["best_score"]
        return row

    def save(self, epoch: int, model, metrics: dict[str, float], is_best: bool = False):
        self.epoch = epoch
        return self.checkpoints.save(
            epoch, model, metrics, best_score=self.best_score, is_best=is_best
        )


class BestCheckpoint:
    """Save when a watched metric strictly improves; the row carries the best before it."""

    def __init__(
        self,
        checkpoints: Checkpoints,
        monitor: str = "val_f1",
        mode: str = "max",
        best_only: bool = True,
    ):
        if mode not in ("max", "min"):
            raise ValueError(f"unknown mode: {mode}")
        self.checkpoints, self.monitor = checkpoints, monitor
        self.sign = 1 if mode == "max" else -1
        self.best_only = best_only
        self.best_score: float | None = None
        self.best_path: str | None = None

    def on_epoch_end(self, epoch: int, model, metrics: dict[str, float]) -> str | None:
        score = metrics.get(self.monitor)
        if score is None:
            return None
        better = self.best_score is None or self.sign * score > self.sign * self.best_score
        if self.best_only and not better:
            return None
        path = self.checkpoints.save(epoch, model, metrics, self.best_score, better)
        if better:
            self.best_score, self.best_path = score, path
        return path

    def best_model(self):
        found = self.checkpoints.load(self.best_path) if self.best_path else None
        return found["model"] if found else None
