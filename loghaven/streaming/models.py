"""Versioned k-means models as rows of a small Parquet table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.operators.anomaly import ClusterModel

_SCHEMA = (
    "features array<string>, mean array<double>, std array<double>, centers array<array<double>>, "
    "weights array<double>, version int, wssse double, training_rows bigint, training_seconds double, "
    "trained_at_batch bigint"
)


class ModelStore:
    """Models below ``path``, one folder per training batch. Saving a batch's model again
    replaces it, so a replayed training leaves one model."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def save(self, model: ClusterModel) -> None:
        row = (
            list(model.features), list(model.mean), list(model.std), [list(c) for c in model.centers],
            list(model.weights), model.version, model.wssse, model.training_rows, model.training_seconds,
            model.trained_at_batch,
        )
        (
            self.spark.createDataFrame([row], _SCHEMA)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("trained_at_batch")
            .parquet(self.path)
        )

    def table(self) -> DataFrame:
        try:
            return self.spark.read.schema(_SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _SCHEMA)

    def _load(self, row) -> ClusterModel:
        return ClusterModel(
            features=tuple(row["features"]),
            mean=tuple(row["mean"]),
            std=tuple(row["std"]),
            centers=tuple(tuple(c) for c in row["centers"]),
            weights=tuple(row["weights"]),
            version=row["version"],
            trained_at_batch=row["trained_at_batch"],
            wssse=row["wssse"],
            training_rows=row["training_rows"],
            training_seconds=row["training_seconds"],
        )

    def latest(self, before_batch: int | None = None) -> ClusterModel | None:
        """The newest model, or the newest one trained before a batch."""
        rows = self.table()
        if before_batch is not None:
            rows = rows.filter(F.col("trained_at_batch") < before_batch)
        row = rows.orderBy(F.desc("trained_at_batch")).limit(1).first()
        return None if row is None else self._load(row)

    def first(self) -> ClusterModel | None:
        row = self.table().orderBy("trained_at_batch").limit(1).first()
        return None if row is None else self._load(row)

    def at_batch(self, batch_id: int) -> ClusterModel | None:
        row = self.table().filter(F.col("trained_at_batch") == batch_id).first()
        return None if row is None else self._load(row)
