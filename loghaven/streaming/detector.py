"""The flow stream job: cold start, scoring, periodic retraining."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loghaven.lake import BATCH, Lake, write_batch
from loghaven.operators import anomaly
from loghaven.operators.anomaly import ClusterModel
from loghaven.operators.features import flow_features
from loghaven.operators.flows import only_anomalies, parse_flows, to_network_flows, valid_flows
from loghaven.operators.logs import log_base
from loghaven.streaming.models import ModelStore

# Job defaults.
COLD_START_ROWS = 100
RETRAIN_EVERY = 50
TRIGGER = {"processingTime": "10 seconds"}
# From so many rows on a batch is written where it is read; smaller ones are shuffled into few files.
IN_PLACE_ROWS = 1_000_000


def flow_stream(records: DataFrame) -> DataFrame:
    """topic, timestamp, value -> valid typed flows with the replay-safe batch time."""
    base = log_base(records)
    parsed = parse_flows(
        base.withColumn("kafka_ts", F.coalesce(F.col("kafka_ts"), F.current_timestamp()))
    )
    return valid_flows(parsed).withColumn("batch_ts", F.current_timestamp())


class FlowDetector:
    """Scores flows batch by batch.

    All state is in tables, and each decision depends on the batch number and on what
    earlier batches wrote, so a restarted or replayed batch decides the same way:

    * Until a model exists, flows are only landed. The batch that brings the landed
      rows to ``cold_start_rows`` trains the first model and scores all of them.
    * Every ``retrain_every``-th batch from then on trains a new model on its own
      rows, unless they are fewer than ``cold_start_rows``.
    * A batch uses the model trained in it, else the newest one trained before it.
    """

    def __init__(
        self,
        lake: Lake,
        k: int = anomaly.CLUSTERS,
        seed: int = anomaly.SEED,
        cold_start_rows: int = COLD_START_ROWS,
        retrain_every: int = RETRAIN_EVERY,
        threshold: float = anomaly.THRESHOLD,
    ):
        self.lake = lake
        self.k = k
        self.seed = seed
        self.cold_start_rows = cold_start_rows
        self.retrain_every = retrain_every
        self.threshold = threshold

    @property
    def landing(self) -> str:
        return f"{self.lake.location}/landing_flows"

    def _landed(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        try:
            rows = spark.read.parquet(self.landing)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], batch.schema).withColumn(BATCH, F.lit(0).cast("bigint"))
        return rows.filter(F.col(BATCH) <= batch_id)

    def _train(self, rows: DataFrame, batch_id: int, version: int, store: ModelStore) -> ClusterModel:
        model = anomaly.train(
            flow_features(rows), k=self.k, seed=self.seed, version=version, trained_at_batch=batch_id
        )
        store.save(model)
        return model

    def _write(self, rows: DataFrame, model: ClusterModel, batches: Sequence[int], in_place: bool) -> None:
        """Score and write rows that carry their batch number; anomalies are taken from the flows just
        written, so that neither is computed twice or kept meanwhile."""
        spark = rows.sparkSession
        scored = anomaly.score(flow_features(rows), model, self.threshold)
        self.lake.write_batch(to_network_flows(scored, keep=(BATCH,)), "network_flows", None, batches, in_place)
        flows = self.lake.read_batches(spark, "network_flows", batches)
        self.lake.write_batch(only_anomalies(flows), "network_anomalies", None, batches, in_place)

    def _record(self, batch: DataFrame, model: ClusterModel, batch_id: int) -> None:
        at = batch.select("batch_ts").first()["batch_ts"]
        self.lake.write_batch(
            anomaly.metrics_row(batch.sparkSession, model, F.lit(at), batch_id), "model_metrics", None, (batch_id,)
        )

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """A batch is kept in memory as far as it fits; the rest is read again from the source, which
        takes less than the disk that it would fill."""
        spark = batch.sparkSession
        store = ModelStore(spark, f"{self.lake.location}/models")
        batch = batch.persist(StorageLevel.MEMORY_ONLY)
        try:
            if batch.isEmpty():
                return
            numbered = batch.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
            first = store.first()
            if first is None or batch_id <= first.trained_at_batch:
                self._cold_start(batch, numbered, batch_id, store)
                return
            model = store.latest(before_batch=batch_id)
            batches_with_model = batch_id - first.trained_at_batch + 1
            if batches_with_model % self.retrain_every == 0:
                enough = batch.limit(self.cold_start_rows).count() >= self.cold_start_rows
                if enough:
                    model = self._train(numbered, batch_id, model.version + 1, store)
                    self._record(batch, model, batch_id)
            self._write(numbered, model, (batch_id,), batch.count() >= IN_PLACE_ROWS)
        finally:
            batch.unpersist()

    def _cold_start(self, batch: DataFrame, numbered: DataFrame, batch_id: int, store: ModelStore) -> None:
        write_batch(numbered, self.landing, None, replaces=(batch_id,), in_place=True)
        landed = self._landed(batch, batch_id)
        rows = {r[BATCH]: r["count"] for r in landed.groupBy(BATCH).count().collect()}
        if sum(rows.values()) < self.cold_start_rows:
            return
        model = self._train(landed, batch_id, 1, store)
        self._record(batch, model, batch_id)
        self._write(landed, model, sorted(rows), sum(rows.values()) >= IN_PLACE_ROWS)

    def start(self, records: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (
            flow_stream(records)
            .writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or TRIGGER))
            .foreachBatch(self.process)
            .start()
        )


class NotebookDetector:
    """Continuous learning on raw features: the scaling stays that of the baseline, the
    centers are refitted on every batch with enough rows, after it was scored."""

    def __init__(self, lake: Lake, baseline: ClusterModel, threshold: float = 2.0, min_rows: int = 100):
        self.lake = lake
        self.baseline = baseline
        self.threshold = threshold
        self.min_rows = min_rows

    @property
    def anomalies(self) -> str:
        return f"{self.lake.location}/notebook_anomalies"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        store = ModelStore(batch.sparkSession, f"{self.lake.location}/notebook_models")
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            model = store.latest(before_batch=batch_id) or self.baseline
            found = only_anomalies(anomaly.score(batch, model, self.threshold))
            write_batch(found, self.anomalies, None, batch_id)
            refitted = anomaly.refit_centers(batch, model, k=len(model.centers), min_rows=self.min_rows)
            if refitted is not model:
                store.save(ClusterModel(**{**vars(refitted), "trained_at_batch": batch_id}))
        finally:
            batch.unpersist()


class DecayingDetector:
    """Scores flows against centers that move with every batch instead of being refitted.

    The scaling stays that of the baseline. A batch is scored with the centers of the batch
    before, then each center moves to the mean of its old place, weighted by all points it has
    seen and discounted, and of the batch's points. The discount is ``decay`` per batch, or with
    ``half_life`` that after which so many rows count half. Centers and weights are one row of the
    model store for each batch, and a batch takes the newest row of an earlier one: a restarted
    job goes on from there, and a replayed batch moves the centers once, not twice.
    """

    def __init__(
        self,
        lake: Lake,
        baseline: ClusterModel,
        decay: float = 1.0,
        half_life: float | None = None,
        threshold: float = anomaly.THRESHOLD,
    ):
        self.lake = lake
        self.baseline = baseline
        self.decay = decay
        self.half_life = half_life
        self.threshold = threshold

    @property
    def path(self) -> str:
        return f"{self.lake.location}/decayed_models"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        store = ModelStore(batch.sparkSession, self.path)
        batch = flow_features(batch).persist()
        try:
            rows = batch.count()
            model = store.latest(before_batch=batch_id) or self.baseline
            flows = to_network_flows(anomaly.score(batch, model, self.threshold)).persist()
            try:
                self.lake.write_batch(flows, "network_flows", batch_id)
                self.lake.write_batch(only_anomalies(flows), "network_anomalies", batch_id)
            finally:
                flows.unpersist()
            if rows:
                decay = self.decay if self.half_life is None else 0.5 ** (rows / self.half_life)
                moved = anomaly.decayed_model(batch, model, decay)
                store.save(replace(moved, trained_at_batch=batch_id, training_rows=rows))
        finally:
            batch.unpersist()

    def start(self, records: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (
            flow_stream(records)
            .writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or TRIGGER))
            .foreachBatch(self.process)
            .start()
        )
