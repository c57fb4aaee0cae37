"""Hunts on streams: an indicator list that changes while the stream runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loghaven.lake import folders, write_batch
from loghaven.operators.intel import match_indicators, tag_indicators


class IndicatorHunt:
    """Matches each batch of a stream with the list as it is when the batch comes.

    ``listed`` reads the list anew for every batch, and its size is measured anew, so an address
    listed between two batches is found from the next one on, and a list that outgrows the
    broadcast bound is joined another way. What a batch read is kept beside its result: a
    batch that is replayed after a crash meets the same list and replaces what it wrote.
    """

    def __init__(self, path: str, listed: Callable[[SparkSession], DataFrame], key: str, tag: bool = False):
        self.path = path
        self.listed = listed
        self.key = key
        self.tag = tag

    def snapshot(self, spark: SparkSession, batch_id: int) -> DataFrame:
        folder = f"{self.path}_lists/batch-{batch_id}"
        if not folders(spark, f"{folder}/_SUCCESS"):
            self.listed(spark).write.mode("overwrite").parquet(folder)
        return spark.read.parquet(folder)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        join = tag_indicators if self.tag else match_indicators
        batch = batch.persist()
        try:
            found = join(batch, self.snapshot(batch.sparkSession, batch_id), self.key)
            write_batch(found, self.path, None, batch_id)
        finally:
            batch.unpersist()

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """What was found, in the columns of ``schema``; without rows while nothing was."""
        try:
            rows = spark.read.schema(schema).option("basePath", self.path).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)
        return rows.select(*schema.fieldNames())

    def start(self, events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.process)
        return (writer.trigger(**trigger) if trigger else writer).start()
