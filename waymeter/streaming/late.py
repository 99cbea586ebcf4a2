"""A stream of windows in parts that keeps the readings which come too late.

Spark's own windowed aggregate drops rows behind the watermark and leaves a counter. Here one query without state
splits each micro-batch by the same rule: a reading is late if its window ended by the watermark of the batch before,
that is, by the latest event time up to two batches back less the allowed delay. What is on time is added to the table
of parts, what is late goes to a table of its own, so `counted + late = all`, and both are written under the batch's
key, so a replayed batch replaces itself.
"""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymeter.config import StreamConfig
from waymeter.operators.messages import good_records
from waymeter.operators.parts import split_late, window_parts
from waymeter.operators.windows import with_recorded_at
from waymeter.streaming.batch_sinks import BatchSink, query_id, table_sink
from waymeter.streaming.queries import started, writer

#: Files of the ledger per query: those of the last batches, each taking the place of the one this many before it.
SLOTS = 4
_ENTRY = "batch_id long, latest timestamp"


class WatermarkLedger:
    """The latest event time up to each of the last batches, one small file each."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/slot={batch_id % SLOTS}"

    def latest(self, batch_id: int) -> datetime | None:
        """The latest event time of all batches up to this one; None before the first."""
        if batch_id < 0:
            return None
        try:
            found = self.spark.read.schema(_ENTRY).parquet(self._path(batch_id)).first()
        except AnalysisException as missing:
            raise RuntimeError(f"no watermark of batch {batch_id} in {self.folder}") from missing
        if found is None or found.batch_id != batch_id:
            raise RuntimeError(f"no watermark of batch {batch_id} in {self.folder}")
        return found.latest

    def enter(self, batch_id: int, latest: datetime | None) -> None:
        self.spark.createDataFrame([(batch_id, latest)], _ENTRY).coalesce(1).write.mode("overwrite").parquet(self._path(batch_id))


def split_sink(config: StreamConfig, tables: str) -> BatchSink:
    """Writes a batch of readings to `tables`/congestion_parts and `tables`/late_readings.

    The ledger takes the batch when both are written, so a replay sees the same watermark and replaces the same rows.
    """
    parts = table_sink(f"{tables}/congestion_parts", "window_start", "window_date", config.writers)
    late_table = table_sink(f"{tables}/late_readings", "event_time", "event_date", config.writers)

    def write(batch: DataFrame, batch_id: int) -> None:
        ledger = WatermarkLedger(batch.sparkSession, f"{tables}/watermarks/{query_id(batch)}")
        before, two_before = ledger.latest(batch_id - 1), ledger.latest(batch_id - 2)
        # In whole milliseconds, as Spark keeps its watermark.
        closed = F.date_trunc("millisecond", F.lit(two_before).cast("timestamp")) - F.expr(f"INTERVAL '{config.rules.watermark}'")
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            on_time, late = split_late(batch, closed, config.rules)
            parts(with_recorded_at(window_parts(on_time, config.rules)), batch_id)
            late_table(with_recorded_at(late.withColumn("watermark", closed)), batch_id)
            here = batch.agg(F.max("event_time")).first()[0]
        finally:
            batch.unpersist()
        ledger.enter(batch_id, max((t for t in (before, here) if t is not None), default=None))

    return write


def start_split_windows(readings: DataFrame, config: StreamConfig, tables: str, trigger: dict | None = None) -> StreamingQuery:
    """Windows in parts and late readings, each reading in one of them."""
    rows = good_records(readings).select(
        "sensor_id", "junction_name", "event_time", "vehicle_count", "avg_speed",
        F.coalesce(F.col("is_critical"), F.lit(False)).alias("is_critical"))
    made = writer(rows, config, "window-parts", "append", trigger or {"processingTime": config.congestion_trigger})
    return started(made, rows, config, "window-parts", split_sink(config, tables))
