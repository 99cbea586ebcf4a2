"""Row counts of every batch of every query, kept as a table.

Queries observe how many rows each batch gives (`rows`); a listener takes those counts, with the rows read and the rows
that an aggregate dropped behind its watermark, out of the progress events and stores them. It reads no data again.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from waymeter.operators.ranking import first_per_group
from waymeter.schemas import BATCH_COUNTS


class BatchCounts(StreamingQueryListener):
    """Appends a row per batch and observed count to a file table by date. `every` rows make a file; what is left is
    written when a query ends. Counts of a driver that dies before are lost, the data are not."""

    def __init__(self, spark: SparkSession, path: str, every: int = 1):
        self.spark, self.path, self.every = spark, path, every
        self.lock, self.rows, self.ended = threading.Lock(), [], {}

    def onQueryStarted(self, event) -> None:
        self._end_of(event.id, event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        # An idle trigger has no observed counts.
        made = [(p.name, str(p.id), str(p.runId), p.batchId, metric, row["rows"], p.numInputRows, dropped, p.timestamp)
                for metric, row in p.observedMetrics.items() if "rows" in row]
        with self.lock:
            self.rows += made
        self.flush(self.every)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self._end_of(event.id, event.runId).set()

    def _end_of(self, query_id, run_id) -> threading.Event:
        with self.lock:
            return self.ended.setdefault((str(query_id), str(run_id)), threading.Event())

    def flush(self, least: int = 1) -> None:
        with self.lock:
            if len(self.rows) < least:
                return
            rows, self.rows = self.rows, []
        found = self.spark.createDataFrame(rows, "query string, query_id string, run_id string, batch_id long, metric string, "
                                           "rows long, input_rows long, dropped_rows long, at string")
        found = found.withColumn("at", F.try_to_timestamp("at")).select(*BATCH_COUNTS.fieldNames(), F.to_date("at").alias("count_date"))
        found.coalesce(1).write.mode("append").partitionBy("count_date").parquet(self.path)

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the counts of an ended query are stored: events come after the query's own end."""
        if not self._end_of(query.id, query.runId).wait(seconds):
            raise TimeoutError(f"no end of query {query.name}")


def read_batch_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row per query, batch and count: a batch that ran again counts once."""
    rows = spark.read.schema(BATCH_COUNTS).parquet(path)
    return first_per_group(rows, ["query_id", "batch_id", "metric"], [F.col("at").desc_nulls_last(), F.col("run_id")])
