"""What happens to one micro-batch. Each sink is a function of (rows, batch id)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.config import JdbcConfig, StreamConfig
from waymeter.operators.messages import alert_messages
from waymeter.sinks.jdbc import append_table
from waymeter.sinks.kafka import publish

BatchSink = Callable[[DataFrame, int], None]


def query_id(batch: DataFrame) -> str:
    """Id of the running query: kept by its checkpoint, new with a new checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def spread(rows: DataFrame, keys: list[str], writers: int | None) -> DataFrame:
    """Hand the rows to `writers` tasks by their keys, each with an even share of every date.

    Without a number there are as many as state partitions, capped by nothing else: a stream's writes then
    grow with its `spark.sql.shuffle.partitions`. A date leaves at most that many files per batch.
    """
    count = writers or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionById(count, F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int"))


def table_sink(path: str, time_column: str, date_column: str, writers: int | None = None,
               keys: tuple[str, ...] = ("sensor_id", "junction_name")) -> BatchSink:
    """File table in which a replayed batch replaces itself.

    Partitions are (date, batch key); the key holds the query id too, as batch numbers start again
    with a new checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed = (
            batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .withColumn(date_column, F.to_date(time_column))
            .withColumn("batch_key", F.lit(f"{query_id(batch)}-{batch_id:012d}"))
        )
        (
            spread(keyed, [*keys, time_column], writers).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(date_column, "batch_key")
            .parquet(path)
        )

    return write


def jdbc_sink(config: JdbcConfig, table: str) -> BatchSink:
    """Append to a JDBC table: at least once, as a batch that is replayed is appended again."""
    return lambda batch, _: append_table(batch, config, table)


def alert_topic_sink(config: StreamConfig) -> BatchSink:
    """Forward alerts to the alert topic: at least once."""
    return lambda batch, _: publish(alert_messages(batch), config, config.topic_critical)


def fan_out(*sinks: BatchSink) -> BatchSink:
    """One batch to several sinks, computed once. An empty batch needs no test: nothing is written."""
    if len(sinks) == 1:
        return sinks[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write
