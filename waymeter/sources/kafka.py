"""Topic source. The connector ships with Spark as a package: spark-sql-kafka-0-10."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from waymeter.config import StreamConfig


def kafka_source_options(config: StreamConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": config.broker,
        "subscribe": config.topic_in,
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
    }
    if config.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    if config.min_partitions is not None:
        options["minPartitions"] = str(config.min_partitions)
    return options


def _milliseconds(instant: str) -> int:
    moment = datetime.fromisoformat(instant)
    return int((moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).timestamp() * 1000)


def kafka_batch_options(config: StreamConfig, start: str, end: str) -> dict[str, str]:
    """Messages whose broker time is from `start` up to, not with, `end`; times without a zone are UTC.

    A partition that has nothing at or after a bound is read to its end for the upper bound, and not at all for the
    lower one.
    """
    begin, until = _milliseconds(start), _milliseconds(end)
    if begin >= until:
        raise ValueError(f"{start} is not before {end}")
    options = {k: v for k, v in kafka_source_options(config).items() if k not in ("startingOffsets", "maxOffsetsPerTrigger")}
    return {**options, "startingTimestamp": str(begin), "endingTimestamp": str(until), "startingOffsetsByTimestampStrategy": "latest"}


def read_messages(spark: SparkSession, config: StreamConfig, start: str, end: str) -> DataFrame:
    """A bounded part of the topic, as one batch."""
    return spark.read.format("kafka").options(**kafka_batch_options(config, start, end)).load()


def stream_messages(spark: SparkSession, config: StreamConfig) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_source_options(config)).load()
