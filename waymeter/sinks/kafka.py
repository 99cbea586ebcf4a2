"""Publish (key, value) messages from the executors; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waymeter.config import StreamConfig


def kafka_sink_options(config: StreamConfig, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": config.broker, "topic": topic, "kafka.acks": "all"}


def publish(messages: DataFrame, config: StreamConfig, topic: str) -> None:
    messages.write.format("kafka").options(**kafka_sink_options(config, topic)).save()
