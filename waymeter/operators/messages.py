"""JSON messages to rows and rows to JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.congestion import known_speed
from waymeter.functions.text import ALERT_TIME, ISO_UTC
from waymeter.schemas import READING_MESSAGE


def decode_messages(messages: DataFrame) -> DataFrame:
    """Topic messages to readings, with the raw text kept for quarantine.

    Text that is no JSON object gives nulls in every field, a wrongly typed field a null in that
    field, and an unreadable time a null event time; nothing raises, so a stream never stops on them.

    The fields come out of a one-element `inline`, so that filters on them stay above the parser:
    pushed below a projection they would parse every message once more.
    """
    parsed = F.inline(F.array(F.from_json("json_str", READING_MESSAGE)))
    return (
        messages.selectExpr("CAST(value AS STRING) AS json_str", "timestamp AS kafka_ts")
        .select(parsed, "kafka_ts", "json_str")
        .withColumn("event_time", F.try_to_timestamp(F.col("timestamp")))
        .withColumn("avg_speed", known_speed(F.col("avg_speed")))
    )


def decode_readings(messages: DataFrame) -> DataFrame:
    return decode_messages(messages).drop("json_str")


def with_watermark(readings: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    return readings.withWatermark("event_time", rules.watermark)


def good_records(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("sensor_id").isNotNull() & F.col("event_time").isNotNull())


def bad_records(decoded: DataFrame) -> DataFrame:
    """Messages no window can count: without a sensor or a readable event time."""
    unusable = F.col("sensor_id").isNull() | F.col("event_time").isNull()
    return decoded.filter(unusable).select("json_str", "kafka_ts", "sensor_id", "timestamp")


def reading_json() -> Column:
    """The JSON text of a reading; unknown fields are written as null."""
    body = F.struct(
        "sensor_id",
        "junction_name",
        F.date_format("event_time", ISO_UTC).alias("timestamp"),
        "vehicle_count",
        "avg_speed",
        "is_critical",
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def encode_readings(readings: DataFrame) -> DataFrame:
    """Readings as (key, value) messages, keyed by sensor so that each sensor stays in order."""
    return readings.select(
        F.col("sensor_id").cast("string").alias("key"), reading_json().alias("value")
    )


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Critical alerts as (key, value) messages, keyed by sensor."""
    body = F.struct(
        "sensor_id",
        "junction_name",
        F.date_format("alert_time", ALERT_TIME).alias("alert_time"),
        "avg_speed",
        "vehicle_count",
        F.lit("CRITICAL").alias("severity"),
    )
    return alerts.select(
        F.col("sensor_id").cast("string").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )
