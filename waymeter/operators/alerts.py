"""Critical-speed alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.congestion import hour_factor, is_critical, stored_decimal
from waymeter.functions.times import UTC, local_time
from waymeter.schemas import SPEED


def critical_flag(readings: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    return readings.withColumn("is_critical", is_critical(F.col("avg_speed"), rules))


def critical_readings(readings: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """Readings slower than the limit. The sender's own flag is not consulted."""
    return readings.filter(is_critical(F.col("avg_speed"), rules))


def critical_alerts(readings: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    return critical_readings(readings, rules).select(
        "sensor_id",
        "junction_name",
        "avg_speed",
        "vehicle_count",
        F.col("event_time").alias("alert_time"),
    )


def with_processing_time(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("processing_time", F.current_timestamp())


def alerts_stored(alerts: DataFrame) -> DataFrame:
    """Alerts in the types of the stored table with its column defaults, clock columns apart."""
    kept = [name for name in alerts.columns if name != "avg_speed"]
    return alerts.filter(F.col("sensor_id").isNotNull()).select(
        *kept,
        stored_decimal(F.col("avg_speed"), SPEED.simpleString()).alias("avg_speed"),
        F.lit("CRITICAL").alias("severity"),
        F.lit(False).alias("acknowledged"),
    )


def with_created_at(stored: DataFrame) -> DataFrame:
    return stored.withColumn("created_at", F.current_timestamp())


def time_of_day_factor(readings: DataFrame, tz: str = UTC) -> DataFrame:
    """Vehicle counts with the usual rhythm of the day divided out."""
    hour = F.hour(local_time(F.col("event_time"), tz))
    return (
        readings.withColumn("hour", hour)
        .withColumn("factor", hour_factor(F.col("hour")))
        .withColumn("normal_count", F.col("vehicle_count") / F.col("factor"))
    )
