"""Five-minute congestion windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.congestion import congestion_index, congestion_level, stored_decimal
from waymeter.operators.ranking import first_per_group
from waymeter.schemas import INDEX, SPEED

WINDOW_KEY = ["sensor_id", "junction_name", "window_start"]


def scored_windows(readings: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """Mean speed, vehicle total and index per sensor and `span`, a tumbling event-time window.

    One shuffle on (sensor, junction, window) after map-side partial sums, in batch and in a stream.
    Readings without an event time fall out, as `window` requires one.
    """
    measures = [
        F.avg("avg_speed").alias("mean_speed_kmph"),
        F.sum("vehicle_count").alias("total_vehicles"),
    ]
    if rules.volume == "avg":
        measures.append(F.avg("vehicle_count").alias("volume"))
    grouped = readings.groupBy(
        "sensor_id", "junction_name", F.window("event_time", rules.window).alias("span")
    ).agg(*measures)
    volume = F.col("volume" if rules.volume == "avg" else "total_vehicles")
    return grouped.withColumn(
        "congestion_index", congestion_index(volume, F.col("mean_speed_kmph"), rules)
    )


def congestion_windows(readings: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """Scored windows by start and end, with their level."""
    return scored_windows(readings, rules).select(
        "sensor_id",
        "junction_name",
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        "mean_speed_kmph",
        "total_vehicles",
        "congestion_index",
        congestion_level(F.col("congestion_index"), rules).alias("congestion_level"),
    )


def congestion_stored(windows: DataFrame) -> DataFrame:
    """Windows in the types of the stored table, which accepts no row without a sensor."""
    return windows.filter(F.col("sensor_id").isNotNull()).select(
        "sensor_id",
        "junction_name",
        "window_start",
        "window_end",
        stored_decimal(F.col("mean_speed_kmph"), SPEED.simpleString()).alias("mean_speed_kmph"),
        F.col("total_vehicles").cast("bigint").alias("total_vehicles"),
        stored_decimal(F.col("congestion_index"), INDEX.simpleString()).alias("congestion_index"),
        "congestion_level",
    )


def with_recorded_at(stored: DataFrame) -> DataFrame:
    return stored.withColumn("recorded_at", F.current_timestamp())


def latest_windows(rows: DataFrame) -> DataFrame:
    """The newest state of each window in a table that may hold several rows per window.

    Such are the live table, which stores every change, and a table appended to at least once. Where
    the clock cannot tell, the larger total is the newer one, as a window only grows.
    """
    # The date follows from the window's start; as a key it lets filters on it reach the partitions.
    keys = WINDOW_KEY + [name for name in ("window_date",) if name in rows.columns]
    order = [name for name in ("recorded_at", "batch_id", "total_vehicles") if name in rows.columns]
    return first_per_group(rows, keys, [F.col(name).desc_nulls_last() for name in order])
