"""Windows to hours and hours to daily peaks as chained event-time aggregates.

The same three steps as the nightly batch, but on a stream each hour and each day comes out once, when the watermark
has passed it, so no night reads the window table again. Each step is one shuffle after partial sums, and its state is
what is still open: windows of minutes, then one row per sensor and hour, then one per sensor and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.text import hour_span_label
from waymeter.functions.times import UTC, fixed_offset, local_time
from waymeter.operators.windows import scored_windows

HOUR, DAY = 60, 24 * 60


def _span(of: str, minutes: int, tz: str) -> Column:
    """Hours or days of `tz` around the window column `of`; they begin at even distances from its offset."""
    start = -fixed_offset(tz) % minutes
    return F.window(F.window_time(F.col(of)), f"{minutes} minutes", startTime=f"{start} minutes")


def _hours(readings: DataFrame, rules: TrafficConfig, tz: str) -> DataFrame:
    windows = scored_windows(readings, rules).filter(F.col("sensor_id").isNotNull())
    return windows.groupBy("sensor_id", "junction_name", _span("span", HOUR, tz).alias("hour")).agg(
        F.avg("mean_speed_kmph").alias("avg_speed"),
        F.sum("total_vehicles").alias("total_vehicles"),
        F.avg("congestion_index").alias("avg_ci"),
    )


def hours_of_readings(readings: DataFrame, rules: TrafficConfig = DEFAULTS, tz: str = UTC) -> DataFrame:
    """Hours of known sensors: means of window values and vehicle totals, as `hourly_rollup` has them of windows."""
    return _hours(readings, rules, tz).select(
        "sensor_id",
        "junction_name",
        F.col("hour.start").alias("hour_start"),
        F.col("hour.end").alias("hour_end"),
        local_time(F.col("hour.start"), tz).alias("hour_slot"),
        "avg_speed",
        "total_vehicles",
        "avg_ci",
    )


def peaks_of_readings(readings: DataFrame, rules: TrafficConfig = DEFAULTS, tz: str = UTC) -> DataFrame:
    """Each sensor's hour with most vehicles per day of `tz`, as `peak_hours` has them of hours: of equals the earliest."""
    hours = _hours(readings, rules, tz)
    # Smallest first: known totals, most vehicles, earliest hour, first name.
    rank = F.struct(F.col("total_vehicles").isNull(), -F.col("total_vehicles"), F.col("hour.start"), F.col("junction_name"))
    best = F.min_by(F.struct("junction_name", F.col("hour.start").alias("at"), "total_vehicles", "avg_speed", "avg_ci"), rank)
    days = hours.groupBy("sensor_id", _span("hour", DAY, tz).alias("span")).agg(best.alias("peak"))
    hour = F.hour(local_time(F.col("peak.at"), tz))
    return days.select(
        F.to_date(local_time(F.col("span.start"), tz)).alias("day"),
        "sensor_id",
        "peak.junction_name",
        hour.alias("peak_hour"),
        "peak.total_vehicles",
        "peak.avg_speed",
        "peak.avg_ci",
        hour_span_label(hour).alias("peak_hour_label"),
    )


def hours_of_day(hours: DataFrame, day: str) -> DataFrame:
    """Hours of one local day of a stored hour table, pruned by its date partition."""
    start = F.lit(day).cast("date")
    chosen = hours.filter((F.col("hour_slot") >= start) & (F.col("hour_slot") < F.date_add(start, 1)))
    if "hour_date" in hours.columns:  # the local date of the slot
        chosen = chosen.filter(F.col("hour_date") == start)
    return chosen
