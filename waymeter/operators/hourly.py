"""Hourly rollups, peak hours and interventions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.congestion import stored_decimal
from waymeter.functions.text import hour_span_label, intervention_reason
from waymeter.functions.times import UTC, day_bounds, local_time
from waymeter.operators.ranking import first_per_group
from waymeter.schemas import INDEX, SPEED


def windows_of_day(windows: DataFrame, day: str, tz: str = UTC) -> DataFrame:
    """Windows that start on a local day, by a range that scans and JDBC sources can prune on.

    Tables partitioned by the UTC date of the window are pruned by that column as well.
    """
    start, end = day_bounds(day, tz)
    chosen = windows.filter((F.col("window_start") >= start) & (F.col("window_start") < end))
    if "window_date" in windows.columns:
        last = F.to_date(end - F.expr("INTERVAL 1 MICROSECOND"))
        chosen = chosen.filter(F.col("window_date").between(F.to_date(start), last))
    return chosen


def hourly_rollup(windows: DataFrame, tz: str = UTC) -> DataFrame:
    """Windows to hours. Speed and index are means of window values, not weighted by readings."""
    slot = F.date_trunc("hour", local_time(F.col("window_start"), tz))
    return windows.groupBy("sensor_id", "junction_name", slot.alias("hour_slot")).agg(
        F.avg("mean_speed_kmph").cast("double").alias("avg_speed"),
        F.sum("total_vehicles").alias("total_vehicles"),
        F.avg("congestion_index").cast("double").alias("avg_ci"),
    )


def order_rollup(hourly: DataFrame) -> DataFrame:
    return hourly.orderBy("sensor_id", "hour_slot", "junction_name")


def peak_hours(hourly: DataFrame) -> DataFrame:
    """Each sensor's hour with most vehicles per day; of equals the earliest."""
    dated = hourly.filter(F.col("sensor_id").isNotNull()).withColumn("day", F.to_date("hour_slot"))
    best = first_per_group(
        dated,
        ["day", "sensor_id"],
        [F.col("total_vehicles").desc_nulls_last(), F.col("hour_slot"), F.col("junction_name")],
    )
    hour = F.hour("hour_slot")
    return best.select(
        "day",
        "sensor_id",
        "junction_name",
        hour.alias("peak_hour"),
        "total_vehicles",
        "avg_speed",
        "avg_ci",
        hour_span_label(hour).alias("peak_hour_label"),
    )


def flag_interventions(peaks: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """Peaks with the verdict and its reason; an unknown value never flags."""
    reason = intervention_reason(F.col("avg_ci"), F.col("avg_speed"), rules)
    return peaks.withColumn("reason", reason).withColumn("needs_police", F.col("reason").isNotNull())


def interventions(peaks: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    return flag_interventions(peaks, rules).filter("needs_police").drop("needs_police")


def rollup_stats(hourly: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """Per day: hourly records, junctions and interventions.

    One pass: a (day, sensor) aggregate carries the record count and the peak, and a second
    aggregate adds them up, so no distinct count and no join is needed.
    """
    # Smallest first, in the order of peak_hours: most vehicles, earliest hour, first name.
    rank = F.struct(
        F.col("total_vehicles").isNull(), -F.col("total_vehicles"), "hour_slot", "junction_name"
    )
    per_sensor = (
        hourly.withColumn("day", F.to_date("hour_slot"))
        .groupBy("day", "sensor_id")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min_by(F.struct("avg_ci", "avg_speed"), rank).alias("peak"),
        )
    )
    flagged = (F.col("peak.avg_ci") >= rules.police_ci) | (F.col("peak.avg_speed") < rules.police_speed)
    counted = flagged & F.col("sensor_id").isNotNull()
    return per_sensor.groupBy("day").agg(
        F.sum("records").alias("hourly_records"),
        F.count(F.lit(1)).alias("junctions"),
        F.count_if(counted).alias("interventions"),
    )


def daily_peak_report(peaks: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """The stored daily table: one row per day and sensor, without its clock column."""
    flagged = flag_interventions(peaks, rules)
    return flagged.select(
        F.col("day").alias("report_date"),
        "sensor_id",
        "junction_name",
        "peak_hour",
        F.col("total_vehicles").cast("bigint").alias("total_vehicles"),
        stored_decimal(F.col("avg_speed"), SPEED.simpleString()).alias("avg_speed"),
        stored_decimal(F.col("avg_ci"), INDEX.simpleString()).alias("avg_ci"),
        "peak_hour_label",
        "needs_police",
        "reason",
    )
