"""Windows as sums of parts, and the readings that come too late for them.

A part is what one batch of readings adds to a window. Sums and counts add up over batches in any order, so windows
need no state between batches, and rows that came too late can be added at any later time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.congestion import congestion_index, congestion_level
from waymeter.operators.windows import WINDOW_KEY

SUMS = ["speed_sum", "speeds", "total_vehicles", "counts", "readings"]


def _span(rules: TrafficConfig) -> Column:
    return F.window("event_time", rules.window)


def split_late(readings: DataFrame, closed: Column, rules: TrafficConfig = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Readings whose window is still open and those whose window ended by `closed`, a constant instant; null closes
    nothing. Every reading is in one of the two."""
    too_late = F.coalesce(F.col("span.end") <= closed, F.lit(False))
    spans = readings.withColumn("span", _span(rules)).withColumn("too_late", too_late)
    return spans.filter(~F.col("too_late")).drop("span", "too_late"), spans.filter("too_late").drop("span", "too_late")


def window_parts(readings: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """What these readings add to their windows: one shuffle after partial sums. An unknown total stays null."""
    grouped = readings.groupBy("sensor_id", "junction_name", _span(rules).alias("span")).agg(
        F.sum("avg_speed").alias("speed_sum"),
        F.count("avg_speed").alias("speeds"),
        F.sum("vehicle_count").alias("total_vehicles"),
        F.count("vehicle_count").alias("counts"),
        F.count(F.lit(1)).alias("readings"),
    )
    return grouped.select("sensor_id", "junction_name", F.col("span.start").alias("window_start"),
                          F.col("span.end").alias("window_end"), *SUMS)


def merged_parts(parts: DataFrame) -> DataFrame:
    """One part per window."""
    keys = WINDOW_KEY + [name for name in ("window_date",) if name in parts.columns]
    return parts.groupBy(*keys, "window_end").agg(*[F.sum(name).alias(name) for name in SUMS])


def windows_of_parts(parts: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """The windows that the parts add up to, in the columns of `congestion_windows`."""
    whole = merged_parts(parts)
    mean = F.when(F.col("speeds") > 0, F.col("speed_sum") / F.col("speeds"))
    volume = F.col("total_vehicles")
    if rules.volume == "avg":
        volume = F.when(F.col("counts") > 0, F.col("total_vehicles") / F.col("counts"))
    scored = whole.withColumn("mean_speed_kmph", mean).withColumn("congestion_index", congestion_index(volume, mean, rules))
    return scored.select(
        "sensor_id", "junction_name", "window_start", "window_end", "mean_speed_kmph", "total_vehicles",
        "congestion_index", congestion_level(F.col("congestion_index"), rules).alias("congestion_level"),
        *[name for name in ("window_date",) if name in parts.columns],
    )
