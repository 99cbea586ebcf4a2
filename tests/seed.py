"""Sample rows for trying the nightly work without live data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sample windows of five minutes (sensor, junction, local start, mean speed, vehicles,
# index, level). The level of J004 at 07:00 is given as data and differs from the rule.
SEED_WINDOWS = [
    ("J001", "Galle Face - Marine Drive", "2025-07-15 07:00:00+05:30", 18.5, 210, 72.3, "SEVERE"),
    ("J001", "Galle Face - Marine Drive", "2025-07-15 08:00:00+05:30", 12.1, 280, 85.1, "SEVERE"),
    ("J001", "Galle Face - Marine Drive", "2025-07-15 17:00:00+05:30", 15.3, 250, 78.0, "SEVERE"),
    ("J002", "Pettah - Manning Market", "2025-07-15 07:00:00+05:30", 22.0, 190, 55.3, "MODERATE"),
    ("J002", "Pettah - Manning Market", "2025-07-15 08:30:00+05:30", 10.5, 310, 89.2, "SEVERE"),
    ("J003", "Colombo 3 - Union Place", "2025-07-15 07:30:00+05:30", 38.0, 90, 22.5, "LOW"),
    ("J003", "Colombo 3 - Union Place", "2025-07-15 17:30:00+05:30", 25.0, 130, 47.2, "MODERATE"),
    ("J004", "Nugegoda - High Level Road", "2025-07-15 07:00:00+05:30", 20.0, 230, 67.8, "SEVERE"),
    ("J004", "Nugegoda - High Level Road", "2025-07-15 17:30:00+05:30", 17.5, 260, 74.5, "SEVERE"),
]

# Sample alerts (sensor, junction, speed, vehicles, local time).
SEED_ALERTS = [
    ("J001", "Galle Face - Marine Drive", 7.2, 120, "2025-07-15 08:15:00+05:30"),
    ("J002", "Pettah - Manning Market", 5.1, 145, "2025-07-15 08:35:00+05:30"),
    ("J004", "Nugegoda - High Level Road", 8.9, 110, "2025-07-15 17:45:00+05:30"),
]


def seed_windows(spark: SparkSession) -> DataFrame:
    schema = ("sensor_id string, junction_name string, start string, mean_speed_kmph double, "
              "total_vehicles bigint, congestion_index double, congestion_level string")
    rows = spark.createDataFrame(SEED_WINDOWS, schema)
    start = F.col("start").cast("timestamp")
    return rows.select(
        "sensor_id", "junction_name", start.alias("window_start"),
        (start + F.expr("INTERVAL 5 MINUTES")).alias("window_end"),
        "mean_speed_kmph", "total_vehicles", "congestion_index", "congestion_level",
    )


def seed_alerts(spark: SparkSession) -> DataFrame:
    schema = "sensor_id string, junction_name string, avg_speed double, vehicle_count int, at string"
    rows = spark.createDataFrame(SEED_ALERTS, schema)
    return rows.select(
        "sensor_id", "junction_name", "avg_speed", "vehicle_count",
        F.col("at").cast("timestamp").alias("alert_time"),
    )
