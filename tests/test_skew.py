"""One sensor, and one window of it, with a third of all rows; answers against plain Python."""

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waymeter.operators.hourly import hourly_rollup, peak_hours
from waymeter.operators.windows import congestion_windows

ROWS = 60_000
START = datetime(2025, 7, 15)


def skewed(spark):
    """A third of the rows lies in one window of J000; the rest is spread over 50 sensors and a day."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(0, ROWS, 1, 16).select(
        F.when(hot, "J000").otherwise(F.format_string("J%03d", (n * 7 % 50).cast("int"))).alias("sensor_id"),
        F.lit("A").alias("junction_name"),
        F.timestamp_seconds(
            F.lit(int((START - datetime(1970, 1, 1)).total_seconds()))
            + F.when(hot, 8 * 3600 + n % 300).otherwise(n * 13 % 86400)
        ).alias("event_time"),
        (n % 5).cast("int").alias("vehicle_count"),
        (n % 60).cast("double").alias("avg_speed"),
    )


def brute_force():
    windows = defaultdict(list)
    for n in range(ROWS):
        hot = n % 3 == 0
        sensor = "J000" if hot else f"J{n * 7 % 50:03d}"
        second = 8 * 3600 + n % 300 if hot else n * 13 % 86400
        windows[sensor, second // 300].append((n % 5, float(n % 60)))
    hours = defaultdict(list)
    for (sensor, window), rows in windows.items():
        total = sum(row[0] for row in rows)
        mean = sum(row[1] for row in rows) / len(rows)
        hours[sensor, window // 12].append((total, mean, total / 100 * (1 - mean / 60) * 100))
    peaks = {}
    for (sensor, hour), rows in sorted(hours.items()):
        total = sum(row[0] for row in rows)
        if sensor not in peaks or total > peaks[sensor][1]:
            peaks[sensor] = (hour, total, sum(r[1] for r in rows) / len(rows), sum(r[2] for r in rows) / len(rows))
    return windows, peaks


def test_skewed_sensor(spark):
    windows, peaks = brute_force()
    found = congestion_windows(skewed(spark)).collect()
    totals = {(row.sensor_id, int((row.window_start - START) / timedelta(minutes=5))): row for row in found}
    assert totals.keys() == windows.keys()
    assert {key: row.total_vehicles for key, row in totals.items()} == {
        key: sum(item[0] for item in rows) for key, rows in windows.items()}
    ours = {row.sensor_id: row for row in peak_hours(hourly_rollup(congestion_windows(skewed(spark)))).collect()}
    assert ours.keys() == peaks.keys()
    for sensor, (hour, total, speed, index) in peaks.items():
        row = ours[sensor]
        assert (row.peak_hour, row.total_vehicles) == (hour, total)
        assert (row.avg_speed, row.avg_ci) == (pytest.approx(speed), pytest.approx(index))


def test_nothing_is_lost_or_doubled(spark):
    rows = skewed(spark)
    windows = congestion_windows(rows)
    hourly = hourly_rollup(windows)
    totals = [frame.agg(F.sum(column)).first()[0] for frame, column in (
        (rows, "vehicle_count"), (windows, "total_vehicles"), (hourly, "total_vehicles"))]
    assert totals[0] == totals[1] == totals[2]
    assert peak_hours(hourly).groupBy("day", "sensor_id").count().filter("count > 1").isEmpty()
