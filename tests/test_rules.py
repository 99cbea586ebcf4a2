"""Scores, grades and text forms at their borders."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymeter.config import TrafficConfig
from waymeter.functions import congestion, text
from waymeter.functions.times import day_bounds
from waymeter.operators.alerts import critical_alerts
from waymeter.operators.windows import congestion_stored, congestion_windows

READING = ("sensor_id string, junction_name string, event_time timestamp, vehicle_count int, "
           "avg_speed double, is_critical boolean")
AT = datetime(2025, 7, 15, 8, 1)


def evaluate(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def readings(spark, *rows):
    return spark.createDataFrame([("J1", "A", *row) for row in rows], READING)


@pytest.mark.parametrize("index, level", [
    (70.0, "SEVERE"), (69.999, "MODERATE"), (40.0, "MODERATE"), (39.999, "LOW"),
    (69.9999999999, "SEVERE"), (-5.0, "LOW"), (None, "LOW"),
])
def test_level(spark, index, level):
    assert evaluate(spark, congestion.congestion_level(F.lit(index).cast("double"))) == level


@pytest.mark.parametrize("volume, speed, index", [
    (100, 0.0, 100.0), (100, 60.0, 0.0), (200, 90.0, -100.0), (9000, 45.0, 2250.0), (100, None, None),
])
def test_index(spark, volume, speed, index):
    value = evaluate(spark, congestion.congestion_index(F.lit(volume), F.lit(speed).cast("double")))
    assert value == (None if index is None else pytest.approx(index))


@pytest.mark.parametrize("volume, speed, index", [(9000, 45.0, 100.0), (200, 90.0, 0.0), (100, None, None)])
def test_clamped_index(spark, volume, speed, index):
    rules = TrafficConfig(clamp=True)
    value = evaluate(spark, congestion.congestion_index(F.lit(volume), F.lit(speed).cast("double"), rules))
    assert value == index


def test_mean_count_as_volume(spark):
    rows = readings(spark, (AT, 40, 30.0, False), (AT, 60, 30.0, False))
    by_sum = congestion_windows(rows).first()
    by_mean = congestion_windows(rows, TrafficConfig(volume="avg")).first()
    assert (by_sum.congestion_index, by_mean.congestion_index) == (50.0, 25.0)
    assert by_mean.total_vehicles == 100
    with pytest.raises(ValueError):
        TrafficConfig(volume="median")


def test_window_borders_and_nulls(spark):
    rows = readings(
        spark,
        (datetime(2025, 7, 15, 8, 0), 1, 10.0, None),
        (datetime(2025, 7, 15, 8, 4, 59, 999999), 2, None, None),
        (datetime(2025, 7, 15, 8, 5), 4, 20.0, None),
        (None, 100, 1.0, None),
    )
    found = {row.window_start.minute: row for row in congestion_windows(rows).collect()}
    assert {minute: row.total_vehicles for minute, row in found.items()} == {0: 3, 5: 4}
    assert found[0].mean_speed_kmph == 10.0
    assert found[0].window_end == datetime(2025, 7, 15, 8, 5)


def test_critical_limit_is_strict_and_skips_nulls(spark):
    rows = readings(spark, (AT, 1, 10.0, True), (AT, 2, 9.99, False), (AT, 3, None, True))
    assert [row.vehicle_count for row in critical_alerts(rows).collect()] == [2]


def test_busy_window_fits_the_stored_table(spark):
    rows = readings(spark, *[(AT, 100, 15.0, False)] * 300)
    stored = congestion_stored(congestion_windows(rows)).first()
    assert float(stored.congestion_index) == 22500.0
    assert stored.total_vehicles == 30000


def test_unstorable_decimal_is_null(spark):
    assert evaluate(spark, congestion.stored_decimal(F.lit(1e9), "decimal(6,2)")) is None
    assert str(evaluate(spark, congestion.stored_decimal(F.lit(12.345), "decimal(6,2)"))) == "12.35"


@pytest.mark.parametrize("hour, factor", [
    (0, 0.3), (5, 0.3), (6, 1.0), (7, 2.0), (9, 2.0), (10, 1.0), (12, 1.3), (13, 1.3), (14, 1.0),
    (17, 1.8), (19, 1.8), (20, 1.0), (23, 1.0),
])
def test_hour_factor(spark, hour, factor):
    assert evaluate(spark, congestion.hour_factor(F.lit(hour))) == factor


@pytest.mark.parametrize("expression, expected", [
    (lambda: text.hour_label(F.lit(7)), "07:00"),
    (lambda: text.hour_span_label(F.lit(8)), "08:00–09:00"),
    (lambda: text.hour_span_label(F.lit(23)), "23:00–00:00"),
    (lambda: text.one_decimal(F.lit(0.25)), "0.3"),
    (lambda: text.one_decimal(F.lit(-0.04)), "0.0"),
    (lambda: text.one_decimal(F.lit(None)), "nan"),
    (lambda: text.padded_speed(F.lit(7.2)), "07.2 km/h"),
    (lambda: text.padded_speed(F.lit(123.45)), "123.5 km/h"),
    (lambda: text.padded_name(F.lit("Pettah"), 8), "Pettah  "),
    (lambda: text.padded_name(F.lit("A name beyond it"), 8), "A name beyond it"),
    (lambda: text.intervention_reason(F.lit(60.0), F.lit(14.0)), "CI=60.0 (≥60.0)"),
    (lambda: text.intervention_reason(F.lit(59.9), F.lit(14.96)), "Avg speed 15.0 km/h (<15)"),
    (lambda: text.intervention_reason(F.lit(59.9), F.lit(15.0)), None),
    (lambda: text.intervention_reason(F.lit(None).cast("double"), F.lit(14.0)), "Avg speed 14.0 km/h (<15)"),
    (lambda: text.intervention_reason(F.lit(59.9), F.lit(None).cast("double")), None),
])
def test_text_forms(spark, expression, expected):
    assert evaluate(spark, expression()) == expected


def test_local_day_bounds(spark):
    start, end = spark.range(1).select(*day_bounds("2025-07-15", "Asia/Colombo")).first()
    assert (start, end) == (datetime(2025, 7, 14, 18, 30), datetime(2025, 7, 15, 18, 30))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=2, max_size=20))
def test_level_never_falls_as_the_index_rises(spark, values):
    grades = {"LOW": 0, "MODERATE": 1, "SEVERE": 2}
    frame = spark.createDataFrame([(value,) for value in sorted(values)], "ci double").coalesce(1)
    levels = [grades[row[0]] for row in frame.select(congestion.congestion_level(F.col("ci"))).collect()]
    assert levels == sorted(levels)
