"""Report products against fixed text."""

from datetime import datetime

import golden
import pytest
from pyspark.sql import functions as F

from waymeter.operators.hourly import interventions
from waymeter.plans import reports as R
from waymeter.schemas import HOURLY_VOLUME
from waymeter.sinks.files import write_csv

DAY = "2026-05-09"
LONG_NAMES = {
    "J001": "Galle Face - Marine Drive", "J002": "Pettah - Manning Market",
    "J003": "Colombo 3 - Union Place", "J004": "Nugegoda - High Level Road",
}


@pytest.fixture(scope="module")
def hourly(spark):
    """The fixed hourly table as a rollup."""
    rows = [(s, n, datetime(2026, 5, 9, h), v, speed, ci) for s, n, h, v, speed, ci, _ in golden.HOURLY]
    return spark.createDataFrame(rows, "sensor_id string, junction_name string, hour_slot timestamp, "
                                       "total_vehicles bigint, avg_speed double, avg_ci double")


@pytest.fixture(scope="module")
def volume(spark, hourly):
    """The volume table with the given levels instead of the rule's."""
    given = spark.createDataFrame([(s, h, level) for s, _, h, *_, level in golden.HOURLY],
                                  "sensor_id string, hour int, congestion_level string")
    return R.volume_table(hourly).drop("congestion_level").join(given, ["sensor_id", "hour"])


def lines(frame, *order):
    return "\n".join(row.line for row in frame.orderBy(*order).collect())


def test_volume_csv(volume, spark, tmp_path):
    write_csv(R.order_volume(volume).select(*HOURLY_VOLUME.fieldNames()), f"{tmp_path}/csv")
    text = [line for path in sorted((tmp_path / "csv").glob("part-*.csv"))
            for line in path.read_text().splitlines()]
    expected = [f"{s},{n},{h},{h:02d}:00,{v},{speed},{ci},{level}"
                for s, n, h, v, speed, ci, level in golden.HOURLY]
    assert text[0] == golden.CSV_HEADER
    assert [line for line in text if line != golden.CSV_HEADER] == expected


def test_levels_of_the_rule(hourly):
    differing = R.volume_table(hourly).collect()
    given = {(s, h): level for s, _, h, *_, level in golden.HOURLY}
    wrong = {row.congestion_index for row in differing if given[row.sensor_id, row.hour] != row.congestion_level}
    assert wrong == {65.0, 66.0, 67.8, 68.2}


def test_volume_peaks(volume):
    found = R.numbered_lines(R.peak_volume(volume), R.volume_peak_texts(), "sensor_id")
    expected = [line for line in golden.PEAK_SECTION.split("\n") if line]
    assert lines(found, "sensor_id", "line_no").split("\n") == expected


def test_summary_report(spark, volume):
    alerts = spark.createDataFrame(
        [("J001", "Galle Face", 7.2, datetime(2026, 5, 9, 2, 45)),
         ("J002", "Pettah", 5.1, datetime(2026, 5, 9, 3, 5)),
         ("J004", "Nugegoda", 8.9, datetime(2026, 5, 9, 12, 15))],
        "sensor_id string, junction_name string, avg_speed double, alert_time timestamp",
    )
    full = F.create_map(*[F.lit(item) for pair in LONG_NAMES.items() for item in pair])
    peaks = R.peak_volume(volume).select(
        "day", "sensor_id", full[F.col("sensor_id")].alias("junction_name"), "total_vehicles",
        F.col("avg_speed_kmph").alias("avg_speed"), F.col("congestion_index").alias("avg_ci"),
    )
    report = R.summary_text_report(
        R.peak_volume(volume), alerts, interventions(peaks), DAY, "Asia/Colombo"
    )
    text = "\n".join(row.line for row in report.collect())
    rule, thin = "=" * 65, "-" * 65
    assert text == "\n".join([
        rule, f"  TRAFFIC CONGESTION SUMMARY — {DAY}", rule, "",
        "PEAK HOURS (highest vehicle count per junction):", thin, golden.PEAK_SECTION,
        "CRITICAL ALERTS (avg_speed < 10 km/h):", thin, golden.ALERT_LINES, "",
        "POLICE INTERVENTION REQUIRED TOMORROW:", thin, golden.INTERVENTION_LINES, "",
        rule, "  END OF REPORT", rule,
    ])


def test_chart_series_sits_on_its_hours(volume):
    series = {row.sensor_id: row for row in R.chart_series(volume).collect()}
    assert series["J001"].label == "J001 – Galle Face"
    assert series["J001"].hours == [f"{hour:02d}:00" for hour in range(6, 21)]
    assert series["J001"].vehicles == [
        90, 210, 280, 180, 120, None, 150, None, None, None, None, 250, 230, None, 100]
    assert series["J003"].ci == [
        8.0, 22.5, 32.0, 25.5, None, None, 19.0, None, None, None, None, 47.2, 42.0, None, 10.0]
    assert series["J003"].speed[4] is None


def test_lines_number_from_one(spark):
    row = spark.range(1).select(F.lit("J1").alias("sensor_id"))
    found = R.numbered_lines(row, F.array(F.lit("a"), F.lit("b")), "sensor_id").collect()
    assert [(r.line_no, r.line) for r in found] == [(1, "a"), (2, "b")]
