"""Physical plans: what reaches the scan, how often data is shuffled, what never appears."""

import re

import pytest
from pyspark.sql import functions as F

from waymeter.catalogue.queries import QUERIES
from waymeter.operators.hourly import hourly_rollup, peak_hours, windows_of_day
from waymeter.operators.alerts import critical_alerts
from waymeter.operators.messages import bad_records, decode_messages, good_records
from waymeter.operators.windows import congestion_stored, congestion_windows
from waymeter.schemas import RAW_MESSAGE
from waymeter.sinks.files import write_windows
from waymeter.sources.events import events_between, read_events, readings_from_events
from waymeter.sources.tables import read_windows

FOLDER = "/root/testdata/sf0.001"
PURE = [name for name in QUERIES if not re.match(r"stream|replay|csv|text_round|nightly_tables", name)]


def plan_of(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def tree_of(frame):
    return plan_of(frame).split("\n\n")[0]


def shuffles(frame):
    return len(re.findall(r"\bExchange\b", tree_of(frame)))


@pytest.mark.parametrize("name", PURE)
def test_no_query_leaves_the_jvm_or_joins(spark, name):
    tree = tree_of(QUERIES[name](spark, FOLDER))
    assert not re.search(r"Python|Pandas|Arrow|Cartesian|NestedLoop|Join|Broadcast|Generate.*Python", tree)


@pytest.mark.parametrize("name, count", [
    ("decode_readings", 0), ("encode_readings", 0), ("critical_flag", 0), ("time_of_day_factor", 0),
    ("critical_alerts", 0), ("alerts_stored", 0), ("alert_payload", 0), ("alert_lines", 0),
    ("congestion_windows", 1), ("congestion_stored", 1), ("hourly_rollup", 3), ("peak_hours", 3),
    ("interventions", 3), ("daily_peak_report", 3), ("rollup_stats", 4), ("volume_table", 3),
    ("chart_series", 3),
])
def test_shuffles(spark, name, count):
    """One per aggregate and one per global order."""
    assert shuffles(QUERIES[name](spark, FOLDER)) == count


def test_alert_scan_reads_only_what_it_needs(spark):
    plan = plan_of(QUERIES["critical_flag"](spark, FOLDER))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_day_reaches_the_scan(spark):
    events = events_between(read_events(spark, FOLDER), "2024-01-15", "2024-01-16")
    plan = plan_of(congestion_windows(readings_from_events(events)))
    assert "GreaterThanOrEqual(ts,2024-01-15 00:00:00.0)" in plan
    assert "LessThan(ts,2024-01-16 00:00:00.0)" in plan


def test_partial_sums_and_partial_peaks_come_before_the_shuffles(spark):
    windows = congestion_windows(readings_from_events(read_events(spark, FOLDER)))
    tree = tree_of(peak_hours(hourly_rollup(windows)))
    order = re.findall(r"(WindowGroupLimit|Exchange|HashAggregate)", tree)
    assert order == [
        "WindowGroupLimit", "Exchange", "WindowGroupLimit",
        "HashAggregate", "Exchange", "HashAggregate", "HashAggregate", "Exchange", "HashAggregate",
    ]


@pytest.mark.parametrize("tz, dates", [("UTC", 1), ("Asia/Colombo", 2)])
def test_stored_windows_are_pruned_to_the_day(spark, tmp_path, tz, dates):
    stored = congestion_stored(congestion_windows(readings_from_events(read_events(spark, FOLDER))))
    write_windows(stored, f"{tmp_path}/w")
    of_day = windows_of_day(read_windows(spark, f"{tmp_path}/w"), "2024-01-15", tz)
    plan = plan_of(of_day)
    assert re.search(r"PartitionFilters: \[.*window_date.*\]", plan)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(window_start,2024-01-1", plan)
    files = of_day.select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    found = {re.search(r"window_date=([-\d]+)", row.f).group(1) for row in files}
    assert len(found) == dates
    expected = windows_of_day(stored, "2024-01-15", tz).count()
    assert of_day.count() == expected


def test_backfill_writes_few_files(spark, tmp_path):
    stored = congestion_stored(congestion_windows(readings_from_events(read_events(spark, FOLDER))))
    write_windows(stored, f"{tmp_path}/w")
    assert len(list((tmp_path / "w").rglob("*.parquet"))) == 30


def test_each_message_is_parsed_once(spark):
    messages = spark.createDataFrame([], RAW_MESSAGE)
    decoded = decode_messages(messages)
    for frame in (congestion_windows(decoded), critical_alerts(decoded), bad_records(decoded),
                  good_records(decoded)):
        tree = plan_of(frame)
        assert len(re.findall(r"inline\(array\(from_json", tree)) >= 1
        assert not re.search(r"Condition : .*from_json", tree)
