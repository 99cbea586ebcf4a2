"""What the operators produce fits the declared tables."""

import pytest

from waymeter import schemas
from waymeter.functions.congestion import congestion_level
from waymeter.operators.alerts import alerts_stored, critical_alerts, with_created_at, with_processing_time
from waymeter.operators.hourly import hourly_rollup
from waymeter.operators.messages import bad_records, decode_messages
from waymeter.operators.windows import congestion_stored, congestion_windows, with_recorded_at
from waymeter.plans.nightly import nightly_report
from waymeter.plans.reports import volume_table
from waymeter.sources.events import read_events, readings_from_events
from waymeter.streaming.queries import raw_rows

FOLDER = "/root/testdata/sf0.001"


def kinds(schema):
    return {field.name: field.dataType.simpleString() for field in schema}


def products(spark):
    readings = readings_from_events(read_events(spark, FOLDER))
    windows = congestion_windows(readings)
    empty = spark.createDataFrame([], schemas.RAW_MESSAGE)
    return {
        "CONGESTION_INDEX": with_recorded_at(congestion_stored(windows)),
        "CRITICAL_ALERTS": with_created_at(alerts_stored(with_processing_time(critical_alerts(readings)))),
        "HOURLY_VOLUME_BY_DAY": volume_table(hourly_rollup(windows)),
        "QUARANTINE": bad_records(decode_messages(empty)),
        "TRAFFIC_RAW": raw_rows(decode_messages(empty)).drop("event_date"),
    }


@pytest.mark.parametrize("table", [
    "CONGESTION_INDEX", "CRITICAL_ALERTS", "HOURLY_VOLUME_BY_DAY", "QUARANTINE", "TRAFFIC_RAW"])
def test_products_fit_their_tables(spark, table):
    assert kinds(products(spark)[table].schema) == kinds(getattr(schemas, table))


def test_daily_report_fits_its_table(spark):
    windows = congestion_windows(readings_from_events(read_events(spark, FOLDER)))
    declared = kinds(schemas.DAILY_PEAK_REPORT)
    declared.pop("created_at")
    assert kinds(nightly_report(windows).schema) == declared


def test_stored_values_survive_the_grade(spark):
    """The level is graded before storing and agrees with the stored index away from its borders."""
    stored = congestion_stored(congestion_windows(readings_from_events(read_events(spark, FOLDER))))
    away = stored.filter("abs(congestion_index - 70) > 0.01 and abs(congestion_index - 40) > 0.01")
    regraded = away.filter(away.congestion_level != congestion_level(away.congestion_index))
    assert regraded.isEmpty() and not away.isEmpty()
