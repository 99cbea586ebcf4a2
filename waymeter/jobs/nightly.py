"""The nightly application: the day's windows to the daily peak table, CSV files and text reports.

    spark-submit --py-files waymeter.zip waymeter/jobs/nightly.py --day 2025-07-15 \\
        --tz Asia/Colombo --tables <folder> --reports <folder>
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, JdbcConfig, TrafficConfig, add_options, given
from waymeter.functions.times import UTC, day_bounds
from waymeter.operators.hourly import hourly_rollup, windows_of_day
from waymeter.operators.hours import hours_of_day
from waymeter.operators.windows import latest_windows
from waymeter.plans.nightly import nightly_report, report_of_hours
from waymeter.plans.reports import (
    chart_series,
    nightly_text_report,
    order_volume,
    peak_volume,
    summary_text_report,
    volume_table,
)
from waymeter.schemas import HOURLY_VOLUME
from waymeter.session import build_session
from waymeter.sinks.files import write_csv, write_daily_report, write_lines
from waymeter.sources.jdbc import read_by_quantiles, read_table
from waymeter.sources.tables import read_alerts, read_daily_report, read_hours, read_windows


def write_nightly(spark: SparkSession, windows: DataFrame, day: str, tz: str, tables: str,
                  reports: str, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """The day's rows of the daily table from its windows, then its reports."""
    return write_daily(spark, nightly_report(windows, day, tz, rules), day, tables, reports)


def write_daily(spark: SparkSession, report: DataFrame, day: str, tables: str, reports: str) -> DataFrame:
    """The day's rows of the daily table, then its reports from the rows as stored."""
    path = f"{tables}/daily_peak_report"
    write_daily_report(report, path, day)
    stored = read_daily_report(spark, path).filter(F.col("report_date") == F.lit(day).cast("date"))
    peaks = stored.select(
        "sensor_id", "junction_name", "peak_hour", "total_vehicles", "avg_speed", "avg_ci",
        "peak_hour_label",
    ).orderBy("sensor_id")
    write_csv(peaks, f"{reports}/traffic_report_{day}")  # of a day without rows the header only
    write_lines(nightly_text_report(stored, day), f"{reports}/police_intervention_{day}")
    return stored


def write_volume_reports(windows: DataFrame, alerts: DataFrame, stored: DataFrame, day: str, tz: str,
                         reports: str, rules: TrafficConfig = DEFAULTS) -> None:
    """The reports of the day's hours from its windows."""
    write_hour_reports(hourly_rollup(windows_of_day(windows, day, tz), tz), alerts, stored, day, tz, reports, rules)


def write_hour_reports(hours: DataFrame, alerts: DataFrame, stored: DataFrame, day: str, tz: str,
                       reports: str, rules: TrafficConfig = DEFAULTS) -> None:
    """Hourly volume as CSV, chart series as JSON lines, and the text summary."""
    # One day of hours, a row per sensor and hour: computed once for all three.
    volume = volume_table(hours, rules).persist()
    ordered = order_volume(volume).select(*HOURLY_VOLUME.fieldNames())
    write_csv(ordered, f"{reports}/traffic_volume_report_{day}")
    chart_series(volume).write.mode("overwrite").json(f"{reports}/traffic_report_chart_{day}")
    start, end = day_bounds(day, tz)
    of_day = alerts.filter((F.col("alert_time") >= start) & (F.col("alert_time") < end))
    if "alert_date" in alerts.columns:  # the partition column, in UTC
        of_day = of_day.filter(F.col("alert_date").between(F.to_date(start), F.to_date(end)))
    lines = summary_text_report(
        peak_volume(volume), of_day, stored.filter("needs_police"), day, tz, rules=rules
    )
    write_lines(lines, f"{reports}/congestion_summary_{day}")
    volume.unpersist()


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--day", required=True, type=lambda text: date.fromisoformat(text).isoformat(), help="local day, as 2025-07-15")
    parser.add_argument("--tz", default=UTC, help="zone of the day and of the hours")
    parser.add_argument("--tables", required=True, help="folder of the file tables")
    parser.add_argument("--reports", required=True, help="folder of the reports")
    parser.add_argument("--jdbc", action="store_true", help="read windows and alerts over JDBC")
    parser.add_argument("--cut-by-counts", action="store_true", help="with --jdbc: connections of even numbers of windows, not of even times")
    parser.add_argument("--from-hours", action="store_true", help="take the hours that the stream has closed in this zone, not the windows")
    add_options(parser, TrafficConfig)
    options = parser.parse_args(arguments)
    rules = TrafficConfig(**given(options, TrafficConfig))

    spark = build_session("traffic-nightly")
    if options.jdbc:
        database = JdbcConfig.from_env()
        lower, upper = spark.range(1).select(*[
            F.date_format(edge, "yyyy-MM-dd HH:mm:ss") for edge in day_bounds(options.day, options.tz)
        ]).first()
        strides = {"lower": lower, "upper": upper}
        # Rows are appended at least once there, so a window may have several.
        if options.cut_by_counts:
            windows = read_by_quantiles(spark, database, "congestion_index", "window_start", "sensor_id",
                                        f"window_start >= '{lower}' AND window_start < '{upper}'")
        else:
            windows = read_table(spark, database, "congestion_index", column="window_start", **strides)
        windows = latest_windows(windows)
        alerts = read_table(spark, database, "critical_alerts", column="alert_time", **strides).dropDuplicates(
            ["sensor_id", "junction_name", "alert_time", "avg_speed", "vehicle_count"])
    else:
        windows = read_windows(spark, f"{options.tables}/congestion_index")
        alerts = read_alerts(spark, f"{options.tables}/critical_alerts")
    if options.from_hours:
        hours = hours_of_day(read_hours(spark, f"{options.tables}/hourly_rollup"), options.day)
        stored = write_daily(spark, report_of_hours(hours, rules=rules), options.day, options.tables, options.reports)
        write_hour_reports(hours, alerts, stored, options.day, options.tz, options.reports, rules)
        return
    stored = write_nightly(
        spark, windows, options.day, options.tz, options.tables, options.reports, rules
    )
    write_volume_reports(windows, alerts, stored, options.day, options.tz, options.reports, rules)


if __name__ == "__main__":
    main()
