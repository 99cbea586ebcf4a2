"""Stored windows to the daily peak table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.times import UTC
from waymeter.operators.hourly import daily_peak_report, hourly_rollup, peak_hours, windows_of_day
from waymeter.operators.hours import hours_of_day


def nightly_peaks(windows: DataFrame, day: str | None = None, tz: str = UTC) -> DataFrame:
    """Peak hour per sensor for one local day, or for every day at once when `day` is None."""
    chosen = windows if day is None else windows_of_day(windows, day, tz)
    return peak_hours(hourly_rollup(chosen, tz))


def report_of_hours(hours: DataFrame, day: str | None = None, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """The nightly answer from the hours that a stream has stored, without the windows."""
    return daily_peak_report(peak_hours(hours if day is None else hours_of_day(hours, day)), rules)


def nightly_report(
    windows: DataFrame, day: str | None = None, tz: str = UTC, rules: TrafficConfig = DEFAULTS
) -> DataFrame:
    return daily_peak_report(nightly_peaks(windows, day, tz), rules)
