"""Daily upkeep of the stream tables: closed dates become few files.

    spark-submit --py-files waymeter.zip waymeter/jobs/compact.py --tables <folder> --before 2025-07-15
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from waymeter.operators.windows import latest_windows
from waymeter.session import build_session
from waymeter.sinks.compaction import compact
from waymeter.sources import tables as T

#: Table, its date column, its reader, and what may drop superseded rows.
TABLES = (
    ("critical_alerts", "alert_date", T.read_alerts, None),
    ("congestion_index", "window_date", T.read_live_windows, latest_windows),
    ("congestion_live", "window_date", T.read_live_windows, latest_windows),
    ("traffic_raw", "event_date", T.read_raw, None),
    ("quarantine", "arrival_date", T.read_quarantine, None),
)


def compact_tables(spark: SparkSession, tables: str, before: str, settle_hours: float = 24) -> dict[str, list[str]]:
    return {
        name: compact(spark, f"{tables}/{name}", column, before, read, settle_hours, reduce)
        for name, column, read, reduce in TABLES
    }


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True, help="folder of the file tables")
    parser.add_argument("--before", required=True, type=lambda text: date.fromisoformat(text).isoformat(),
                        help="first UTC date to leave as it is")
    parser.add_argument("--settle-hours", type=float, default=24, help="folders changed since then stay")
    options = parser.parse_args(arguments)
    compact_tables(build_session("traffic-compact"), options.tables, options.before, options.settle_hours)


if __name__ == "__main__":
    main()
