"""The streaming application: topic in; window table, alert table and alert topic out.

    spark-submit --packages <kafka connector>[,<jdbc driver>] --py-files waymeter.zip \\
        waymeter/jobs/stream.py --tables <folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from waymeter.config import JdbcConfig, StreamConfig, TrafficConfig, add_options, given
from waymeter.operators.messages import decode_messages
from waymeter.session import STREAM_SETTINGS, build_session
from waymeter.sinks.upsert import ALERTS, WINDOWS, jdbc_run, prepare, upsert_sink
from waymeter.sources.kafka import stream_messages
from waymeter.streaming.batch_sinks import BatchSink, alert_topic_sink, jdbc_sink, table_sink
from waymeter.streaming.counts import BatchCounts
from waymeter.streaming.late import start_split_windows
from waymeter.streaming.queries import start_alerts, start_all, start_archive, start_congestion_sink


def database_sinks(spark: SparkSession, database: JdbcConfig, append_only: bool) -> tuple[BatchSink, BatchSink]:
    """Sinks of the window and the alert table: exactly once through a ledger, or plain appends."""
    if append_only:
        return jdbc_sink(database, WINDOWS.name), jdbc_sink(database, ALERTS.name)
    prepare(jdbc_run(spark, database), WINDOWS, ALERTS)
    return upsert_sink(database, WINDOWS), upsert_sink(database, ALERTS)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", help="folder of the file tables; without it, JDBC tables are used")
    parser.add_argument("--append-only", action="store_true", help="append to JDBC tables without staging: at least once")
    parser.add_argument("--live", action="store_true", help="store every change of open windows too")
    parser.add_argument("--archive", help="folder of raw readings and bad messages; by default that of the tables")
    parser.add_argument("--keep-late", action="store_true", help="windows in parts too, and readings that come too late for them in a table of their own")
    parser.add_argument("--hours", metavar="ZONE", help="close hours and daily peaks of this zone too, to the tables hourly_rollup and daily_peaks")
    parser.add_argument("--no-archive", action="store_true", help="keep neither")
    add_options(parser, StreamConfig)
    add_options(parser, TrafficConfig)
    options = parser.parse_args(arguments)
    if options.live and not options.tables:
        parser.error("--live needs --tables")
    if (options.hours or options.keep_late) and not options.tables:
        parser.error("--hours and --keep-late need --tables")
    archive = None if options.no_archive else options.archive or options.tables
    if archive is None and not options.no_archive:
        parser.error("without --tables name an --archive folder, or give --no-archive")

    config = StreamConfig.from_env(rules=TrafficConfig(**given(options, TrafficConfig)), **given(options, StreamConfig))
    spark = build_session("traffic-stream", STREAM_SETTINGS)
    if options.tables:
        spark.streams.addListener(BatchCounts(spark, f"{options.tables}/batch_counts", every=20))
    messages = stream_messages(spark, config)
    topic = alert_topic_sink(config)
    if options.tables:
        alerts = table_sink(f"{options.tables}/critical_alerts", "alert_time", "alert_date", config.writers)
        live = None
        if options.live:
            live = table_sink(f"{options.tables}/congestion_live", "window_start", "window_date", config.writers)
        start_all(messages, config, options.tables, alerts, live, archive, topic, options.hours)
        if options.keep_late:
            start_split_windows(decode_messages(messages).drop("json_str"), config, options.tables)
    else:
        database = JdbcConfig.from_env()
        decoded = decode_messages(messages)
        readings = decoded.drop("json_str")
        windows, alerts = database_sinks(spark, database, options.append_only)
        start_congestion_sink(readings, config, windows)
        start_alerts(readings, config, alerts, topic=topic)
        if archive:
            start_archive(decoded, config, archive)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
