"""The streaming queries: windows (final or live), alerts, raw archive, quarantine.

Each takes decoded readings, so a topic, a file replay and a table are interchangeable sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from waymeter.config import StreamConfig
from waymeter.functions.times import UTC
from waymeter.operators.alerts import (
    alerts_stored,
    critical_alerts,
    with_created_at,
    with_processing_time,
)
from waymeter.operators.hourly import daily_peak_report
from waymeter.operators.hours import hours_of_readings, peaks_of_readings
from waymeter.operators.messages import bad_records, decode_messages, good_records, with_watermark
from waymeter.operators.windows import (
    congestion_stored,
    congestion_windows,
    with_recorded_at,
)
from waymeter.session import scheduler_pool, shared_folder
from waymeter.streaming.batch_sinks import BatchSink, fan_out, table_sink


def checkpoint_path(spark: SparkSession, config: StreamConfig, name: str) -> str:
    """One checkpoint per query below the configured base or the session's shared folder."""
    base = config.checkpoint_base or shared_folder(spark)
    return f"{base.rstrip('/')}/{name}"


def writer(rows: DataFrame, config: StreamConfig, name: str, mode: str,
            trigger: dict[str, object]) -> DataStreamWriter:
    return (
        rows.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint_path(rows.sparkSession, config, name))
        .trigger(**trigger)
    )


def _rows_counted(rows: DataFrame, name: str) -> DataFrame:
    """Row counts per batch in the query's progress, without a second run of the plan."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"))


def started(made: DataStreamWriter, rows: DataFrame, config: StreamConfig, name: str, sink: BatchSink) -> StreamingQuery:
    """The query at work, in the scheduler pool of its name."""
    with scheduler_pool(rows.sparkSession, config.pool_prefix + name):
        return made.foreachBatch(sink).start()


def stored_windows(readings: DataFrame, config: StreamConfig) -> DataFrame:
    windows = congestion_windows(with_watermark(readings, config.rules), config.rules)
    return with_recorded_at(congestion_stored(windows))


def alert_rows(readings: DataFrame, config: StreamConfig) -> DataFrame:
    """Alerts of known sensors with the speed as it was read."""
    return with_processing_time(critical_alerts(readings, config.rules)).filter(F.col("sensor_id").isNotNull())


def stored_alert_sink(sink: BatchSink) -> BatchSink:
    """A table of alerts: their speed takes the table's type here, and nowhere before."""
    return lambda batch, batch_id: sink(with_created_at(alerts_stored(batch)), batch_id)


def _congestion_writer(rows: DataFrame, config: StreamConfig, trigger: dict | None) -> DataStreamWriter:
    return writer(rows, config, "congestion", "append",
                   trigger or {"processingTime": config.congestion_trigger})


def start_congestion_table(readings: DataFrame, config: StreamConfig, path: str,
                           trigger: dict | None = None) -> StreamingQuery:
    """Final windows, one row each once the watermark has passed them, to a file table by date.

    A replayed batch replaces itself, and a new checkpoint adds under keys of its own: the table has no sink
    log that would skip them or hide what a backfill writes.
    """
    sink = table_sink(path, "window_start", "window_date", config.writers)
    return start_congestion_sink(readings, config, sink, trigger)


def start_congestion_sink(readings: DataFrame, config: StreamConfig, sink: BatchSink,
                          trigger: dict | None = None) -> StreamingQuery:
    """Final windows to any batch sink, such as a JDBC table."""
    rows = _rows_counted(stored_windows(readings, config), "congestion_rows")
    return started(_congestion_writer(rows, config, trigger), rows, config, "congestion", sink)


def start_live_congestion(readings: DataFrame, config: StreamConfig, sink: BatchSink,
                          trigger: dict | None = None) -> StreamingQuery:
    """Every change of every open window (update mode); read through `latest_windows`."""
    rows = _rows_counted(stored_windows(readings, config), "live_rows")
    made = writer(rows, config, "congestion-live", "update",
                     trigger or {"processingTime": config.congestion_trigger})
    return started(made, rows, config, "congestion-live", sink)


def start_hours(readings: DataFrame, config: StreamConfig, path: str, tz: str = UTC, trigger: dict | None = None) -> StreamingQuery:
    """Hours, once each when the watermark has passed them, to a file table by their local date."""
    hours = hours_of_readings(with_watermark(readings, config.rules), config.rules, tz)
    rows = _rows_counted(with_recorded_at(hours), "hour_rows")
    made = writer(rows, config, "hours", "append", trigger or {"processingTime": config.rollup_trigger})
    return started(made, rows, config, "hours", table_sink(path, "hour_slot", "hour_date", config.writers))


def start_daily_peaks(readings: DataFrame, config: StreamConfig, path: str, tz: str = UTC,
                      trigger: dict | None = None) -> StreamingQuery:
    """The daily report's rows, once each when the watermark has passed their day."""
    peaks = peaks_of_readings(with_watermark(readings, config.rules), config.rules, tz)
    rows = _rows_counted(with_created_at(daily_peak_report(peaks, config.rules)), "peak_rows")
    made = writer(rows, config, "daily-peaks", "append", trigger or {"processingTime": config.rollup_trigger})
    return started(made, rows, config, "daily-peaks", table_sink(path, "report_date", "report_date", config.writers))


def start_alerts(readings: DataFrame, config: StreamConfig, sink: BatchSink, trigger: dict | None = None,
                 topic: BatchSink | None = None) -> StreamingQuery:
    """Alerts at once and without state: late readings alert too.

    `sink` takes the rows of the alert table, `topic` the alerts with the speed as it was read.
    """
    rows = _rows_counted(alert_rows(readings, config), "alert_rows")
    sink = fan_out(stored_alert_sink(sink), *([topic] if topic else []))
    made = writer(rows, config, "critical", "append",
                     trigger or {"processingTime": config.critical_trigger})
    return started(made, rows, config, "critical", sink)


def raw_rows(decoded: DataFrame) -> DataFrame:
    return good_records(decoded).select(
        "sensor_id",
        "junction_name",
        "event_time",
        "vehicle_count",
        "avg_speed",
        F.coalesce(F.col("is_critical"), F.lit(False)).alias("is_critical"),
        F.current_timestamp().alias("ingested_at"),
    )


def start_archive(decoded: DataFrame, config: StreamConfig, folder: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """One query, one decode: usable readings to `folder`/traffic_raw by the date of the reading, unusable messages
    with their raw text to `folder`/quarantine by the date of their arrival."""
    raw = table_sink(f"{folder}/traffic_raw", "event_time", "event_date", config.writers)
    bad = table_sink(f"{folder}/quarantine", "kafka_ts", "arrival_date", config.writers, ("json_str",))
    sink = fan_out(lambda batch, batch_id: raw(raw_rows(batch), batch_id), lambda batch, batch_id: bad(bad_records(batch), batch_id))
    made = writer(decoded, config, "archive", "append", trigger or {"processingTime": config.archive_trigger})
    return started(made, decoded, config, "archive", sink)


def start_all(messages: DataFrame, config: StreamConfig, tables: str, alert_sink: BatchSink,
              live_sink: BatchSink | None = None, archive: str | None = None,
              topic: BatchSink | None = None, hours: str | None = None) -> list[StreamingQuery]:
    """The concurrent queries of one application over one source definition; `hours` names the zone of hours and days."""
    decoded = decode_messages(messages)
    readings = decoded.drop("json_str")
    queries = [
        start_congestion_table(readings, config, f"{tables}/congestion_index"),
        start_alerts(readings, config, alert_sink, topic=topic),
    ]
    if live_sink is not None:
        queries.append(start_live_congestion(readings, config, live_sink))
    if archive:
        queries.append(start_archive(decoded, config, archive))
    if hours:
        queries += [
            start_hours(readings, config, f"{tables}/hourly_rollup", hours),
            start_daily_peaks(readings, config, f"{tables}/daily_peaks", hours),
        ]
    return queries
