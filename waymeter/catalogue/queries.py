"""The named queries. Each takes (spark, folder of parquet tables) and returns a DataFrame.

Timestamps come out as zone-free UTC and doubles rounded to six digits, so that another engine's
answer can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.config import StreamConfig
from waymeter.functions.congestion import STABLE_DIGITS
from waymeter.functions.text import ISO_UTC
from waymeter.jobs import backfill as B
from waymeter.operators import alerts as A
from waymeter.operators import hourly as H
from waymeter.operators import messages as M
from waymeter.operators import windows as W
from waymeter.operators.parts import window_parts, windows_of_parts
from waymeter.plans import nightly as N
from waymeter.plans import reports as R
from waymeter.schemas import ALERT_MESSAGE, EVENTS, HOURLY_VOLUME_BY_DAY, READING_MESSAGE
from waymeter.session import new_run_folder
from waymeter.sinks.files import write_csv, write_daily_report, write_lines, write_windows
from waymeter.sources import tables as T
from waymeter.sources.events import events_between, read_events, readings_from_events, stream_events
from waymeter.sources.replay import replay_messages
from waymeter.sources.state import current_windows
from waymeter.streaming import queries as Q
from waymeter.streaming.batch_sinks import table_sink
from waymeter.streaming.counts import BatchCounts, read_batch_counts
from waymeter.streaming.late import start_split_windows

Query = Callable[[SparkSession, str], DataFrame]

REPORT_DAY = "2024-01-15"
LOCAL_ZONE = "Asia/Colombo"
ONCE = {"availableNow": True}
# Means often lie exactly between two roundings, where the order of adding would decide; lifts them off.
NUDGE = 1e-9


def _comparable(rows: DataFrame) -> DataFrame:
    def plain(name: str, kind: str) -> Column:
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        if kind == "double":
            return (F.round(F.col(name) + NUDGE, STABLE_DIGITS) + F.lit(0.0)).alias(name)
        return F.col(name)

    return rows.select(*[plain(name, kind) for name, kind in rows.dtypes])


def _query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # The text and truncation of timestamps is defined in UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _comparable(build(spark, folder))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    return run


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_from_events(read_events(spark, folder))


def _windows(spark: SparkSession, folder: str) -> DataFrame:
    return W.congestion_windows(_readings(spark, folder))


def _hourly(spark: SparkSession, folder: str) -> DataFrame:
    return H.hourly_rollup(_windows(spark, folder))


def _peaks(spark: SparkSession, folder: str) -> DataFrame:
    return H.peak_hours(_hourly(spark, folder))


def _windows_of_day(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of one day. Windows divide a day evenly, so the events can be cut at its bounds."""
    events = events_between(read_events(spark, folder), REPORT_DAY, "2024-01-16")
    return H.windows_of_day(W.congestion_windows(readings_from_events(events)), REPORT_DAY)


# Messages ---------------------------------------------------------------------------------------


def _as_messages(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "key", F.col("value").cast("binary").alias("value"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("timestamp"),
    )


def encode_readings(spark, folder):
    encoded = M.encode_readings(_readings(spark, folder))
    return encoded.select("key", F.from_json("value", READING_MESSAGE).alias("data")).select(
        "key", "data.*"
    )


def decode_readings(spark, folder):
    messages = _as_messages(M.encode_readings(_readings(spark, folder)))
    return M.decode_readings(messages).select(
        "sensor_id", "junction_name", "event_time", "vehicle_count", "avg_speed", "is_critical",
        "kafka_ts",
    )


def _mixed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """A message per event, sound or faulty by the kind of event; the event's time is the broker's."""
    readings = _readings(spark, folder)
    sensor, count = F.col("sensor_id"), F.col("vehicle_count").cast("string")
    event = F.col("event_id").cast("string")
    sent_at = F.date_format("event_time", ISO_UTC)
    kind = F.col("event_type")

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])

    sound = M.reading_json()
    value = (
        F.when(kind == "click", text("not json ", event))
        .when(kind == "error", text('[{"sensor_id":"', sensor, '"},{"sensor_id":"', sensor, '"}]'))
        .when(kind == "purchase",
              text('{"sensor_id":"', sensor, '","timestamp":"junk ', event, '","vehicle_count":', count, "}"))
        .when(kind == "view",
              text('{"sensor_id":"', sensor, '","timestamp":"', sent_at,
                   '","vehicle_count":"', count, '","avg_speed":"9","lane":1}'))
        .otherwise(sound)
    )
    return readings.select(
        sensor.alias("key"), value.cast("binary").alias("value"), F.col("event_time").alias("timestamp")
    )


def decode_bad_json(spark, folder):
    return M.decode_readings(_mixed_messages(spark, folder)).drop("timestamp")


def bad_records(spark, folder):
    return M.bad_records(M.decode_messages(_mixed_messages(spark, folder)))


def critical_flag(spark, folder):
    return A.critical_flag(_readings(spark, folder)).select("event_id", "avg_speed", "is_critical")


def time_of_day_factor(spark, folder):
    return A.time_of_day_factor(_readings(spark, folder)).select(
        "event_id", "hour", "factor", "normal_count"
    )


# Alerts -----------------------------------------------------------------------------------------


def critical_alerts(spark, folder):
    return A.critical_alerts(_readings(spark, folder))


def alerts_stored(spark, folder):
    return A.alerts_stored(A.critical_alerts(_readings(spark, folder)))


def alert_payload(spark, folder):
    sent = M.alert_messages(A.critical_alerts(_readings(spark, folder)))
    return sent.select("key", F.from_json("value", ALERT_MESSAGE).alias("data")).select("key", "data.*")


def alert_lines(spark, folder):
    return A.critical_readings(_readings(spark, folder)).select(
        "event_id", R.alert_text(F.col("event_time")).alias("line")
    )


def alert_lines_local(spark, folder):
    return A.critical_readings(_readings(spark, folder)).select(
        "event_id", R.alert_text(F.col("event_time"), LOCAL_ZONE).alias("line")
    )


# Windows ----------------------------------------------------------------------------------------


def congestion_windows(spark, folder):
    return _windows(spark, folder)


def congestion_stored(spark, folder):
    return W.congestion_stored(_windows(spark, folder))


# Hours ------------------------------------------------------------------------------------------


def hourly_rollup(spark, folder):
    return H.order_rollup(_hourly(spark, folder))


def hourly_rollup_local(spark, folder):
    return H.order_rollup(H.hourly_rollup(_windows(spark, folder), LOCAL_ZONE))


def hourly_rollup_day(spark, folder):
    return H.order_rollup(H.hourly_rollup(_windows_of_day(spark, folder)))


def rollup_stats(spark, folder):
    return H.rollup_stats(_hourly(spark, folder))


def peak_hours(spark, folder):
    return _peaks(spark, folder)


def peak_hours_local(spark, folder):
    return N.nightly_peaks(_windows(spark, folder), tz=LOCAL_ZONE)


def interventions(spark, folder):
    return H.interventions(_peaks(spark, folder))


def daily_peak_report(spark, folder):
    return N.nightly_report(_windows(spark, folder))


# Reports ----------------------------------------------------------------------------------------


def volume_table(spark, folder):
    return R.order_volume(R.volume_table(_hourly(spark, folder)))


def peak_volume(spark, folder):
    return R.peak_volume(R.volume_table(_hourly(spark, folder))).orderBy("day", "sensor_id")


def chart_series(spark, folder):
    table = R.volume_table(_hourly(spark, folder))
    return R.chart_points(R.chart_series(table)).drop("day", "sensor_id")


def peak_lines(spark, folder):
    return R.peak_lines(_peaks(spark, folder))


def intervention_lines(spark, folder):
    return R.intervention_lines(H.interventions(_peaks(spark, folder)))


def intervention_summary(spark, folder):
    return R.intervention_summary(H.interventions(_peaks(spark, folder)))


def nightly_text_report(spark, folder):
    report = N.nightly_report(_windows_of_day(spark, folder), REPORT_DAY)
    return R.nightly_text_report(report, REPORT_DAY).select("section", "sensor_id", "line_no", "line")


def summary_text_report(spark, folder):
    hourly = H.hourly_rollup(_windows_of_day(spark, folder))
    events = events_between(read_events(spark, folder), REPORT_DAY, "2024-01-16")
    return R.summary_text_report(
        R.peak_volume(R.volume_table(hourly)),
        A.critical_alerts(readings_from_events(events)),
        H.interventions(H.peak_hours(hourly)),
        REPORT_DAY,
    ).select("section", "at", "sensor_id", "line_no", "line")


# Sinks: written and read back -------------------------------------------------------------------


def csv_roundtrip(spark, folder):
    path = new_run_folder(spark, "volume-csv")
    table = R.volume_table(_hourly(spark, folder))
    write_csv(R.order_volume(table.select(*HOURLY_VOLUME_BY_DAY.fieldNames())), path)
    return spark.read.schema(HOURLY_VOLUME_BY_DAY).csv(path, header=True)


def text_roundtrip(spark, folder):
    path = new_run_folder(spark, "peak-text")
    write_lines(R.peak_lines(_peaks(spark, folder)), path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(
        F.count(F.lit(1)).alias("copies")
    )


def nightly_tables(spark, folder):
    """Window table written by date, the day read back with pruning, the daily table written twice."""
    base = new_run_folder(spark, "nightly")
    write_windows(W.congestion_stored(_windows(spark, folder)), f"{base}/congestion_index")
    windows = T.read_windows(spark, f"{base}/congestion_index")
    report = N.nightly_report(windows, REPORT_DAY, LOCAL_ZONE)
    for _ in range(2):
        write_daily_report(report, f"{base}/daily_peak_report", REPORT_DAY)
    return T.read_daily_report(spark, f"{base}/daily_peak_report").drop("created_at")


# Streams: run to the end of the input, then read the table ---------------------------------------


def _stream_setup(spark: SparkSession, label: str) -> tuple[StreamConfig, str]:
    base = new_run_folder(spark, label)
    return StreamConfig(checkpoint_base=f"{base}/checkpoints"), f"{base}/table"


def stream_congestion(spark, folder):
    """Final windows; those the watermark has not passed at the end of the input stay open."""
    config, path = _stream_setup(spark, "congestion")
    readings = readings_from_events(stream_events(spark, folder))
    Q.start_congestion_table(readings, config, path, ONCE).awaitTermination()
    return T.read_windows(spark, path).drop("recorded_at", "window_date")


def backfill_after_stream(spark, folder):
    """The same table after a rebuild of all dates: windows still open are there, and none is there twice."""
    config, path = _stream_setup(spark, "rebuilt")
    readings = readings_from_events(stream_events(spark, folder))
    Q.start_congestion_table(readings, config, path, ONCE).awaitTermination()
    write_windows(W.congestion_stored(_windows(spark, folder)), path)
    return T.read_windows(spark, path).drop("recorded_at", "window_date")


def stream_live(spark, folder):
    """Current state of every window, open ones included."""
    config, path = _stream_setup(spark, "live")
    readings = readings_from_events(stream_events(spark, folder))
    sink = table_sink(path, "window_start", "window_date")
    Q.start_live_congestion(readings, config, sink, ONCE).awaitTermination()
    latest = W.latest_windows(T.read_live_windows(spark, path))
    return latest.drop("recorded_at", "batch_id", "window_date", "batch_key")


def stream_open(spark, folder):
    """Every window, final or open, of the stream of final windows: what is open comes out of its state."""
    config, path = _stream_setup(spark, "open")
    readings = readings_from_events(stream_events(spark, folder))
    Q.start_congestion_table(readings, config, path, ONCE).awaitTermination()
    return current_windows(spark, path, Q.checkpoint_path(spark, config, "congestion"))


def batch_counts(spark, folder):
    """Rows that each query's batches gave, from the stored counts."""
    config, path = _stream_setup(spark, "counts")
    readings = readings_from_events(stream_events(spark, folder))
    counts = BatchCounts(spark, f"{path}-counts")
    spark.streams.addListener(counts)
    try:
        for query in (
            Q.start_congestion_table(readings, config, path, ONCE),
            Q.start_alerts(readings, config, table_sink(f"{path}-alerts", "alert_time", "alert_date"), ONCE),
        ):
            query.awaitTermination()
            counts.wait(query)
    finally:
        spark.streams.removeListener(counts)
    return read_batch_counts(spark, f"{path}-counts").groupBy("query", "metric").agg(F.sum("rows").alias("rows"))


def backfill_messages(spark, folder):
    """The window table rebuilt for two dates from messages, as a topic holds them; other dates stay as streamed."""
    config, path = _stream_setup(spark, "from-topic")
    readings = readings_from_events(stream_events(spark, folder))
    Q.start_congestion_table(readings, config, f"{path}/congestion_index", ONCE).awaitTermination()
    messages = _as_messages(M.encode_readings(_readings(spark, folder)))
    B.backfill_messages(messages, path, ["2024-01-29", "2024-01-30"])
    return T.read_windows(spark, f"{path}/congestion_index").drop("recorded_at", "window_date")


def _out_of_order(spark: SparkSession, folder: str) -> str:
    """Three batches, ten days each; every twentieth reading comes with the last. Returns the folder of the tables."""
    config, tables = _stream_setup(spark, "late")
    arrivals, events = new_run_folder(spark, "arrivals"), read_events(spark, folder)
    delayed = F.col("event_id") % 20 == 0
    first, second = (F.lit(day).cast("timestamp") for day in ("2024-01-11", "2024-01-21"))
    batch = F.when(delayed | (F.col("ts") >= second), 2).when(F.col("ts") >= first, 1).otherwise(0)
    spark.createDataFrame([], EVENTS).write.parquet(arrivals)
    for number in range(3):
        events.filter(batch == number).write.mode("append").parquet(arrivals)
        readings = readings_from_events(spark.readStream.schema(EVENTS).parquet(arrivals))
        start_split_windows(readings, config, tables, ONCE).awaitTermination()
    return tables


def stream_late(spark, folder):
    """Readings that the watermark had passed, with the watermark they met."""
    late = T.read_late(spark, f"{_out_of_order(spark, folder)}/late_readings")
    return late.drop("recorded_at", "batch_id", "event_date", "batch_key")


def stream_parts(spark, folder):
    """Windows of the readings that came in time, added up from the batches' parts."""
    parts = T.read_parts(spark, f"{_out_of_order(spark, folder)}/congestion_parts")
    return W.congestion_stored(windows_of_parts(parts))


def late_balance(spark, folder):
    """Per sensor: readings and vehicles that were counted, that came late, and both, which is all there are."""
    tables = _out_of_order(spark, folder)
    counted = T.read_parts(spark, f"{tables}/congestion_parts").select("sensor_id", "readings", "total_vehicles", F.lit(0).alias("late"))
    late = T.read_late(spark, f"{tables}/late_readings").select(
        "sensor_id", F.lit(1).alias("readings"), F.col("vehicle_count").alias("total_vehicles"), F.lit(1).alias("late"))
    total = lambda name, kind: F.coalesce(F.sum(F.when(F.col("late") == kind, F.col(name))), F.lit(0)).cast("bigint")
    return counted.unionByName(late).groupBy("sensor_id").agg(
        total("readings", 0).alias("counted"), total("readings", 1).alias("late"), F.sum("readings").alias("readings"),
        total("total_vehicles", 0).alias("counted_vehicles"), total("total_vehicles", 1).alias("late_vehicles"),
        F.sum("total_vehicles").alias("vehicles"))


def late_amended(spark, folder):
    """The same windows with the late readings added: those of all readings."""
    tables = _out_of_order(spark, folder)
    added = window_parts(T.read_late(spark, f"{tables}/late_readings"))
    parts = T.read_parts(spark, f"{tables}/congestion_parts").select(*added.columns).unionByName(added)
    return W.congestion_stored(windows_of_parts(parts))


def stream_hourly(spark, folder):
    """Hours that the watermark has passed, each once."""
    config, path = _stream_setup(spark, "hours")
    readings = readings_from_events(stream_events(spark, folder))
    Q.start_hours(readings, config, path, trigger=ONCE).awaitTermination()
    return H.order_rollup(T.read_hours(spark, path).drop("hour_start", "hour_end", "hour_date", "recorded_at"))


def stream_hourly_local(spark, folder):
    """The same in a half-hour zone, whose hours begin half an hour apart from those of UTC."""
    config, path = _stream_setup(spark, "hours-local")
    readings = readings_from_events(stream_events(spark, folder))
    Q.start_hours(readings, config, path, LOCAL_ZONE, ONCE).awaitTermination()
    return H.order_rollup(T.read_hours(spark, path).drop("hour_start", "hour_end", "hour_date", "recorded_at"))


def report_from_hours(spark, folder):
    """The nightly answer of every closed day from the stream's hour table."""
    config, path = _stream_setup(spark, "hours-report")
    readings = readings_from_events(stream_events(spark, folder))
    Q.start_hours(readings, config, path, trigger=ONCE).awaitTermination()
    return N.report_of_hours(T.read_hours(spark, path))


def stream_daily_peaks(spark, folder):
    """Days that the watermark has passed, closed by the stream itself."""
    config, path = _stream_setup(spark, "peaks")
    readings = readings_from_events(stream_events(spark, folder))
    Q.start_daily_peaks(readings, config, path, LOCAL_ZONE, ONCE).awaitTermination()
    return T.read_daily_peaks(spark, path).drop("created_at")


def stream_alerts(spark, folder):
    config, path = _stream_setup(spark, "alerts")
    readings = readings_from_events(stream_events(spark, folder))
    sink = table_sink(path, "alert_time", "alert_date")
    Q.start_alerts(readings, config, sink, ONCE).awaitTermination()
    return T.read_alerts(spark, path).drop(
        "processing_time", "created_at", "batch_id", "alert_date", "batch_key"
    )


def _archived(spark: SparkSession, folder: str) -> str:
    """Sound and faulty messages replayed from files by one query into its two tables."""
    config, path = _stream_setup(spark, "archive")
    topic = new_run_folder(spark, "messages")
    _mixed_messages(spark, folder).select(F.col("value").cast("string")).write.text(topic)
    decoded = M.decode_messages(replay_messages(spark, topic))
    Q.start_archive(decoded, config, path, ONCE).awaitTermination()
    return path


def replay_decode(spark, folder):
    """Messages replayed from files into the raw archive."""
    return T.read_raw(spark, f"{_archived(spark, folder)}/traffic_raw").drop("ingested_at", "batch_key")


def replay_quarantine(spark, folder):
    """The unusable ones of the same messages."""
    return T.read_quarantine(spark, f"{_archived(spark, folder)}/quarantine").drop("kafka_ts", "arrival_date", "batch_key")


QUERIES: dict[str, Query] = {
    build.__name__: _query(build)
    for build in (
        decode_readings, decode_bad_json, bad_records, encode_readings, critical_flag,
        time_of_day_factor, critical_alerts, alerts_stored, alert_payload, alert_lines,
        alert_lines_local, congestion_windows, congestion_stored, hourly_rollup,
        hourly_rollup_local, hourly_rollup_day, rollup_stats, peak_hours, peak_hours_local,
        interventions, daily_peak_report, volume_table, peak_volume, chart_series, peak_lines,
        intervention_lines, intervention_summary, nightly_text_report, summary_text_report,
        csv_roundtrip, text_roundtrip, nightly_tables, stream_congestion, backfill_after_stream, stream_live,
        stream_open, batch_counts, backfill_messages, stream_late, stream_parts, late_balance, late_amended, stream_hourly, stream_hourly_local, report_from_hours, stream_daily_peaks, stream_alerts, replay_decode, replay_quarantine,
    )
}
