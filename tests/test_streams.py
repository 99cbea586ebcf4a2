"""Streams by file replay: what each batch emits, late data, restarts and replays."""

import json
import os
import time
from datetime import datetime
from pathlib import Path

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from waymeter.config import StreamConfig
from waymeter.operators.messages import alert_messages, decode_messages
from waymeter.operators.windows import congestion_stored, congestion_windows, latest_windows
from waymeter.sources.replay import replay_messages
from waymeter.sources.tables import (
    read_alerts,
    read_live_windows,
    read_quarantine,
    read_raw,
    read_windows,
)
from waymeter.streaming import queries as Q
from waymeter.sinks.files import write_windows
from waymeter.streaming.batch_sinks import fan_out, spread, table_sink

ONCE = {"availableNow": True}
# One list per file: (time of day, vehicles, speed).
LATE_COUNTED = [
    [("08:00:10", 10, 20.0)], [("08:04:50", 20, 30.0)], [("08:08:00", 5, 40.0)],
    [("08:01:00", 99, 1.0), ("08:08:30", 1, 40.0)], [("08:20:00", 1, 40.0)],
]
LATE_DROPPED = [
    [("08:00:10", 10, 20.0)], [("08:08:00", 5, 40.0)], [("08:08:10", 1, 40.0)],
    [("08:01:00", 99, 1.0), ("08:08:30", 1, 40.0)], [("08:09:00", 1, 40.0)],
]


def message(clock, vehicles, speed):
    return json.dumps({
        "sensor_id": "J1", "junction_name": "A", "timestamp": f"2025-07-15T{clock}.000000Z",
        "vehicle_count": vehicles, "avg_speed": speed, "is_critical": speed < 10,
    })


class Topic:
    """A folder to which files of messages are added, oldest first."""

    def __init__(self, folder: Path):
        self.folder = folder
        self.count = 0
        folder.mkdir()

    def add(self, *texts: str) -> None:
        self.count += 1
        path = self.folder / f"{self.count:04d}.json"
        path.write_text("".join(text + "\n" for text in texts))
        moment = time.time() - 1000 + self.count
        os.utime(path, (moment, moment))

    def add_readings(self, files) -> None:
        for rows in files:
            self.add(*[message(*row) for row in rows])


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


@pytest.fixture
def config(tmp_path):
    at_once = "0 seconds"
    return StreamConfig(
        checkpoint_base=f"{tmp_path}/checkpoints", congestion_trigger=at_once,
        critical_trigger=at_once, archive_trigger=at_once,
    )


def decoded(spark, topic):
    return decode_messages(replay_messages(spark, str(topic.folder), files_per_batch=1))


def readings(spark, topic):
    return decoded(spark, topic).drop("json_str")


def run(query):
    query.awaitTermination(120)
    assert not query.isActive
    return query


def minute_totals(rows):
    return [(row.window_start.strftime("%H:%M"), row.total_vehicles) for row in rows]


@pytest.mark.parametrize("files, dropped, updates, final", [
    (LATE_COUNTED, 0,
     [("08:00", 10), ("08:00", 30), ("08:05", 5), ("08:00", 129), ("08:05", 6), ("08:20", 1)],
     [("08:00", 129), ("08:05", 6)]),
    (LATE_DROPPED, 1,
     [("08:00", 10), ("08:05", 5), ("08:05", 6), ("08:05", 7), ("08:05", 8)],
     [("08:00", 10)]),
])
def test_updates_and_final_windows(spark, topic, config, tmp_path, files, dropped, updates, final):
    topic.add_readings(files)
    live, table = f"{tmp_path}/live", f"{tmp_path}/final"
    sink = table_sink(live, "window_start", "window_date")
    run(Q.start_live_congestion(readings(spark, topic), config, sink, ONCE))
    query = run(Q.start_congestion_table(readings(spark, topic), config, table, ONCE))
    counts = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress]
    assert sum(counts) == dropped

    changes = read_live_windows(spark, live)
    in_order = changes.orderBy("batch_id", "window_start").collect()
    assert minute_totals(in_order) == updates
    assert minute_totals(read_windows(spark, table).orderBy("window_start").collect()) == final
    newest = latest_windows(changes).orderBy("window_start").collect()
    assert minute_totals(newest) == sorted(dict(updates).items())


def test_alerts_ignore_the_watermark(spark, topic, config, tmp_path):
    topic.add_readings(LATE_DROPPED)
    sink = table_sink(f"{tmp_path}/alerts", "alert_time", "alert_date")
    query = run(Q.start_alerts(readings(spark, topic), config, sink, ONCE))
    rows = read_alerts(spark, f"{tmp_path}/alerts").collect()
    assert [(row.vehicle_count, row.batch_id, row.severity, row.acknowledged) for row in rows] == [
        (99, 3, "CRITICAL", False)]
    assert rows[0].processing_time is not None
    counted = [p["observedMetrics"]["alert_rows"]["rows"] for p in query.recentProgress]
    assert sum(counted) == 1


def test_batch_gives_the_same_windows(spark, topic, config, tmp_path):
    topic.add_readings(LATE_COUNTED)
    run(Q.start_congestion_table(readings(spark, topic), config, f"{tmp_path}/t", ONCE))
    streamed = read_windows(spark, f"{tmp_path}/t").drop("recorded_at", "window_date")
    values = spark.read.text(str(topic.folder)).select(
        F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))
    batch = congestion_stored(congestion_windows(decode_messages(values)))
    closed = batch.filter(F.col("window_end") <= F.lit(datetime(2025, 7, 15, 8, 18)))
    assert sorted(streamed.collect()) == sorted(closed.collect())


def test_restart_goes_on_from_the_checkpoint(spark, topic, config, tmp_path):
    table, live = f"{tmp_path}/t", f"{tmp_path}/live"
    sink = table_sink(live, "window_start", "window_date")
    for files in (LATE_COUNTED[:2], LATE_COUNTED[2:]):
        topic.add_readings(files)
        run(Q.start_congestion_table(readings(spark, topic), config, table, ONCE))
        run(Q.start_live_congestion(readings(spark, topic), config, sink, ONCE))
    rows = read_windows(spark, table).orderBy("window_start").collect()
    assert minute_totals(rows) == [("08:00", 129), ("08:05", 6)]
    newest = latest_windows(read_live_windows(spark, live)).orderBy("window_start").collect()
    assert minute_totals(newest) == [("08:00", 129), ("08:05", 6), ("08:20", 1)]


def test_a_new_checkpoint_does_not_overwrite_old_batches(spark, topic, tmp_path):
    topic.add_readings(LATE_COUNTED[3:4])
    sink = table_sink(f"{tmp_path}/alerts", "alert_time", "alert_date")
    for name in ("one", "two"):
        config = StreamConfig(checkpoint_base=f"{tmp_path}/{name}")
        run(Q.start_alerts(readings(spark, topic), config, sink, ONCE))
    assert read_alerts(spark, f"{tmp_path}/alerts").select("batch_key").distinct().count() == 2


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    sink = table_sink(f"{tmp_path}/alerts", "alert_time", "alert_date")
    alerts = spark.createDataFrame(
        [("J1", "A", datetime(2025, 7, 15, 8)), ("J2", "B", datetime(2025, 7, 16, 8))],
        "sensor_id string, junction_name string, alert_time timestamp")
    for batch_id in (0, 1, 1):
        sink(alerts, batch_id)
    assert read_alerts(spark, f"{tmp_path}/alerts").count() == 4
    sink(alerts.limit(0), 2)
    assert read_alerts(spark, f"{tmp_path}/alerts").count() == 4


def test_fan_out_computes_a_batch_once(spark, topic, config):
    topic.add_readings(LATE_COUNTED)
    seen = []
    sink = fan_out(
        lambda batch, batch_id: seen.append(("rows", batch_id, batch.storageLevel.useMemory)),
        lambda batch, batch_id: seen.extend(
            ("sent", batch_id, json.loads(row.value)["vehicle_count"]) for row in alert_messages(batch).collect()),
    )
    run(Q.start_alerts(readings(spark, topic), config, sink, ONCE))
    assert ("sent", 3, 99) in seen
    assert all(item[2] for item in seen if item[0] == "rows")


def test_archive_and_quarantine_share_out_the_messages(spark, topic, config, tmp_path):
    topic.add(message("08:00:10", 10, 20.0), "not json")
    topic.add('{"sensor_id":"J2","timestamp":"junk"}', "")
    run(Q.start_archive(decoded(spark, topic), config, str(tmp_path), ONCE))
    raw = read_raw(spark, f"{tmp_path}/traffic_raw").collect()
    assert [(row.sensor_id, row.vehicle_count, str(row.avg_speed)) for row in raw] == [("J1", 10, "20.0")]
    bad = {row.json_str: row.sensor_id for row in read_quarantine(spark, f"{tmp_path}/quarantine").collect()}
    assert bad == {"not json": None, '{"sensor_id":"J2","timestamp":"junk"}': "J2", "": None}


def test_all_queries_run_side_by_side(spark, topic, config, tmp_path):
    topic.add_readings(LATE_COUNTED)
    tables = f"{tmp_path}/tables"
    started = Q.start_all(
        replay_messages(spark, str(topic.folder), files_per_batch=1), config, tables,
        table_sink(f"{tables}/critical_alerts", "alert_time", "alert_date"),
        table_sink(f"{tables}/congestion_live", "window_start", "window_date"), archive=tables,
    )
    try:
        assert [query.name for query in started] == [
            "congestion", "critical", "congestion-live", "archive"]
        for query in started:
            query.processAllAvailable()
            assert query.exception() is None
    finally:
        for query in started:
            query.stop()
    assert read_alerts(spark, f"{tables}/critical_alerts").count() == 1
    assert read_raw(spark, f"{tables}/traffic_raw").count() == 6
    assert minute_totals(read_windows(spark, f"{tables}/congestion_index").orderBy("window_start").collect())[0] == (
        "08:00", 129)


def test_a_batch_leaves_few_files(spark, topic, config, tmp_path):
    topic.add(*[message(f"08:{m:02d}:10", 1, 20.0) for m in range(0, 60, 5)])
    topic.add(message("10:00:00", 1, 20.0))
    run(Q.start_congestion_table(readings(spark, topic), replace(config, writers=2), f"{tmp_path}/t", ONCE))
    batches = [list(folder.glob("*.parquet")) for folder in (tmp_path / "t").glob("*/*")]
    assert batches and all(1 <= len(files) <= 2 for files in batches)
    assert read_windows(spark, f"{tmp_path}/t").count() == 12


def test_stream_backfill_and_a_new_checkpoint_share_one_table(spark, topic, config, tmp_path):
    """No row is lost and none doubled, whichever wrote first."""
    table = f"{tmp_path}/t"
    topic.add(message("08:00:10", 10, 20.0), message("08:20:00", 1, 40.0))
    run(Q.start_congestion_table(readings(spark, topic), config, table, ONCE))
    streamed = read_windows(spark, table).count()
    rebuilt = congestion_stored(congestion_windows(readings_as_batch(spark, topic)))
    write_windows(rebuilt, table)
    assert read_windows(spark, table).count() == rebuilt.count() > streamed
    topic.add(message("09:00:00", 5, 20.0), message("09:30:00", 1, 20.0))
    fresh = replace(config, checkpoint_base=f"{tmp_path}/other-checkpoints")
    run(Q.start_congestion_table(readings(spark, topic), fresh, table, ONCE))
    starts = [row.window_start for row in read_windows(spark, table).collect()]
    assert len(starts) == len(set(starts)) == 3
    write_windows(rebuilt, table)
    assert read_windows(spark, table).count() == 3


def readings_as_batch(spark, topic):
    rows = spark.read.text(str(topic.folder)).select(F.col("value").cast("binary"), F.lit(None).cast("timestamp").alias("timestamp"))
    return decode_messages(rows).drop("json_str")


def test_topic_gets_the_speed_as_it_was_read(spark, topic, config, tmp_path):
    """A speed just below the limit stays below it; NaN is no speed and no alert."""
    topic.add(message("08:00:10", 10, 9.996), message("08:00:20", 10, float("nan")))
    sent = []
    sink = table_sink(f"{tmp_path}/a", "alert_time", "alert_date")
    run(Q.start_alerts(readings(spark, topic), config, sink, ONCE, lambda batch, _: sent.extend(alert_messages(batch).collect())))
    assert [json.loads(row.value)["avg_speed"] for row in sent] == [9.996]
    assert [str(row.avg_speed) for row in read_alerts(spark, f"{tmp_path}/a").collect()] == ["10.00"]


def test_one_busy_date_fills_all_writers_evenly(spark):
    rows = spark.range(4000).selectExpr("concat('J', id) AS sensor_id")
    sizes = [row["count"] for row in spread(rows, ["sensor_id"], 16).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.5 * min(sizes)
