"""Late readings in a table of their own: the same rows as Spark's aggregate drops, over failures and restarts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_streams import LATE_COUNTED, LATE_DROPPED, ONCE, Topic, message, minute_totals, readings, run

from waymeter.config import StreamConfig, TrafficConfig
from waymeter.operators.parts import merged_parts, split_late, window_parts, windows_of_parts
from waymeter.operators.windows import congestion_windows
from waymeter.sources.events import read_events, readings_from_events
from waymeter.sources.tables import read_late, read_parts, read_windows
from waymeter.streaming import late as L
from waymeter.streaming import queries as Q


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


@pytest.fixture
def config(tmp_path):
    return StreamConfig(checkpoint_base=f"{tmp_path}/checkpoints")


def late_rows(spark, tables):
    return sorted((r.event_time.strftime("%H:%M:%S"), r.vehicle_count, r.watermark.strftime("%H:%M:%S"), r.batch_id)
                  for r in read_late(spark, f"{tables}/late_readings").collect())


def counted(spark, tables):
    return minute_totals(windows_of_parts(read_parts(spark, f"{tables}/congestion_parts")).orderBy("window_start").collect())


@pytest.mark.parametrize("files, late, windows", [
    (LATE_COUNTED, [], [("08:00", 129), ("08:05", 6), ("08:20", 1)]),
    (LATE_DROPPED, [("08:01:00", 99, "08:06:00", 3)], [("08:00", 10), ("08:05", 8)]),
])
def test_the_rows_that_the_aggregate_drops(spark, topic, config, tmp_path, files, late, windows):
    topic.add_readings(files)
    run(L.start_split_windows(readings(spark, topic), config, f"{tmp_path}/t", ONCE))
    assert late_rows(spark, f"{tmp_path}/t") == late and counted(spark, f"{tmp_path}/t") == windows
    query = run(Q.start_congestion_table(readings(spark, topic), config, f"{tmp_path}/own", ONCE))
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress)
    assert dropped == len(late)
    closed = minute_totals(read_windows(spark, f"{tmp_path}/own").orderBy("window_start").collect())
    assert closed == windows[: len(closed)] and closed


def test_restarts_keep_the_watermark(spark, topic, config, tmp_path):
    for rows in LATE_DROPPED:
        topic.add_readings([rows])
        run(L.start_split_windows(readings(spark, topic), config, f"{tmp_path}/t", ONCE))
    assert late_rows(spark, f"{tmp_path}/t") == [("08:01:00", 99, "08:06:00", 3)]
    assert counted(spark, f"{tmp_path}/t") == [("08:00", 10), ("08:05", 8)]
    ledger = next((tmp_path / "t" / "watermarks").iterdir())
    assert len(list(ledger.glob("slot=*"))) == L.SLOTS


@pytest.mark.parametrize("step", ["late_readings", "watermarks"])
def test_a_replayed_batch_replaces_itself(spark, topic, config, tmp_path, monkeypatch, step):
    """The batch with the late reading dies before its late table, or before its ledger entry, and runs again."""
    topic.add_readings(LATE_DROPPED)
    tables, failed = f"{tmp_path}/t", []

    def fail_once(batch_id):
        if batch_id == 3 and not failed:
            failed.append(step)
            raise ConnectionError("the driver is gone")

    if step == "watermarks":
        plain = L.WatermarkLedger.enter
        monkeypatch.setattr(L.WatermarkLedger, "enter", lambda self, batch_id, at: (fail_once(batch_id), plain(self, batch_id, at)))
    else:
        plain = L.table_sink

        def sinks(path, *args):
            sink = plain(path, *args)
            return (lambda batch, batch_id: (fail_once(batch_id), sink(batch, batch_id))) if path.endswith(step) else sink

        monkeypatch.setattr(L, "table_sink", sinks)
    with pytest.raises(Exception, match="the driver is gone"):
        L.start_split_windows(readings(spark, topic), config, tables, ONCE).awaitTermination(120)
    run(L.start_split_windows(readings(spark, topic), config, tables, ONCE))
    assert failed == [step] and late_rows(spark, tables) == [("08:01:00", 99, "08:06:00", 3)]
    assert counted(spark, tables) == [("08:00", 10), ("08:05", 8)]


def test_a_lost_ledger_stops_the_stream(spark, topic, config, tmp_path):
    """Counting on without a watermark would take late rows for others."""
    topic.add_readings(LATE_DROPPED[:2])
    run(L.start_split_windows(readings(spark, topic), config, f"{tmp_path}/t", ONCE))
    ledger = next((tmp_path / "t" / "watermarks").iterdir())
    for slot in ledger.glob("slot=1/*.parquet"):
        slot.unlink()
    topic.add_readings(LATE_DROPPED[2:])
    with pytest.raises(Exception, match="no watermark of batch 1"):
        L.start_split_windows(readings(spark, topic), config, f"{tmp_path}/t", ONCE).awaitTermination(120)


def test_unusable_readings_are_neither_counted_nor_late(spark, topic, config, tmp_path):
    topic.add(message("08:00:10", 10, 20.0), "not json", '{"sensor_id":"J1","timestamp":"junk"}')
    topic.add("nothing")
    run(L.start_split_windows(readings(spark, topic), config, f"{tmp_path}/t", ONCE))
    assert counted(spark, f"{tmp_path}/t") == [("08:00", 10)]


def test_every_reading_is_on_one_side(spark):
    events = readings_from_events(read_events(spark, "/root/testdata/sf0.01"))
    rows = events.unionByName(events.limit(50).withColumn("event_time", F.lit(None).cast("timestamp")))
    on_time, late = split_late(rows, F.lit(datetime(2024, 1, 10, 12, 3)))
    # A row without a time is in no window.
    assert on_time.count() + late.count() == events.count() and late.count() > 0
    assert late.where("event_time >= TIMESTAMP '2024-01-10 12:00:00'").count() == 0
    assert on_time.where("event_time < TIMESTAMP '2024-01-10 12:00:00'").count() == 0
    assert split_late(events, F.lit(None).cast("timestamp"))[1].count() == 0


@pytest.mark.parametrize("volume", ["sum", "avg"])
def test_parts_add_up_to_windows(spark, volume):
    rules = TrafficConfig(volume=volume)
    events = readings_from_events(read_events(spark, "/root/testdata/sf0.01")).withColumn(
        "avg_speed", F.expr("CASE WHEN event_id % 3 <> 0 THEN avg_speed END")).withColumn(
        "vehicle_count", F.expr("CASE WHEN event_id % 5 <> 0 THEN vehicle_count END"))
    batches = [window_parts(events.filter(F.col("event_id") % 4 == k), rules) for k in range(4)]
    parts = batches[0]
    for more in batches[1:]:
        parts = parts.unionByName(more)
    assert parts.count() > merged_parts(parts).count()
    digits = lambda df: sorted(str(r) for r in df.select(*[
        F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect())
    assert digits(windows_of_parts(parts, rules)) == digits(congestion_windows(events, rules))
