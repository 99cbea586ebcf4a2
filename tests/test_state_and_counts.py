"""Open windows out of a stream's state, stored batch counts, and rebuilds from a topic."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_streams import LATE_COUNTED, LATE_DROPPED, ONCE, Topic, minute_totals, readings, run

from waymeter.config import StreamConfig, TrafficConfig
from waymeter.jobs import backfill as B
from waymeter.operators.windows import congestion_windows
from waymeter.sources.kafka import kafka_batch_options
from waymeter.sources.state import current_windows, open_windows
from waymeter.sources.tables import read_windows
from waymeter.streaming import queries as Q
from waymeter.streaming.batch_sinks import table_sink
from waymeter.streaming.counts import BatchCounts, read_batch_counts


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


@pytest.fixture
def config(tmp_path):
    return StreamConfig(checkpoint_base=f"{tmp_path}/checkpoints")


@pytest.mark.parametrize("volume", ["sum", "avg"])
def test_open_and_final_windows_are_all_windows(spark, topic, config, tmp_path, volume):
    config = replace(config, rules=TrafficConfig(volume=volume))
    table, checkpoint = f"{tmp_path}/t", Q.checkpoint_path(spark, config, "congestion")
    for files in (LATE_COUNTED[:2], LATE_COUNTED[2:]):
        topic.add_readings(files)
        run(Q.start_congestion_table(readings(spark, topic), config, table, ONCE))
    assert minute_totals(read_windows(spark, table).orderBy("window_start").collect()) == [("08:00", 129), ("08:05", 6)]
    still_open = open_windows(spark, checkpoint, config.rules)
    assert minute_totals(still_open.collect()) == [("08:20", 1)]
    messages = spark.read.text(str(topic.folder)).select(F.col("value").cast("binary").alias("value"), F.lit(None).cast("timestamp").alias("timestamp"))
    batch = congestion_windows(B.good_records(B.decode_messages(messages)), config.rules)
    assert still_open.columns == batch.columns
    digits = lambda df: sorted(map(str, df.select([F.round(c, 6) if t == "double" else c for c, t in df.dtypes]).collect()))
    assert digits(still_open) == digits(batch.filter("minute(window_start) = 20"))
    current = current_windows(spark, table, checkpoint, config.rules)
    assert minute_totals(current.orderBy("window_start").collect()) == [("08:00", 129), ("08:05", 6), ("08:20", 1)]


def test_open_windows_follow_each_batch(spark, topic, config, tmp_path):
    seen = []
    for rows in LATE_DROPPED:
        topic.add_readings([rows])
        run(Q.start_congestion_table(readings(spark, topic), config, f"{tmp_path}/t", ONCE))
        seen.append(minute_totals(open_windows(spark, Q.checkpoint_path(spark, config, "congestion")).orderBy("window_start").collect()))
    assert seen == [[("08:00", 10)], [("08:05", 5)], [("08:05", 6)], [("08:05", 7)], [("08:05", 8)]]


def test_a_window_that_closed_in_between_counts_once(spark, topic, config, tmp_path):
    topic.add_readings(LATE_COUNTED)
    run(Q.start_congestion_table(readings(spark, topic), config, f"{tmp_path}/t", ONCE))
    live = replace(config, checkpoint_base=f"{tmp_path}/other")
    topic_of_two = Topic(tmp_path / "two")
    topic_of_two.add_readings(LATE_COUNTED[:2])  # a state in which 08:00 is open with fewer vehicles
    run(Q.start_congestion_table(readings(spark, topic_of_two), live, f"{tmp_path}/unused", ONCE))
    rows = current_windows(spark, f"{tmp_path}/t", Q.checkpoint_path(spark, live, "congestion")).orderBy("window_start").collect()
    assert minute_totals(rows) == [("08:00", 129), ("08:05", 6)]


@pytest.mark.parametrize("every", [1, 100])
def test_counts_of_every_batch_are_stored(spark, topic, config, tmp_path, every):
    topic.add_readings(LATE_DROPPED)
    counts, path = BatchCounts(spark, f"{tmp_path}/counts", every), f"{tmp_path}/counts"
    spark.streams.addListener(counts)
    try:
        sink = table_sink(f"{tmp_path}/alerts", "alert_time", "alert_date")
        for query in (Q.start_congestion_table(readings(spark, topic), config, f"{tmp_path}/t", ONCE),
                      Q.start_alerts(readings(spark, topic), config, sink, ONCE)):
            query.awaitTermination(120)
            counts.wait(query)
    finally:
        spark.streams.removeListener(counts)
    rows = read_batch_counts(spark, path)
    by_query = {r.query: (r.rows, r.read, r.dropped) for r in rows.groupBy("query").agg(
        F.sum("rows").alias("rows"), F.sum("input_rows").alias("read"), F.sum("dropped_rows").alias("dropped")).collect()}
    assert by_query == {"congestion": (read_windows(spark, f"{tmp_path}/t").count(), 6, 1), "critical": (1, 6, 0)}
    assert rows.filter("query = 'critical'").orderBy("batch_id").select("rows").toPandas()["rows"].tolist() == [0, 0, 0, 1, 0]
    # A batch that reports again counts once.
    spark.read.parquet(path).withColumn("run_id", F.lit("later")).write.mode("append").partitionBy("count_date").parquet(f"{tmp_path}/again")
    spark.read.parquet(path).write.mode("append").partitionBy("count_date").parquet(f"{tmp_path}/again")
    assert read_batch_counts(spark, f"{tmp_path}/again").count() == rows.count()


def test_waiting_for_a_query_that_goes_on(spark, topic, config, tmp_path):
    topic.add_readings(LATE_COUNTED[:1])
    counts = BatchCounts(spark, f"{tmp_path}/counts")
    query = Q.start_congestion_table(readings(spark, topic), config, f"{tmp_path}/t", {"processingTime": "0 seconds"})
    try:
        with pytest.raises(TimeoutError, match="congestion"):
            counts.wait(query, 0.1)
    finally:
        query.stop()


def test_options_of_a_bounded_read():
    options = kafka_batch_options(StreamConfig(max_offsets_per_trigger=5, min_partitions=8), "2025-07-15", "2025-07-16T05:30:00+05:30")
    assert options == {
        "kafka.bootstrap.servers": "kafka:9092", "subscribe": "traffic-raw", "failOnDataLoss": "false", "minPartitions": "8",
        "startingTimestamp": "1752537600000", "endingTimestamp": "1752624000000", "startingOffsetsByTimestampStrategy": "latest",
    }
    with pytest.raises(ValueError, match="is not before"):
        kafka_batch_options(StreamConfig(), "2025-07-16", "2025-07-16")
    assert B.topic_range(["2025-07-15", "2025-07-16"]) == ("2025-07-15T00:00:00", "2025-07-18T00:00:00")
    with pytest.raises(SystemExit):
        B.main(["--topic", "--tables", "/t"])
    with pytest.raises(SystemExit):
        B.main(["--topic", "--raw", "/r", "--tables", "/t"])


def test_a_rebuild_from_messages_equals_the_stream(spark, topic, config, tmp_path):
    """Messages as the topic holds them, faulty and foreign dates among them: only the named date is rebuilt."""
    tables = f"{tmp_path}/tables"
    topic.add_readings(LATE_COUNTED)
    run(Q.start_congestion_table(readings(spark, topic), config, f"{tables}/congestion_index", ONCE))
    streamed = read_windows(spark, f"{tables}/congestion_index").drop("recorded_at").collect()
    other = json.dumps({"sensor_id": "J1", "junction_name": "A", "timestamp": "2025-07-16T08:00:00Z", "vehicle_count": 5, "avg_speed": 9.0})
    topic.add("not json", other, '{"sensor_id":"J1"}')
    messages = spark.read.text(str(topic.folder)).select(F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))
    B.backfill_messages(messages, tables, ["2025-07-15", "2025-07-15"])
    rebuilt = read_windows(spark, f"{tables}/congestion_index")
    assert minute_totals(rebuilt.orderBy("window_start").collect()) == [("08:00", 129), ("08:05", 6), ("08:20", 1)]
    closed = [r.window_start for r in streamed]
    assert sorted(rebuilt.filter(F.col("window_start").isin(closed)).drop("recorded_at").collect()) == sorted(streamed)
