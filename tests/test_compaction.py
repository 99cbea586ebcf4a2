"""Closed dates of stream tables become few files; a run that dies doubles and loses nothing."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from waymeter.operators.windows import latest_windows
from waymeter.schemas import CONGESTION_INDEX, CRITICAL_ALERTS
from waymeter.sinks import compaction
from waymeter.sinks.compaction import compact
from waymeter.sources.tables import read_alerts, read_live_windows, read_windows


def alerts(spark, path, batches, day="2025-07-01"):
    """Two equal rows a batch, as a stream leaves them."""
    rows = spark.range(2 * batches).select(
        F.lit("J1").alias("sensor_id"), F.lit("Main").alias("junction_name"),
        F.lit(f"{day} 08:00:00").cast("timestamp").alias("alert_time"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in CRITICAL_ALERTS
          if f.name not in ("sensor_id", "junction_name", "alert_time")],
        F.floor(F.col("id") / 2).cast("bigint").alias("batch_id"), F.lit(day).cast("date").alias("alert_date"),
        F.format_string("q-%012d", F.floor(F.col("id") / 2)).alias("batch_key"))
    rows.write.mode("append").partitionBy("alert_date", "batch_key").parquet(path)


def folders(path, day):
    return sorted(x.name for x in Path(path, f"alert_date={day}").iterdir() if x.is_dir())


def counts(spark, path):
    return {str(r[0]): r[1] for r in read_alerts(spark, path).groupBy("alert_date").count().collect()}


def test_two_hundred_batches_become_one_folder(spark, tmp_path):
    path = f"{tmp_path}/t"
    alerts(spark, path, 200)
    alerts(spark, path, 3, "2025-07-02")
    before = counts(spark, path)
    assert compact(spark, path, "alert_date", "2025-07-02", read_alerts, settle_hours=24) == []  # still fresh
    assert compact(spark, path, "alert_date", "2025-07-02", read_alerts, settle_hours=0) == ["2025-07-01"]
    assert counts(spark, path) == before == {"2025-07-01": 400, "2025-07-02": 6}
    assert len(folders(path, "2025-07-01")) == 1 and len(folders(path, "2025-07-02")) == 3
    assert len(list(Path(path, "alert_date=2025-07-01").glob("*/*.parquet"))) <= 2
    assert compact(spark, path, "alert_date", "2025-07-02", read_alerts, settle_hours=0) == []


@pytest.mark.parametrize("step", range(5))
def test_a_run_that_dies_is_finished_by_the_next(spark, tmp_path, monkeypatch, step):
    """Ended before its first, second ... move or deletion; a batch that came meanwhile stays."""
    path = f"{tmp_path}/t"
    alerts(spark, path, 3)
    left = [step]

    def ending(method):
        def run(self, *paths):
            if left[0] == 0:
                raise KeyboardInterrupt
            left[0] -= 1
            if left[0] == 0:  # a late batch, while the job runs
                late = Path(path, "alert_date=2025-07-01", "batch_key=r-1")
                if late.parent.exists() and not late.exists():
                    spark.createDataFrame([("J9",)], "sensor_id string").write.parquet(str(late))
            return method(self, *paths)
        return run

    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(compaction._Folders, "move", ending(compaction._Folders.move))
        patched.setattr(compaction._Folders, "delete", ending(compaction._Folders.delete))
        compact(spark, path, "alert_date", "2025-07-02", read_alerts, settle_hours=0)
        raise KeyboardInterrupt
    compact(spark, path, "alert_date", "2025-07-02", read_alerts, settle_hours=0)
    rows = [r.sensor_id for r in read_alerts(spark, path).collect()]
    assert rows.count("J1") == 6 and rows.count("J9") <= 1
    assert not Path(path, compaction.STAGED).exists() or not list(Path(path, compaction.STAGED).iterdir())


def test_live_windows_keep_their_newest_state_and_backfills_their_folder(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.range(4).select(
        F.lit("J1").alias("sensor_id"), F.lit("Main").alias("junction_name"),
        F.lit("2025-07-01 08:00:00").cast("timestamp").alias("window_start"),
        (F.col("id") + 1).alias("total_vehicles"), F.col("id").alias("batch_id"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in CONGESTION_INDEX
          if f.name not in ("sensor_id", "junction_name", "window_start", "total_vehicles")],
        F.lit("2025-07-01").cast("date").alias("window_date"),
        F.when(F.col("id") == 0, "backfill").otherwise(F.format_string("q-%d", "id")).alias("batch_key"))
    rows.write.partitionBy("window_date", "batch_key").parquet(path)
    compact(spark, path, "window_date", "2025-08-01", read_live_windows, 0, latest_windows)
    assert [r.total_vehicles for r in read_windows(spark, path).collect()] == [4]
    assert sorted(r.total_vehicles for r in read_live_windows(spark, path).collect()) == [1, 4]
    assert Path(path, "window_date=2025-07-01", "batch_key=backfill").exists()
