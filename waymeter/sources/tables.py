"""Stored tables in files, read with their declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.operators.ranking import first_per_group
from waymeter.operators.windows import latest_windows
from waymeter.schemas import (
    CONGESTION_INDEX,
    CONGESTION_PARTS,
    CRITICAL_ALERTS,
    DAILY_PEAK_REPORT,
    HOURLY_ROLLUP,
    LATE_READINGS,
    QUARANTINE,
    TRAFFIC_RAW,
)


def _with(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    known = set(schema.fieldNames())
    extra = [T.StructField(name, kind, True) for name, kind in fields if name not in known]
    return T.StructType(schema.fields + extra)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The window table, one row per window: streams and backfills may both have written it."""
    return latest_windows(read_live_windows(spark, path)).drop("batch_id", "batch_key")


def read_live_windows(spark: SparkSession, path: str) -> DataFrame:
    """Every stored change of every window; `latest_windows` gives the current state."""
    fields = [("batch_id", T.LongType()), ("window_date", T.DateType()), ("batch_key", T.StringType())]
    return spark.read.schema(_with(CONGESTION_INDEX, *fields)).parquet(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    fields = [("batch_id", T.LongType()), ("alert_date", T.DateType()), ("batch_key", T.StringType())]
    return spark.read.schema(_with(CRITICAL_ALERTS, *fields)).parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    fields = [("event_date", T.DateType())]
    return spark.read.schema(_with(TRAFFIC_RAW, *fields)).parquet(path)


def read_daily_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DAILY_PEAK_REPORT).parquet(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """Every part of every window; `windows_of_parts` adds them up."""
    fields = [("batch_id", T.LongType()), ("window_date", T.DateType()), ("batch_key", T.StringType())]
    return spark.read.schema(_with(CONGESTION_PARTS, *fields)).parquet(path)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    fields = [("batch_id", T.LongType()), ("event_date", T.DateType()), ("batch_key", T.StringType())]
    return spark.read.schema(_with(LATE_READINGS, *fields)).parquet(path)


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The hour table of a stream, one row per hour: a new checkpoint may have written some again."""
    fields = [("hour_date", T.DateType()), ("batch_key", T.StringType())]
    rows = spark.read.schema(_with(HOURLY_ROLLUP, *fields)).parquet(path)
    order = [F.col(name).desc_nulls_last() for name in ("recorded_at", "total_vehicles")]
    return first_per_group(rows, ["sensor_id", "junction_name", "hour_slot", "hour_date"], order).drop("batch_key")


def read_daily_peaks(spark: SparkSession, path: str) -> DataFrame:
    """The daily table as a stream closes its days, one row per day and sensor."""
    fields = [("batch_key", T.StringType())]
    rows = spark.read.schema(_with(DAILY_PEAK_REPORT, *fields)).parquet(path)
    order = [F.col("created_at").desc_nulls_last(), F.col("total_vehicles").desc_nulls_last()]
    return first_per_group(rows, ["report_date", "sensor_id"], order).drop("batch_key")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE).parquet(path)
