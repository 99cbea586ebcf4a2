"""The generic event table read as sensor readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.congestion import is_critical
from waymeter.schemas import EVENTS

# Fixed values of the mapping: eight junctions, speeds below 75 km/h.
JUNCTIONS = 8
SPEED_RANGE = 75


def events_path(folder: str) -> str:
    return f"{folder}/events.parquet"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(events_path(folder))


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    # A stream takes a folder or a pattern; this pattern matches the table, be it a file or a folder.
    return spark.readStream.schema(EVENTS).parquet(f"{folder}/[e]vents.parquet")


def events_between(events: DataFrame, start: str, end: str) -> DataFrame:
    """Events from `start` up to, not with, `end`, compared on the stored column so the scan prunes."""
    lower, upper = (F.lit(edge).cast("timestamp") for edge in (start, end))
    return events.filter((F.col("ts") >= lower) & (F.col("ts") < upper))


def _count_field() -> Column:
    """The integer field `k` of `props`.

    Text that is an object of this one field, the common form, is read by a pattern in a sixth of a
    JSON parser's time; every other text goes to the parser.
    """
    plain = F.regexp_extract("props", r'^\{"k": ?(-?(?:0|[1-9][0-9]{0,8}))\}$', 1).try_cast("int")
    return F.coalesce(plain, F.get_json_object("props", "$.k").try_cast("int"))


def readings_from_events(events: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """The time is read as UTC; the count is the field `k` of the JSON text in `props`.

    `event_id` and `event_type` are passed on; what a query does not use the scan does not read.
    """
    junction = F.col("user_id") % JUNCTIONS + 1
    number = junction.cast("string")
    speed = F.round(F.col("value") % SPEED_RANGE, 2)
    return events.select(
        "event_id",
        "event_type",
        F.concat(F.lit("J"), F.lpad(number, 3, "0")).alias("sensor_id"),
        F.concat(F.lit("Junction "), number).alias("junction_name"),
        F.col("ts").alias("event_time"),
        _count_field().alias("vehicle_count"),
        speed.alias("avg_speed"),
        is_critical(speed, rules).alias("is_critical"),
    )
