"""Every schema, declared once. Nothing in the engine infers a schema."""

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


SPEED = T.DecimalType(6, 2)
# Wider than a two-decimal percentage needs: the index is not limited, so busy windows pass 10,000.
INDEX = T.DecimalType(12, 2)

# The JSON message of a sensor.
READING_MESSAGE = _struct(
    ("sensor_id", T.StringType(), True),
    ("junction_name", T.StringType(), True),
    ("timestamp", T.StringType(), True),
    ("vehicle_count", T.IntegerType(), True),
    ("avg_speed", T.DoubleType(), True),
    ("is_critical", T.BooleanType(), True),
)

# The JSON message of a critical alert.
ALERT_MESSAGE = _struct(
    ("sensor_id", T.StringType(), True),
    ("junction_name", T.StringType(), True),
    ("alert_time", T.StringType(), True),
    ("avg_speed", T.DoubleType(), True),
    ("vehicle_count", T.IntegerType(), True),
    ("severity", T.StringType(), True),
)

# A message as a topic delivers it.
RAW_MESSAGE = _struct(
    ("key", T.BinaryType(), True),
    ("value", T.BinaryType(), True),
    ("timestamp", T.TimestampType(), True),
)

TRAFFIC_RAW = _struct(
    ("sensor_id", T.StringType(), False),
    ("junction_name", T.StringType(), True),
    ("event_time", T.TimestampType(), False),
    ("vehicle_count", T.IntegerType(), True),
    ("avg_speed", T.DoubleType(), True),
    ("is_critical", T.BooleanType(), True),
    ("ingested_at", T.TimestampType(), True),
)

# What a batch of a query gave, read and dropped.
BATCH_COUNTS = _struct(
    ("query", T.StringType(), True),
    ("query_id", T.StringType(), False),
    ("run_id", T.StringType(), False),
    ("batch_id", T.LongType(), False),
    ("metric", T.StringType(), False),
    ("rows", T.LongType(), True),
    ("input_rows", T.LongType(), True),
    ("dropped_rows", T.LongType(), True),
    ("at", T.TimestampType(), True),
)

# What one batch of readings adds to a window.
CONGESTION_PARTS = _struct(
    ("sensor_id", T.StringType(), False),
    ("junction_name", T.StringType(), True),
    ("window_start", T.TimestampType(), False),
    ("window_end", T.TimestampType(), False),
    ("speed_sum", T.DoubleType(), True),
    ("speeds", T.LongType(), True),
    ("total_vehicles", T.LongType(), True),
    ("counts", T.LongType(), True),
    ("readings", T.LongType(), True),
    ("recorded_at", T.TimestampType(), True),
)

# Readings whose window had ended by the watermark they met.
LATE_READINGS = _struct(
    ("sensor_id", T.StringType(), False),
    ("junction_name", T.StringType(), True),
    ("event_time", T.TimestampType(), False),
    ("vehicle_count", T.IntegerType(), True),
    ("avg_speed", T.DoubleType(), True),
    ("is_critical", T.BooleanType(), True),
    ("watermark", T.TimestampType(), True),
    ("recorded_at", T.TimestampType(), True),
)

# Messages no window can count, with their raw text.
QUARANTINE = _struct(
    ("json_str", T.StringType(), True),
    ("kafka_ts", T.TimestampType(), True),
    ("sensor_id", T.StringType(), True),
    ("timestamp", T.StringType(), True),
)

CONGESTION_INDEX = _struct(
    ("sensor_id", T.StringType(), False),
    ("junction_name", T.StringType(), True),
    ("window_start", T.TimestampType(), False),
    ("window_end", T.TimestampType(), False),
    ("mean_speed_kmph", SPEED, True),
    ("total_vehicles", T.LongType(), True),
    ("congestion_index", INDEX, True),
    ("congestion_level", T.StringType(), True),
    ("recorded_at", T.TimestampType(), True),
)

CRITICAL_ALERTS = _struct(
    ("sensor_id", T.StringType(), False),
    ("junction_name", T.StringType(), True),
    ("avg_speed", SPEED, True),
    ("vehicle_count", T.IntegerType(), True),
    ("alert_time", T.TimestampType(), True),
    ("processing_time", T.TimestampType(), True),
    ("severity", T.StringType(), True),
    ("acknowledged", T.BooleanType(), True),
    ("created_at", T.TimestampType(), True),
)

# Hours as a stream closes them; `hour_slot` is the wall-clock hour of the zone they were cut in.
HOURLY_ROLLUP = _struct(
    ("sensor_id", T.StringType(), False),
    ("junction_name", T.StringType(), True),
    ("hour_start", T.TimestampType(), False),
    ("hour_end", T.TimestampType(), False),
    ("hour_slot", T.TimestampType(), False),
    ("avg_speed", T.DoubleType(), True),
    ("total_vehicles", T.LongType(), True),
    ("avg_ci", T.DoubleType(), True),
    ("recorded_at", T.TimestampType(), True),
)

DAILY_PEAK_REPORT = _struct(
    ("report_date", T.DateType(), False),
    ("sensor_id", T.StringType(), False),
    ("junction_name", T.StringType(), True),
    ("peak_hour", T.IntegerType(), True),
    ("total_vehicles", T.LongType(), True),
    ("avg_speed", SPEED, True),
    ("avg_ci", INDEX, True),
    ("peak_hour_label", T.StringType(), True),
    ("needs_police", T.BooleanType(), True),
    ("reason", T.StringType(), True),
    ("created_at", T.TimestampType(), True),
)

# Hourly volume per junction on one day; the day itself is not a column of the CSV report.
HOURLY_VOLUME = _struct(
    ("sensor_id", T.StringType(), True),
    ("junction_name", T.StringType(), True),
    ("hour", T.IntegerType(), True),
    ("hour_label", T.StringType(), True),
    ("total_vehicles", T.LongType(), True),
    ("avg_speed_kmph", T.DoubleType(), True),
    ("congestion_index", T.DoubleType(), True),
    ("congestion_level", T.StringType(), True),
)

HOURLY_VOLUME_BY_DAY = T.StructType(HOURLY_VOLUME.fields + [T.StructField("day", T.DateType(), True)])

# The generic event table that stands in for a sensor feed. Its zone-free times mean UTC: declared as
# instants they are taken from the file as they are, with no conversion per row.
EVENTS = _struct(
    ("event_id", T.LongType(), True),
    ("ts", T.TimestampType(), True),
    ("user_id", T.LongType(), True),
    ("event_type", T.StringType(), True),
    ("value", T.DoubleType(), True),
    ("props", T.StringType(), True),
)
