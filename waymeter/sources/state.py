"""Windows that a running stream still holds open, read from its checkpoint.

The window query writes final windows only. What it holds between batches is read from its state store as a table, so
current values need no second query that stores every change. A read sees the last committed batch; the stream goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.operators.parts import windows_of_parts
from waymeter.operators.windows import congestion_stored
from waymeter.sources.tables import read_windows

# What the window aggregate keeps per window, in the order of its measures: a mean is a sum and a count.
_KEPT = {
    "sum": "struct<speed_sum: double, speeds: bigint, total_vehicles: bigint>",
    "avg": "struct<speed_sum: double, speeds: bigint, total_vehicles: bigint, vehicles: double, counts: bigint>",
}


def open_windows(spark: SparkSession, checkpoint: str, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """Windows in the state of the query with this checkpoint, in the columns of `congestion_windows`.

    `rules` are those the query runs with. Of an append query the windows are those not yet written; each comes once,
    as its key has one row of state.
    """
    state = spark.read.format("statestore").load(checkpoint)
    # Names repeat inside `value`; a cast takes its fields by position.
    kept = state.select("key.*", F.col("value").cast(_KEPT[rules.volume]).alias("kept"))
    parts = kept.select(
        "sensor_id", "junction_name", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "kept.speed_sum", "kept.speeds", "kept.total_vehicles",
        F.col("kept.counts" if rules.volume == "avg" else "kept.speeds").alias("counts"), F.lit(1).alias("readings"))
    return windows_of_parts(parts, rules)


def current_windows(spark: SparkSession, table: str, checkpoint: str, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """Final windows of the table and open ones of the state: every window's newest value.

    The state is read first where both are collected apart; a window that closes in between is then in both, and the
    stored row counts.
    """
    final = read_windows(spark, table).drop("recorded_at", "window_date")
    still_open = congestion_stored(open_windows(spark, checkpoint, rules))
    keys = ["sensor_id", "junction_name", "window_start"]
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    unseen = still_open.alias("o").join(final.select(*keys).alias("f"), same[0] & same[1] & same[2], "left_anti")
    return final.unionByName(unseen)
