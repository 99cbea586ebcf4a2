"""Raw readings, in files or still in the topic, to the window table: the stream's transforms as one batch.

    spark-submit --py-files waymeter.zip waymeter/jobs/backfill.py --raw <folder> --tables <folder> \\
        [--days 2025-07-01 2025-07-31]

With `--topic` in place of `--raw <folder>` the messages of the dates are read from the topic by their broker times.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, StreamConfig, TrafficConfig, add_options, given
from waymeter.operators.messages import decode_messages, good_records
from waymeter.operators.windows import congestion_stored, congestion_windows
from waymeter.session import build_session
from waymeter.sinks.files import write_windows
from waymeter.sources.kafka import read_messages
from waymeter.sources.tables import read_raw


def refuse_uneven_windows(spark: SparkSession, window: str) -> None:
    length = spark.range(1).select(F.unix_micros(F.expr(f"timestamp_seconds(0) + INTERVAL '{window}'"))).first()[0]
    if length <= 0 or 86_400_000_000 % length:
        raise ValueError(f"windows of {window} do not divide a date")


def backfill_windows(raw: DataFrame, tables: str, days: list[str] | None = None,
                     rules: TrafficConfig = DEFAULTS) -> None:
    """Rebuild the windows of whole UTC dates, from `days[0]` to `days[1]` inclusive, or of all.

    Dates are those of the archive's partitions. A window that does not divide a date
    evenly would be cut at its edges and is refused.
    """
    refuse_uneven_windows(raw.sparkSession, rules.window)
    if days is not None:
        first, last = (F.lit(day).cast("date") for day in days)
        raw = raw.filter(F.col("event_date").between(first, last))
    write_windows(congestion_stored(congestion_windows(raw, rules)), f"{tables}/congestion_index")


def backfill_messages(messages: DataFrame, tables: str, days: list[str], rules: TrafficConfig = DEFAULTS) -> None:
    """Rebuild the windows of whole UTC dates from messages: the stream's decoding and windows as one batch.

    The messages must cover the dates in event time. Their broker times reach from the first date on, as a message is
    never older than its reading, to some time after the last for those that came late.
    """
    raw = good_records(decode_messages(messages)).withColumn("event_date", F.to_date("event_time"))
    backfill_windows(raw, tables, days, rules)


def topic_range(days: list[str], grace: timedelta = timedelta(days=1)) -> tuple[str, str]:
    """Broker times that hold the messages of these dates and those that came up to `grace` late."""
    first, last = (datetime.fromisoformat(day) for day in days)
    return first.isoformat(), (last + timedelta(days=1) + grace).isoformat()


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw", help="folder of the raw archive")
    source.add_argument("--topic", action="store_true", help="read the messages of the dates from the topic instead; needs --days")
    parser.add_argument("--grace-hours", type=float, default=24.0, help="how long after the last date messages are still read from the topic")
    parser.add_argument("--tables", required=True, help="folder of the file tables")
    parser.add_argument("--days", nargs=2, metavar=("FIRST", "LAST"), help="UTC dates to rebuild")
    add_options(parser, TrafficConfig)
    options = parser.parse_args(arguments)
    if options.topic and not options.days:
        parser.error("--topic needs --days")
    rules = TrafficConfig(**given(options, TrafficConfig))
    spark = build_session("traffic-backfill")
    if options.topic:
        start, end = topic_range(options.days, timedelta(hours=options.grace_hours))
        backfill_messages(read_messages(spark, StreamConfig.from_env(), start, end), options.tables, options.days, rules)
        return
    backfill_windows(read_raw(spark, options.raw), options.tables, options.days, rules)


if __name__ == "__main__":
    main()
