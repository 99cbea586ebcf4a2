"""A folder of JSON-lines files in the shape of a topic, for replays and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replay_messages(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Each line is a message; the file's time stands for the broker's."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )
