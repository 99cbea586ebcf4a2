"""Append to a JDBC table from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waymeter.config import JdbcConfig
from waymeter.sources.jdbc import jdbc_options


def jdbc_write_options(config: JdbcConfig, table: str) -> dict[str, str]:
    """`numPartitions` bounds the connections: Spark merges partitions above it."""
    return {**jdbc_options(config, table), "batchsize": str(config.batch_size)}


def append_table(rows: DataFrame, config: JdbcConfig, table: str) -> None:
    rows.write.format("jdbc").options(**jdbc_write_options(config, table)).mode("append").save()
