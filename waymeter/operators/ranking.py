"""Top row per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The whole first row of each group.

    Spark keeps only each task's best row per key before the shuffle (WindowGroupLimit), so a hot
    group sends at most one row per map task.
    """
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
