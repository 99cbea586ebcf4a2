"""File tables and reports. Batch writes are rebalanced, so file counts follow data size."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.operators.windows import with_recorded_at


#: Key of the folder, one per date, that a backfill of the window table owns.
BACKFILL = "backfill"


def _write_partitions(rows: DataFrame, path: str, *columns: str) -> None:
    """Replace exactly the partitions that `rows` touches.

    The rebalance brings one partition's rows together, and AQE splits the large ones again, so a
    busy date is written by many tasks and a quiet one leaves no crumbs.
    """
    (
        rows.hint("rebalance", *[F.col(name) for name in columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_windows(stored: DataFrame, path: str) -> None:
    """Backfill of the window table, beside what streams wrote there.

    An earlier backfill of a written date is replaced. Streamed rows stay, and `read_windows` takes the newest
    row of a window, which is the rebuilt one.
    """
    dated = with_recorded_at(stored).withColumns({
        "batch_id": F.lit(None).cast("bigint"), "window_date": F.to_date("window_start"), "batch_key": F.lit(BACKFILL),
    })
    _write_partitions(dated, path, "window_date", "batch_key")


def write_daily_report(report: DataFrame, path: str, day: str | None = None) -> None:
    """Replace the rows of `day`, or of every day in `report`; a second run changes nothing.

    A named day is replaced even when it has no rows, so an earlier answer cannot survive it.
    """
    clocked = report.withColumn("created_at", F.current_timestamp())
    if day is not None and date.fromisoformat(day).isoformat() != day:
        raise ValueError(f"a day is written as 2025-07-15, not {day!r}")
    if day is None:
        _write_partitions(clocked, path, "report_date")
        return
    of_day = clocked.filter(F.col("report_date") == F.lit(day).cast("date")).drop("report_date")
    of_day.write.mode("overwrite").parquet(f"{path}/report_date={day}")


def write_csv(table: DataFrame, path: str) -> None:
    """CSV with a header; an ordered table stays ordered over its files' names."""
    table.write.mode("overwrite").option("header", True).csv(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """The `line` column as text files, whose names sort in report order."""
    lines.select("line").write.mode("overwrite").text(path)
