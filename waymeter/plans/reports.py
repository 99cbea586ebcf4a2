"""Report tables, chart series and ordered report lines.

Lines carry the columns that order them, so a report is one sorted DataFrame of any length: the sort
is a range shuffle into as many files as its size needs, one for a small report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.congestion import congestion_level
from waymeter.functions.text import (
    hour_label,
    one_decimal,
    padded_name,
    padded_speed,
    whole_number,
)
from waymeter.functions.times import UTC, local_time
from waymeter.operators.ranking import first_per_group

# Fixed values of the report layout.
RULE = "=" * 65
THIN_RULE = "-" * 65
CHART_FIRST_HOUR, CHART_LAST_HOUR = 6, 20
ALERT_NAME_WIDTH = 14
INTERVENTION_NAME_WIDTH = 26

LINE_ORDER = ["section", "at", "sensor_id", "item", "line_no"]


# Tables -----------------------------------------------------------------------------------------


def volume_table(hourly: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """Hourly rows with hour label and level."""
    hour = F.hour("hour_slot")
    return hourly.select(
        "sensor_id",
        "junction_name",
        F.to_date("hour_slot").alias("day"),
        hour.alias("hour"),
        hour_label(hour).alias("hour_label"),
        "total_vehicles",
        F.col("avg_speed").alias("avg_speed_kmph"),
        F.col("avg_ci").alias("congestion_index"),
        congestion_level(F.col("avg_ci"), rules).alias("congestion_level"),
    )


def order_volume(table: DataFrame) -> DataFrame:
    return table.orderBy("day", "sensor_id", "hour", "junction_name")


def peak_volume(table: DataFrame) -> DataFrame:
    """Each sensor's busiest hour per day with its level; of equals the earliest."""
    return first_per_group(
        table.filter(F.col("sensor_id").isNotNull()),
        ["day", "sensor_id"],
        [F.col("total_vehicles").desc_nulls_last(), F.col("hour"), F.col("junction_name")],
    )


def chart_series(
    table: DataFrame, first_hour: int = CHART_FIRST_HOUR, last_hour: int = CHART_LAST_HOUR
) -> DataFrame:
    """One row per day and junction: arrays over a fixed hour axis, null where an hour has no data.

    A group holds at most one entry per hour of the axis, so its arrays stay small at any scale.
    """
    axis = F.sequence(F.lit(first_hour), F.lit(last_hour))
    entry = F.struct("hour", "total_vehicles", "avg_speed_kmph", "congestion_index")
    grouped = (
        table.filter(F.col("hour").between(first_hour, last_hour))
        .groupBy("day", "sensor_id", "junction_name")
        .agg(F.collect_list(entry).alias("entries"))
        .withColumn("by_hour", F.map_from_entries(
            F.transform("entries", lambda e: F.struct(e["hour"], e))
        ))
    )

    def series(name: str) -> Column:
        return F.transform(axis, lambda hour: F.try_element_at(F.col("by_hour"), hour)[name])

    return grouped.select(
        "day",
        "sensor_id",
        "junction_name",
        F.concat_ws(" – ", "sensor_id", "junction_name").alias("label"),
        F.transform(axis, hour_label).alias("hours"),
        series("total_vehicles").alias("vehicles"),
        series("avg_speed_kmph").alias("speed"),
        series("congestion_index").alias("ci"),
    )


def chart_points(series: DataFrame) -> DataFrame:
    """The series as one row per label and hour."""
    zipped = F.arrays_zip("hours", "vehicles", "speed", "ci")
    return series.select("day", "sensor_id", "label", F.explode(zipped).alias("point")).select(
        "day",
        "sensor_id",
        "label",
        F.col("point.hours").alias("hour_label"),
        F.col("point.vehicles").alias("vehicles"),
        F.col("point.speed").alias("speed"),
        F.col("point.ci").alias("ci"),
    )


# Line texts. Their labels, marks and widths are fixed values of the report layout ---------------------


def _text(*parts: Column | str) -> Column:
    """Concatenation that shows a null part as empty."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def peak_texts() -> Column:
    return F.array(
        _text("  ", F.col("sensor_id"), " | ", F.col("junction_name")),
        _text("    Peak Hour  : ", F.col("peak_hour_label")),
        _text("    Vehicles   : ", whole_number(F.col("total_vehicles"))),
        _text("    Avg Speed  : ", one_decimal(F.col("avg_speed")), " km/h"),
        _text("    Cong. Index: ", one_decimal(F.col("avg_ci"))),
    )


def intervention_texts() -> Column:
    return F.array(
        _text("  ⚠  ", F.col("sensor_id"), " — ", F.col("junction_name")),
        _text("      Peak Hour : ", F.col("peak_hour_label")),
        _text("      Reason    : ", F.col("reason")),
    )


def volume_peak_texts() -> Column:
    return F.array(
        _text("  ", F.col("sensor_id"), " | ", F.col("junction_name")),
        _text("    Peak Hour  : ", F.col("hour_label")),
        _text("    Vehicles   : ", whole_number(F.col("total_vehicles"))),
        _text("    Avg Speed  : ", one_decimal(F.col("avg_speed_kmph")), " km/h"),
        _text("    Cong. Index: ", one_decimal(F.col("congestion_index")),
              " (", F.col("congestion_level"), ")"),
    )


def alert_text(event_time: Column, tz: str = UTC) -> Column:
    clock = F.date_format(local_time(event_time, tz), "HH:mm")
    return _text(
        "  ", F.col("sensor_id"), " | ", padded_name(F.col("junction_name"), ALERT_NAME_WIDTH),
        " | ", padded_speed(F.col("avg_speed")), " | ", clock, " | CRITICAL",
    )


def intervention_summary_text(rules: TrafficConfig = DEFAULTS) -> Column:
    return _text(
        "  ⚠  ", F.col("sensor_id"), " — ",
        padded_name(F.col("junction_name"), INTERVENTION_NAME_WIDTH),
        " (Peak CI: ", one_decimal(F.col("avg_ci")), " — ",
        congestion_level(F.col("avg_ci"), rules), ")",
    )


def numbered_lines(rows: DataFrame, texts: Column, *keys: str) -> DataFrame:
    """`keys`, then the row's lines numbered from 1."""
    numbered = F.posexplode(texts).alias("position", "line")
    return rows.select(*keys, numbered).select(
        *keys, (F.col("position") + 1).alias("line_no"), "line"
    )


def peak_lines(peaks: DataFrame) -> DataFrame:
    return numbered_lines(peaks, peak_texts(), "day", "sensor_id")


def intervention_lines(flagged: DataFrame) -> DataFrame:
    return numbered_lines(flagged, intervention_texts(), "day", "sensor_id")


def intervention_summary(flagged: DataFrame, rules: TrafficConfig = DEFAULTS) -> DataFrame:
    return flagged.select("day", "sensor_id", intervention_summary_text(rules).alias("line"))


# Whole reports ----------------------------------------------------------------------------------


def _section(number: int, texts: list[str], when: Column | None = None) -> Column:
    """Fixed lines of one section as structs, or no lines where `when` is false."""
    lines = F.array(*[
        F.struct(F.lit(number).alias("section"), F.lit(i).alias("line_no"), F.lit(text).alias("line"))
        for i, text in enumerate(texts)
    ])
    return lines if when is None else F.when(when, lines).otherwise(F.filter(lines, lambda _: F.lit(False)))


def _fixed_lines(counts: DataFrame, *sections: Column) -> DataFrame:
    """Headers and 'no data' lines from a one-row DataFrame of counts."""
    return counts.select(F.inline(F.concat(*sections))).select(
        "section",
        F.lit(None).cast("timestamp").alias("at"),
        F.lit(None).cast("string").alias("sensor_id"),
        F.lit(None).cast("string").alias("item"),
        "line_no",
        "line",
    )


def _item_lines(
    rows: DataFrame, section: int, texts: Column, at: Column | None = None, spaced: bool = True
) -> DataFrame:
    """Lines of every row, with a blank line after each row where `spaced`."""
    whole = F.concat(texts, F.array(F.lit(""))) if spaced else texts
    when = F.lit(None).cast("timestamp") if at is None else at
    prepared = rows.select(
        F.lit(section).alias("section"), when.alias("at"), "sensor_id",
        F.col("junction_name").alias("item"), F.posexplode(whole).alias("line_no", "line"),
    )
    return prepared


def nightly_text_report(report: DataFrame, day: str, title: str = "TRAFFIC REPORT",
                        source: str = "nightly traffic report") -> DataFrame:
    """The day's ordered lines from the rows of the daily peak table.

    Read `report` from the stored table: it feeds two branches, which then cost two small scans.
    """
    counts = report.agg(
        F.count(F.lit(1)).alias("peaks"), F.count_if("needs_police").alias("flagged")
    )
    # Headings are fixed values of the report layout.
    fixed = _fixed_lines(
        counts,
        _section(0, [RULE, f"  {title} — {day}", f"  Generated by: {source}", RULE, "",
                     "PEAK TRAFFIC HOURS PER JUNCTION", THIN_RULE]),
        _section(1, ["  No data available for today."], F.col("peaks") == 0),
        _section(2, ["", "POLICE INTERVENTION RECOMMENDED TOMORROW", THIN_RULE]),
        _section(3, ["  ✓ No junctions require police intervention tomorrow."], F.col("flagged") == 0),
        _section(4, [RULE, "  END OF REPORT", RULE]),
    )
    peaks = _item_lines(report, 1, peak_texts())
    flagged = _item_lines(report.filter("needs_police"), 3, intervention_texts())
    return fixed.unionByName(peaks).unionByName(flagged).orderBy(*LINE_ORDER)


def summary_text_report(volume_peaks: DataFrame, alerts: DataFrame, flagged: DataFrame, day: str,
                        tz: str = UTC, title: str = "TRAFFIC CONGESTION SUMMARY",
                        rules: TrafficConfig = DEFAULTS) -> DataFrame:
    """The day's ordered lines: busiest hours, critical alerts, interventions."""
    one_row = volume_peaks.sparkSession.range(1)
    # Headings are fixed values of the report layout.
    fixed = _fixed_lines(
        one_row,
        _section(0, [RULE, f"  {title} — {day}", RULE, "",
                     "PEAK HOURS (highest vehicle count per junction):", THIN_RULE]),
        _section(2, [f"CRITICAL ALERTS (avg_speed < {rules.critical_speed:g} km/h):", THIN_RULE]),
        _section(4, ["", "POLICE INTERVENTION REQUIRED TOMORROW:", THIN_RULE]),
        _section(6, ["", RULE, "  END OF REPORT", RULE]),
    )
    peaks = _item_lines(volume_peaks, 1, volume_peak_texts())
    critical = _item_lines(
        alerts, 3, F.array(alert_text(F.col("alert_time"), tz)), F.col("alert_time"), spaced=False
    )
    police = _item_lines(flagged, 5, F.array(intervention_summary_text(rules)), spaced=False)
    return (
        fixed.unionByName(peaks).unionByName(critical).unionByName(police).orderBy(*LINE_ORDER)
    )
