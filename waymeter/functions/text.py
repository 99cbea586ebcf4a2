"""Text forms used by messages and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig
from waymeter.functions.congestion import STABLE_DIGITS

# The text forms below must come out exactly so.
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ALERT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
UNKNOWN = "nan"


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def hour_label(hour: Column) -> Column:
    """08:00"""
    return F.concat(_two_digits(hour), F.lit(":00"))


def hour_span_label(hour: Column) -> Column:
    """08:00–09:00, and 23:00–00:00 for the last hour."""
    return F.concat(hour_label(hour), F.lit("–"), hour_label((hour + 1) % 24))


def one_decimal(value: Column, pattern: str = "%.1f") -> Column:
    """Half-up text with one decimal; adding zero turns minus zero into zero."""
    number = value.cast("double")
    rounded = F.round(F.round(number, STABLE_DIGITS), 1) + F.lit(0.0)
    return F.when(number.isNotNull(), F.format_string(pattern, rounded)).otherwise(UNKNOWN)


def padded_speed(speed: Column) -> Column:
    """07.2 km/h"""
    return F.concat(one_decimal(speed, "%04.1f"), F.lit(" km/h"))


def padded_name(name: Column, width: int) -> Column:
    """Filled to the width; a longer name stays whole."""
    known = F.coalesce(name, F.lit(""))
    return F.rpad(known, F.greatest(F.length(known), F.lit(width)), F.lit(" "))


def whole_number(value: Column) -> Column:
    return F.coalesce(value.cast("bigint").cast("string"), F.lit(UNKNOWN))


def intervention_reason(avg_ci: Column, avg_speed: Column, rules: TrafficConfig = DEFAULTS) -> Column:
    """Why a junction is flagged: the index rule is named first, null when no rule holds."""
    by_index = F.concat(F.lit("CI="), one_decimal(avg_ci), F.lit(f" (≥{rules.police_ci})"))
    by_speed = F.concat(
        F.lit("Avg speed "), one_decimal(avg_speed), F.lit(f" km/h (<{rules.police_speed:g})")
    )
    return F.when(avg_ci >= rules.police_ci, by_index).when(avg_speed < rules.police_speed, by_speed)
