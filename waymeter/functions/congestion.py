"""Scores and grades of traffic, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymeter.config import DEFAULTS, TrafficConfig

# Digits that survive a different order of adding doubles; grades are taken after rounding to them.
STABLE_DIGITS = 6


def congestion_index(volume: Column, mean_speed: Column, rules: TrafficConfig = DEFAULTS) -> Column:
    """Percent load of the junction times its slow-down; negative above free-flow speed."""
    load = volume.cast("double") / F.lit(float(rules.max_capacity))
    slow_down = F.lit(1.0) - mean_speed / F.lit(rules.free_flow_speed)
    score = load * slow_down * F.lit(100.0)
    if rules.clamp:
        # greatest/least skip nulls, so an unknown score must be kept apart.
        limited = F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0))
        return F.when(score.isNotNull(), limited)
    return score


def congestion_level(index: Column, rules: TrafficConfig = DEFAULTS) -> Column:
    """SEVERE, MODERATE or LOW; an unknown index is LOW."""
    stable = F.round(index.cast("double"), STABLE_DIGITS)
    return (
        F.when(stable >= rules.severe_from, "SEVERE")
        .when(stable >= rules.moderate_from, "MODERATE")
        .otherwise("LOW")
    )


def is_critical(speed: Column, rules: TrafficConfig = DEFAULTS) -> Column:
    return speed < F.lit(rules.critical_speed)


def known_speed(speed: Column) -> Column:
    """NaN, which JSON readers accept, is no speed."""
    return F.when(~F.isnan(speed), speed)


def hour_factor(hour: Column) -> Column:
    """Expected volume of an hour of day against a quiet daytime hour. The steps are fixed values."""
    return (
        F.when(hour.between(7, 9), 2.0)
        .when(hour.between(17, 19), 1.8)
        .when(hour.between(12, 13), 1.3)
        .when(hour.between(0, 5), 0.3)
        .otherwise(1.0)
    )


def stored_decimal(value: Column, kind: str) -> Column:
    """A double as the decimal a table stores: half up, null when it does not fit."""
    return F.round(value, STABLE_DIGITS).try_cast(kind)
