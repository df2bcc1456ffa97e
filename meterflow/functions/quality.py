"""Column expressions that judge a reading without rejecting it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEVERE_VOLTAGE = 135.0


def is_severe_voltage(volts: Column, limit: float = SEVERE_VOLTAGE) -> Column:
    """Strictly above the limit. Spark sorts NaN above all numbers, so NaN is ruled out first."""
    return F.coalesce(~F.isnan(volts) & (volts > F.lit(limit)), F.lit(False))


def valid_power_factor(power_factor: Column) -> Column:
    return F.coalesce(power_factor.between(0.0, 1.0) & ~F.isnan(power_factor), F.lit(False))


def voltage_band(volts: Column) -> Column:
    """Supply bands of a 120 V service."""
    return (
        F.when(volts.between(114.0, 126.0), "optimal")
        .when(volts.between(106.0, 127.0), "acceptable")
        .otherwise("out_of_range")
    )


def quality_state(reject_reason: Column, event_time: Column, ingest_time: Column, stale_after_sec: float) -> Column:
    """Bad when rejected, Stale when it took too long to arrive, Good otherwise."""
    late = F.unix_micros(ingest_time) - F.unix_micros(event_time) > F.lit(int(stale_after_sec * 1e6))
    return F.when(reject_reason.isNotNull(), "Bad").when(late, "Stale").otherwise("Good")
