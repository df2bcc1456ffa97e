"""Column expressions: device names, time, electrical quantities and expected load."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000

# The load model and the noise it carries.
NOMINAL_VOLTAGE = 120.0
SAG_VOLTS = 1.5
SAG_AT_AMPS = 30.0
BASE_AMPS = 5.0
SWING_AMPS = 25.0
SCALE_BAND = (0.7, 1.5)
SIGMA_VOLTS = 0.3
SIGMA_AMPS = 0.5

# The signature of a surge that trips the load.
SURGE_VOLTS = (145.0, 155.0)
SURGE_MAX_AMPS = 0.5
SURGE_POWER_FACTOR = 0.2

# Fleet layout.
TOTAL_METERS = 10_000
NUM_WORKERS = 100


def device_name(meter_id: Column) -> Column:
    """``meter_00042``; wider numbers are kept whole."""
    digits = meter_id.cast("long").cast("string")
    return F.concat(F.lit("meter_"), F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits))


def device_number(device_id: Column) -> Column:
    """Inverse of :func:`device_name`; null when the name has another shape."""
    digits = F.regexp_extract(device_id, r"^meter_(\d+)$", 1)
    return digits.try_cast("long")


def device_shard(meter_id: Column, total: int = TOTAL_METERS, workers: int = NUM_WORKERS) -> Column:
    """The worker that serves a meter."""
    return F.floor(meter_id / F.lit(total // workers)).cast("long")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a timestamp, rounded to the nearest microsecond (half to even).

    A plain cast truncates, so whole seconds and the fraction are converted apart.
    """
    whole = F.floor(seconds)
    fraction = F.rint((seconds - whole) * F.lit(1e6)).cast("long")
    return F.timestamp_micros(whole.cast("long") * F.lit(MICROS) + fraction)


def timestamp_to_epoch(ts: Column) -> Column:
    return F.unix_micros(ts) / F.lit(1e6)


def flag_to_int(flag: Column) -> Column:
    return flag.cast("int")


def active_power_kw(volts: Column, amps: Column, power_factor: Column) -> Column:
    return volts * amps * power_factor / F.lit(1000.0)


def apparent_power_kva(volts: Column, amps: Column) -> Column:
    return volts * amps / F.lit(1000.0)


def power_factor_of(kw: Column, kva: Column) -> Column:
    """Ratio of active to apparent power; null when there is no apparent power."""
    return F.try_divide(kw, kva)


def phase_angle_deg(power_factor: Column) -> Column:
    return F.degrees(F.acos(power_factor))


def power_tolerance_kw(volts: Column, amps: Column, power_factor: Column) -> Column:
    """What rounding V, I and PF to 2 places and kW to 3 places can move the product by."""
    spread = volts * amps + volts * power_factor + amps * power_factor
    return F.lit(0.005) * spread / F.lit(1000.0) + F.lit(0.0005)


def power_is_consistent(kw: Column, volts: Column, amps: Column, power_factor: Column) -> Column:
    gap = F.abs(kw - active_power_kw(volts, amps, power_factor))
    return gap <= power_tolerance_kw(volts, amps, power_factor)


def local_hour(ts: Column, zone: str = "UTC") -> Column:
    """Hour of the day with its fraction, on the clock of the site."""
    local = F.from_utc_timestamp(ts, zone)
    return F.hour(local) + F.minute(local) / F.lit(60.0) + F.second(local) / F.lit(3600.0)


def load_factor(hour: Column) -> Column:
    """0 at midnight, 1 at noon."""
    return F.lit(0.5) - F.lit(0.5) * F.cos(F.pi() * hour / F.lit(12.0))


def expected_current(hour: Column, scale: Column) -> Column:
    return (F.lit(BASE_AMPS) + F.lit(SWING_AMPS) * load_factor(hour)) * scale


def expected_voltage(amps: Column) -> Column:
    return F.lit(NOMINAL_VOLTAGE) - amps / F.lit(SAG_AT_AMPS) * F.lit(SAG_VOLTS)


def voltage_residual(volts: Column, expected: Column) -> Column:
    return F.abs(volts - expected) / F.lit(SIGMA_VOLTS)


def current_residual(amps: Column, expected: Column) -> Column:
    return F.abs(amps - expected) / F.lit(SIGMA_AMPS)


def is_outside_baseline(volts: Column, amps: Column, hour: Column, sigmas: float = 3.0) -> Column:
    """Further than ``sigmas`` of noise from all that a meter of unknown scale may show at that hour."""
    light, heavy = (expected_current(hour, F.lit(scale)) for scale in SCALE_BAND)
    slack_amps, slack_volts = F.lit(sigmas * SIGMA_AMPS), F.lit(sigmas * SIGMA_VOLTS)
    return (
        (amps < light - slack_amps) | (amps > heavy + slack_amps)
        | (volts < expected_voltage(heavy) - slack_volts) | (volts > expected_voltage(light) + slack_volts)
    )


def is_surge_and_trip(volts: Column, amps: Column, power_factor: Column) -> Column:
    """The power factor is compared after rounding, as a 4-byte 0.2 is not the 8-byte 0.2."""
    return (
        volts.between(*SURGE_VOLTS)
        & (amps <= SURGE_MAX_AMPS)
        & (F.round(power_factor.cast("double"), 2) == SURGE_POWER_FACTOR)
    )


def present(column: Column, kind: str) -> Column:
    """Rounding for display: 2 places for V, A and PF, 3 for kW, 6 for packet gaps."""
    return F.round(column, {"metric": 2, "kw": 3, "gap": 6}[kind])
