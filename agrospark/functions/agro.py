"""Agronomic formulas as native column expressions (no row-wise Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: constants of the reference ET0 formula (Penman-Monteith form as used there)
STEFAN_BOLTZMANN = 4.903e-9      # MJ K-4 m-2 day-1
SEA_LEVEL_PRESSURE = 101.3       # kPa
GAMMA_FACTOR = 0.665             # gamma = 0.665 * pressure (kept as written there)
FIELD_CAPACITY = 0.4


def _es(t: Column) -> Column:
    return F.lit(0.6108) * F.exp(F.lit(17.27) * t / (t + F.lit(237.3)))


def et0(temp_max: Column, temp_min: Column, humidity: Column, wind: Column, solar: Column) -> Column:
    """Reference evapotranspiration, clamped at 0; any missing input gives 0 (max(0, NaN) = 0 there).

    ``solar`` is in MJ (the caller divides J by 1e6); latitude/day-of-year are unused by the formula.
    """
    t_mean = (temp_max + temp_min) / F.lit(2.0)
    delta = F.lit(4098.0) * (F.lit(0.6108) * F.exp(F.lit(17.27) * t_mean / (t_mean + F.lit(237.3)))) \
        / F.pow(t_mean + F.lit(237.3), F.lit(2.0))
    gamma = F.lit(GAMMA_FACTOR) * F.lit(SEA_LEVEL_PRESSURE)
    es = (_es(temp_max) + _es(temp_min)) / F.lit(2.0)
    ea = es * humidity / F.lit(100.0)
    rn = solar * F.lit(0.77) - F.lit(STEFAN_BOLTZMANN) * (
        F.pow(temp_max + F.lit(273.16), F.lit(4.0)) + F.pow(temp_min + F.lit(273.16), F.lit(4.0))) / F.lit(2.0) \
        * (F.lit(0.34) - F.lit(0.14) * F.sqrt(ea))
    g = F.lit(0.0)
    num = F.lit(0.408) * delta * (rn - g) + gamma * F.lit(900.0) / (t_mean + F.lit(273.0)) * wind * (es - ea)
    den = delta + gamma * (F.lit(1.0) + F.lit(0.34) * wind)
    v = num / den
    # max(0, x) with Python semantics: NaN/None -> 0, negative -> 0
    # (Spark orders NaN above all numbers, so it is tested first)
    return F.when(~F.isnan(v) & (v > F.lit(0.0)), v).otherwise(F.lit(0.0))


def kc_stage(stage: Column, kc_initial: Column, kc_mid: Column, kc_end: Column, days: Column) -> Column:
    """Crop coefficient by growth stage: flat initial (<=25%), linear to mid (<=75%), linear to end (extrapolates)."""
    d = days.cast("double")
    s = stage.cast("double")
    p1 = (s - d * F.lit(0.25)) / (d * F.lit(0.5))
    p2 = (s - d * F.lit(0.75)) / (d * F.lit(0.25))
    return F.when(s <= d * F.lit(0.25), kc_initial) \
        .when(s <= d * F.lit(0.75), kc_initial + p1 * (kc_mid - kc_initial)) \
        .otherwise(kc_mid + p2 * (kc_end - kc_mid))


def soil_water_deficit(ssm: Column, capacity: float = FIELD_CAPACITY) -> Column:
    """max(0, capacity - ssm), null-propagating (numpy maximum keeps NaN)."""
    v = F.lit(capacity) - ssm
    return F.when(v.isNotNull(), F.greatest(F.lit(0.0), v))


def irrigation_efficiency(wind_speed: Column, temp_range: Column) -> Column:
    """clip(1 - (wind/10 + range/20)/2, 0.3, 1.0), null-propagating."""
    v = F.lit(1.0) - (wind_speed / F.lit(10.0) + temp_range / F.lit(20.0)) / F.lit(2.0)
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(0.3)), F.lit(1.0)))
