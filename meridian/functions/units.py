"""Units and derived quantities, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def kelvin_to_celsius(x: Column) -> Column:
    return x - F.lit(273.15)


def metre_to_millimetre(x: Column) -> Column:
    return x * F.lit(1000.0)


def flux_to_rainfall(x: Column) -> Column:
    """Precipitation flux (kg per square metre and second) as millimetres a day."""
    return x * F.lit(86400.0)


def wind_at_two_metres(x: Column) -> Column:
    """Wind speed at 10 m brought to 2 m by the logarithmic profile over a roughness of 0.01 m (fixed values)."""
    return x * F.log10(F.lit(2 / 0.01)) / F.log10(F.lit(10 / 0.01))


def fahrenheit_to_celsius(x: Column) -> Column:
    return (x - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)


def magnitude(x: Column, y: Column) -> Column:
    return F.sqrt(x * x + y * y)


def vapour_pressure(celsius: Column) -> Column:
    """Saturation vapour pressure in hPa by Buck's equations, over water above 0 degrees and over ice below."""
    # The constants of the equations.
    water = F.lit(6.1121) * F.exp((F.lit(18.678) - celsius / F.lit(234.5)) * celsius / (F.lit(257.14) + celsius))
    ice = F.lit(6.1115) * F.exp((F.lit(23.036) - celsius / F.lit(333.7)) * celsius / (F.lit(279.82) + celsius))
    return F.when(celsius > 0, water).otherwise(ice)


def relative_humidity(temperature: Column, dewpoint: Column) -> Column:
    return F.lit(100.0) * vapour_pressure(dewpoint) / vapour_pressure(temperature)


def pack(x: Column, scale: float, offset: float = 0.0) -> Column:
    """16-bit storage form; missing, or out of range: -32767."""
    return F.coalesce(F.rint((x - F.lit(offset)) / F.lit(scale)).try_cast("smallint"), F.lit(-32767).cast("smallint"))


def unpack(raw: Column, scale: float, offset: float = 0.0) -> Column:
    return F.when(raw != -32767, raw.cast("double") * F.lit(scale) + F.lit(offset))


def missing(x: Column) -> Column:
    """NaN as null: Spark's sums would keep it, and comparisons take it for the greatest number."""
    return F.nanvl(x, F.lit(None).cast("double"))
