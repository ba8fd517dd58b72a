"""Coordinates, projection and bins, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the WGS 84 ellipsoid: semi-major axis in metres and flattening.
AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)


def wrap_longitude(lon: Column) -> Column:
    """Into [-180, 180)."""
    return F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def snap(coord: Column, step: float = 0.1) -> Column:
    """A noisy coordinate on its canonical axis; halves away from zero."""
    return F.round(coord / F.lit(step), 0) * F.lit(step)


def pixel(coord: Column, origin: Column | float, step: Column | float) -> Column:
    """Index of the cell that holds a coordinate, for an axis that begins at ``origin``; ``step`` may be negative."""
    part = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    return F.floor((coord - part(origin)) / part(step)).cast("int")


def clipped_cell(coord: Column, origin: float, step: float, n: int) -> Column:
    """As ``pixel``, with what lies outside in the first or last of ``n`` cells."""
    return F.least(F.greatest(pixel(coord, origin, step), F.lit(0)), F.lit(n - 1))


def tenth_bin(celsius: Column, low: int = -35, high: int = 45) -> Column:
    """Half-open bin of a tenth of a degree, on whole hundredths so that edges are exact; values outside go to the end bins."""
    at = F.floor((F.rint(celsius * 100).cast("long") - F.lit(100 * low)) / 10)
    return F.least(F.greatest(at, F.lit(0)), F.lit(10 * (high - low) - 1)).cast("int")


def degree_bin(celsius: Column, low: int = -25, high: int = 35) -> Column:
    """Half-open bin of one degree; values outside go to the end bins."""
    at = F.floor((F.rint(celsius * 100).cast("long") - F.lit(100 * low)) / 100)
    return F.least(F.greatest(at, F.lit(0)), F.lit(high - low - 1)).cast("int")


def elevation_tile(lat: Column, lon: Column) -> Column:
    """Key of the 1-degree elevation tile with its south-west corner at the floor of the coordinates, as N07E010."""
    y, x = F.floor(lat).cast("int"), F.floor(lon).cast("int")
    north = F.when(y >= 0, F.lit("N")).otherwise(F.lit("S"))
    east = F.when(x >= 0, F.lit("E")).otherwise(F.lit("W"))
    return F.concat(north, F.lpad(F.abs(y).cast("string"), 2, "0"), east, F.lpad(F.abs(x).cast("string"), 3, "0"))


def _authalic(sin: Column) -> Column:
    part = F.lit(_E) * sin
    return F.lit(1 - _E2) * (sin / (1 - part * part) - F.lit(1 / (2 * _E)) * F.log((1 - part) / (1 + part)))


_QP = (1 - _E2) * (1 / (1 - _E2) - 1 / (2 * _E) * math.log((1 - _E) / (1 + _E)))


def equal_area(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Metres in the cylindrical equal-area projection with true scale at the equator."""
    return F.radians(lon) * F.lit(AXIS), F.lit(AXIS / 2) * _authalic(F.sin(F.radians(lat)))


def from_equal_area(x: Column, y: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of projected metres, by the series of the authalic latitude."""
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), y * F.lit(2 / AXIS / _QP))))
    e2, e4, e6 = _E2, _E2**2, _E2**3
    lat = (
        beta
        + F.lit(e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
        + F.lit(23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta)
        + F.lit(761 * e6 / 45360) * F.sin(6 * beta)
    )
    return F.degrees(lat), F.degrees(x / F.lit(AXIS))


#: Supported systems: the degrees that they hold (longitude and latitude, least and greatest), from degrees (latitude, longitude) to x and y, and back.
SYSTEMS = {
    "EPSG:4326": ((-180.0, 180.0, -90.0, 90.0), lambda lat, lon: (lon, lat), lambda x, y: (y, x)),
    "ESRI:54034": ((-180.0, 180.0, -90.0, 90.0), equal_area, from_equal_area),
}


def _system(crs: str):
    if crs not in SYSTEMS:
        raise ValueError(f"unsupported system {crs}")
    return SYSTEMS[crs]


def cut(crs: str, lat: Column, lon: Column) -> tuple[Column, Column]:
    """Latitude and longitude cut at the bounds of a system."""
    west, east, south, north = _system(crs)[0]
    return F.greatest(F.lit(south), F.least(F.lit(north), lat)), F.greatest(F.lit(west), F.least(F.lit(east), lon))


def project(crs: str, lat: Column, lon: Column) -> tuple[Column, Column]:
    """x and y in a system."""
    return _system(crs)[1](lat, lon)


def unproject(crs: str, x: Column, y: Column) -> tuple[Column, Column]:
    """Latitude and longitude of x and y in a system."""
    return _system(crs)[2](x, y)
