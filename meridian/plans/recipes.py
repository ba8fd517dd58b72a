"""Products as chains of steps: the first takes one or more tables, each of the others the result of the one before."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions import units
from meridian.operators import temporal

Step = Callable[..., DataFrame]


@dataclass(frozen=True)
class Recipe:
    """Source variables, the chain (one for all datasets, or one by dataset) and the scale of the 16-bit form."""

    sources: tuple[str, ...]
    steps: Sequence[Step] | Mapping[str, Sequence[Step]]
    scale: float = 1.0
    offset: float = 0.0

    def __call__(self, *tables: DataFrame, dataset: str | None = None) -> DataFrame:
        if len(tables) != len(self.sources):
            raise ValueError(f"{len(self.sources)} tables are needed")
        steps = self.steps
        if isinstance(steps, Mapping):
            if dataset not in steps:
                raise KeyError(dataset)
            steps = steps[dataset]
        first, *rest = steps
        out = first(*tables)
        for step in rest:
            out = step(out)
        return out


def scalar(f) -> Step:
    """A step that changes the value alone."""
    return lambda df: df.withColumn("value", f(F.col("value")))


def pairwise(f, keys: Sequence[str]) -> Step:
    """A step that joins two tables on the place and takes both values."""

    def step(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b.withColumnRenamed("value", "__other"), list(keys)).select(*keys, f(F.col("value"), F.col("__other")).alias("value"))

    return step


def _daily(how: str) -> Step:
    return lambda df: temporal.daily(df, how)


def _annual(how: str) -> Step:
    return lambda df: temporal.annual(df, how)


def _days_over(threshold: float) -> Step:
    return lambda df: temporal.annual_days(df, temporal.over(F.col("value"), threshold)).withColumnRenamed("days", "value")


HOURLY = ("ts", "lat_i", "lon_i")
_wind = pairwise(lambda u, v: units.magnitude(units.wind_at_two_metres(u), units.wind_at_two_metres(v)), HOURLY)
_humidity = pairwise(lambda t, d: units.relative_humidity(units.kelvin_to_celsius(t), units.kelvin_to_celsius(d)), HOURLY)

#: Hourly reanalysis to days.
DAILY = {
    "mean_temperature": Recipe(("temperature",), [scalar(units.kelvin_to_celsius), _daily("mean")], 0.01),
    "max_temperature": Recipe(("temperature",), [scalar(units.kelvin_to_celsius), _daily("max")], 0.01),
    "min_temperature": Recipe(("temperature",), [scalar(units.kelvin_to_celsius), _daily("min")], 0.01),
    "sea_surface_temperature": Recipe(("sea_surface_temperature",), [scalar(units.kelvin_to_celsius), _daily("mean")], 0.01),
    "wind_speed": Recipe(("u", "v"), [_wind, _daily("mean")], 0.01),
    "relative_humidity": Recipe(("temperature", "dewpoint"), [_humidity, _daily("mean")], 0.01),
    "total_precipitation": Recipe(("precipitation",), {"land": [scalar(units.metre_to_millimetre), _daily("max")], "single": [scalar(units.metre_to_millimetre), _daily("sum")]}, 0.1),
}
DAYS = ("date", "lat_i", "lon_i")
_days_wind = pairwise(lambda u, v: units.magnitude(units.wind_at_two_metres(u), units.wind_at_two_metres(v)), DAYS)
#: A model's days in the units of the history, and how its anomalies are taken. Wind is that of the daily means of its components.
SCENARIO = {
    "mean_temperature": (Recipe(("tas",), [scalar(units.kelvin_to_celsius)], 0.01), "additive"),
    "max_temperature": (Recipe(("tasmax",), [scalar(units.kelvin_to_celsius)], 0.01), "additive"),
    "min_temperature": (Recipe(("tasmin",), [scalar(units.kelvin_to_celsius)], 0.01), "additive"),
    "wind_speed": (Recipe(("uas", "vas"), [_days_wind], 0.01), "multiplicative"),
    "relative_humidity": (Recipe(("hurs",), [lambda df: df], 0.01), "multiplicative"),
    "total_precipitation": (Recipe(("pr",), [scalar(units.flux_to_rainfall)], 0.1), "multiplicative"),
}
#: Days to years.
ANNUAL = {
    "mean_temperature": Recipe(("mean_temperature",), [_annual("mean")], 0.01),
    "mean_high_temperature": Recipe(("max_temperature",), [_annual("mean")], 0.01),
    "mean_low_temperature": Recipe(("min_temperature",), [_annual("mean")], 0.01),
    "days_over_30C": Recipe(("mean_temperature",), [_days_over(30.0)]),
    "wind_speed": Recipe(("wind_speed",), [_annual("mean")], 0.01),
    "relative_humidity": Recipe(("relative_humidity",), [_annual("mean")], 0.01),
    "total_precipitation": Recipe(("total_precipitation",), [_annual("sum")], 10.0),
    "precipitation_days": Recipe(("total_precipitation",), [_days_over(0.1)]),
}


def suitability(knots: DataFrame) -> Recipe:
    """Sum over a year of the suitability of each day, from the caller's knots."""
    mapped = lambda df: temporal.interpolate(df, knots).withColumn("value", F.col("mapped")).drop("mapped")
    return Recipe(("mean_temperature",), [mapped, _annual("sum")])
