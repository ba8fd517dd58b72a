"""Named products that join several tables, built of the operators. Grids have latitude and longitude columns; ``lat`` and ``lon`` are target axes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions import coordinates, units
from meridian.operators import climate, ensemble, grid, hierarchy, spatial, temporal
from meridian.operators.temporal import CELL
from meridian.plans.recipes import SCENARIO

PLACE = ("latitude", "longitude")


def _axes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(df.select(F.col(c).alias("coord")).distinct() for c in PLACE)


def aligned(tables: Sequence[DataFrame], combine: Callable[..., Column], step: str = "date", same_grid: bool = False) -> DataFrame:
    """One value of several tables: the others are brought to the first one's grid and their gaps filled, then all are joined by place."""
    first, *others = tables
    if not same_grid:
        lat, lon = _axes(first)
        others = [grid.filled(t, lat, lon, (step,)) for t in others]
    named = [t.select(step, *PLACE, F.col("value").alias(f"__v{i}")) for i, t in enumerate([first, *others])]
    joined = reduce(lambda a, b: a.join(b, [step, *PLACE]), named)
    return joined.select(step, *PLACE, combine(*[F.col(f"__v{i}") for i in range(len(named))]).alias("value"))


def historical_daily(land: DataFrame, single: DataFrame, lat: DataFrame, lon: DataFrame) -> DataFrame:
    """Daily values on the target grid: the land data where there are any, the coarser ones elsewhere, then regridded and filled."""
    on_land = grid.bilinear(single, *_axes(land))
    both = climate.coalesce_sources(land, on_land, ["date", *PLACE])
    return grid.filled(both, lat, lon)


def sea_surface_daily(single: DataFrame, lat: DataFrame, lon: DataFrame) -> DataFrame:
    """Sea surface temperature comes from one source and by the nearest node."""
    return grid.filled(single, lat, lon, how="nearest")


def reference(daily: DataFrame, first_year: int = 2019, last_year: int = 2023) -> DataFrame:
    return temporal.climatology(climate.window(daily, first_year, last_year), PLACE)


def scenario_daily(member: DataFrame, member_window: DataFrame, historical: DataFrame, kind: str, lat: DataFrame, lon: DataFrame) -> DataFrame:
    """A member's days, bias-corrected on the target grid.

    Anomalies are taken on the member's own grid against its own monthly means, regridded, and put on the observed climatology.
    """
    anomalies = climate.anomaly(member, temporal.pooled_monthly_mean(member_window, PLACE), kind, PLACE)
    fine = grid.filled(anomalies, lat, lon)
    return climate.bias_correct(fine, historical, kind, PLACE)


def scenario_variable(name: str, members: Sequence[DataFrame], windows: Sequence[DataFrame], historical: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    """Days of a named variable of a model, bias-corrected on its own grid: units, anomalies and correction as ``recipes.SCENARIO`` has them.

    ``members`` and ``windows``: the source variables of the days wanted and of the reference window.
    """
    recipe, kind = SCENARIO[name]
    reference = temporal.pooled_monthly_mean(recipe(*windows), keys)
    return climate.bias_correct(climate.anomaly(recipe(*members), reference, kind, keys), historical, kind, keys)


def temperature_zone(compiled: DataFrame, keys: Sequence[str], first_year: int = 1990, last_year: int = 2100, years: int = 10) -> DataFrame:
    """Trailing mean of the annual temperature. Years are cut after the window, which looks back beyond the first."""
    zones = temporal.rolling_mean(compiled, keys, years)
    return zones.where(F.col("year").between(first_year, last_year)).select(*keys, "year", F.col("rolling").alias("value"))


def location_results(climate_values: DataFrame, pixels: DataFrame, locations: DataFrame, tree: DataFrame, keys: Sequence[str] = ("year_id", "scenario", "measure")) -> DataFrame:
    """Population-weighted values of each location and all above it.

    ``climate_values``: cell, keys, value; ``pixels``: row, col, block_key, cell, population; ``locations``: row, col, block_key, location_id.
    Pixels are summed by location and cell before they meet the years, as the map between them doesn't change.
    """
    people = pixels.join(locations, ["block_key", "row", "col"]).groupBy("location_id", "cell").agg(F.sum("population").alias("population"))
    sums = spatial.location_sums(people.join(climate_values, "cell"), ["location_id", *keys])
    rolled = hierarchy.roll_up(sums, tree, ["weighted_climate", "population"], keys)
    return rolled.withColumn("value", hierarchy.weighted_mean(F.col("weighted_climate"), F.col("population")))


def draw_results(results: DataFrame, draws: DataFrame, numbers: Sequence[int] = tuple(range(100))) -> DataFrame:
    """Values by location and year with a column for each draw; ``results`` has gcm_member, ``draws`` maps draws to members."""
    return ensemble.wide_draws(ensemble.draw_view(draws, results), ["location_id", "year_id"], numbers)


def person_days(daily: DataFrame, zones: DataFrame, people: DataFrame, tree: DataFrame) -> DataFrame:
    """Person-days by location, year, temperature bin and zone, for each location and all above it.

    ``daily``: cell, date, value; ``zones``: cell, year, value; ``people``: location_id, cell, population.
    """
    days = daily.groupBy("cell", F.year("date").alias("year"), coordinates.tenth_bin(F.col("value")).alias("temperature")).agg(F.count(F.lit(1)).alias("n"))
    zone = zones.select("cell", "year", coordinates.degree_bin(F.col("value")).alias("zone"))
    keys = ["year", "temperature", "zone"]
    return hierarchy.roll_up(spatial.person_days(people, days.join(zone, ["cell", "year"]), keys), tree, ["person_days"], keys)


def predictors(dem: DataFrame, classes: DataFrame, target: int, coarse: int) -> DataFrame:
    """For each target pixel (``target`` fine pixels a side) its elevation, that of the coarse cell that holds it, their difference and class.

    ``dem``: row, col, elevation; ``classes``: row, col, class, both on the fine raster.
    """
    names = {"coarse_row": "row", "coarse_col": "col"}
    fine = grid.block_average(dem, "elevation", target).withColumnsRenamed(names | {"value": "elevation_target"})
    wide = grid.block_average(dem, "elevation", target * coarse).withColumnRenamed("value", "elevation_coarse")
    kind = grid.majority(classes, "class", target).withColumnsRenamed(names | {"value": "class_target"})
    out = grid.upsample(fine, wide, coarse).join(kind, ["row", "col"], "left")
    return out.withColumn("elevation_anomaly", F.col("elevation_coarse") - F.col("elevation_target"))


def training_table(stations: DataFrame, daily: DataFrame, pixels: DataFrame, origin: tuple[float, float], step: float) -> DataFrame:
    """A row for each station and day: what it measured, the grid's value nearest to it in place and time, and the predictors of its pixel.

    ``stations``: station, date, lat, lon, temp_f, elevation; ``pixels``: row, col, elevation_target and others. ``origin``: latitude and
    longitude of the raster's upper left corner. A station without elevation has that of its pixel.
    """
    rows = stations.na.drop(subset=["station", "date", "lat", "lon", "temp_f", "elevation"])
    rows = rows.withColumn("temperature", units.fahrenheit_to_celsius(F.col("temp_f"))).drop("temp_f")
    wrapped = daily.withColumn("longitude", coordinates.wrap_longitude(F.col("longitude")))
    for axis, column in zip(PLACE, ("lat", "lon"), strict=True):
        rows = spatial.nearest_coordinate(rows, wrapped.select(F.col(axis).alias("coord")).distinct(), column, axis)
    rows = spatial.nearest_coordinate(rows.withColumn("__day", F.unix_date("date").cast("double")), wrapped.select(F.unix_date("date").cast("double").alias("coord")).distinct(), "__day", "__near")
    wrapped = wrapped.select(F.unix_date("date").cast("double").alias("__near"), *PLACE, F.col("value").alias("grid_temperature"))
    rows = rows.join(wrapped, ["__near", *PLACE], "left").drop("__day", "__near")
    rows = rows.withColumns({"row": coordinates.pixel(F.col("lat"), origin[0], -step), "col": coordinates.pixel(F.col("lon"), origin[1], step)})
    rows = rows.join(pixels, ["row", "col"], "left")
    return rows.withColumn("elevation", F.when(F.col("elevation") < -999, F.col("elevation_target")).otherwise(F.col("elevation")))
