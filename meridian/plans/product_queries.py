"""Whole products as queries: what ``products`` makes of grids, pixels, locations and an ensemble."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import coordinates
from meridian.operators import spatial, temporal
from meridian.plans import location_queries as ensembles
from meridian.plans import products
from meridian.plans import raster_queries as rasters
from meridian.plans.fixtures import query

_PEOPLE = f"SELECT s.location_id, p.lat_i * 5 + p.lon_i AS cell, SUM(p.pop) AS population FROM (SELECT row, col, pop, {rasters._CELL} FROM population) p JOIN ({rasters._INSIDE}) s ON s.row = p.row AND s.col = p.col GROUP BY 1, 2"


def _cell():
    return (F.col("lat_i") * 5 + F.col("lon_i")).alias("cell")


def _pixels(x):
    """Pixels of the population with the climate cell that holds them, and the location of each."""
    pixels = x.population.withColumns({"lat_i": coordinates.clipped_cell(F.col("row") + 0.5, 0.0, 10.0, 5), "lon_i": coordinates.clipped_cell(F.col("col") + 0.5, 0.0, 8.0, 5)})
    pixels = pixels.select("block_key", "row", "col", _cell(), F.col("pop").alias("population"))
    centres = x.population.select("block_key", "row", "col", (F.col("col") + 0.5).cast("double").alias("x"), (F.col("row") + 0.5).cast("double").alias("y"))
    return pixels, spatial.pixels_in_polygons(centres, x.edges, keys=("block_key", "row", "col"))


def _locations(x):
    """Two measures of each location and all above it, weighted by the population."""
    year = F.year("date").alias("year_id")
    mean = x.daily_grid.groupBy(_cell(), year).agg(F.avg("value").alias("value")).withColumn("measure", F.lit("mean_temperature"))
    hot = x.daily_grid.groupBy(_cell(), year).agg(F.count_if(temporal.over(F.col("value"), 30.0)).cast("double").alias("value")).withColumn("measure", F.lit("days_over_30C"))
    values = mean.unionByName(hot).withColumn("scenario", F.lit("historical"))
    return products.location_results(values, *_pixels(x), rasters._tree(x.spark))


_VALUES = """SELECT lat_i * 5 + lon_i AS cell, year(date) AS year_id, 'mean_temperature' AS measure, AVG(value) AS value FROM daily_grid GROUP BY 1, 2 UNION ALL
  SELECT lat_i * 5 + lon_i, year(date), 'days_over_30C', COUNT(*) FILTER (value > 30) FROM daily_grid GROUP BY 1, 2"""
query("location_results", "location_id:i year_id:i scenario measure weighted_climate:d population:d value:d", "population edges daily_grid",
      f"""SELECT t.ancestor AS location_id, v.year_id, 'historical' AS scenario, v.measure, SUM(v.value * p.population) AS weighted_climate, SUM(p.population) AS population, SUM(v.value * p.population) / NULLIF(SUM(p.population), 0) AS value
          FROM ({_PEOPLE}) p JOIN ({_VALUES}) v ON v.cell = p.cell JOIN {rasters._TREE.replace('AS c(', 'AS t(')} ON t.descendant = p.location_id GROUP BY 1, 2, 3, 4""", _locations)  # fmt: skip


def _draws(x):
    """Results of one scenario by location and year, with a column for each draw of the ensemble."""
    members = x.member_annual.where("scenario = 'ssp245'").select(F.explode(F.sequence(F.lit(0), F.lit(24))).alias("cell"), F.col("year").alias("year_id"), "gcm_member", "value")
    members = members.withColumn("value", F.col("value") + F.col("cell"))
    results = products.location_results(members, *_pixels(x), rasters._tree(x.spark), ("year_id", "gcm_member"))
    return products.draw_results(results, ensembles._draws(x))


query("draw_location_results", "location_id:i year_id:i " + " ".join(f"{n:03}:d" for n in range(100)), "population edges member_annual",
      "WITH r AS (SELECT t.ancestor AS location_id, m.year AS year_id, m.gcm_member, SUM((m.value + p.cell) * p.population) / SUM(p.population) AS value FROM member_annual m "
      f"CROSS JOIN ({_PEOPLE}) p JOIN {rasters._TREE.replace('AS c(', 'AS t(')} ON t.descendant = p.location_id WHERE m.scenario = 'ssp245' GROUP BY 1, 2, 3) "
      "SELECT r.location_id, r.year_id, " + ", ".join(f'MAX(r.value) FILTER (d.draw = {n}) AS "{n:03}"' for n in range(100))
      + f" FROM r JOIN ({ensembles._DRAWN}) d ON r.gcm_member = d.source || '_' || d.variant GROUP BY 1, 2", _draws)

_ANNUAL = "SELECT lat_i * 5 + lon_i AS cell, year(date) AS year, AVG(value) AS value FROM daily_grid GROUP BY 1, 2"
_ROLLING = f"SELECT * FROM (SELECT cell, year, CASE WHEN COUNT(value) OVER w = 3 THEN AVG(value) OVER w END AS value FROM ({_ANNUAL}) a WINDOW w AS (PARTITION BY cell ORDER BY year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) z WHERE year BETWEEN 1996 AND 1998"


def _zones(x):
    """Trailing means of the annual temperature of each cell, over years that look back beyond the first."""
    annual = x.daily_grid.groupBy(_cell(), F.year("date").alias("year")).agg(F.avg("value").alias("value"))
    return products.temperature_zone(annual, ["cell"], 1996, 1998, 3)


query("cell_temperature_zones", "cell:i year:i value:d", "daily_grid", _ROLLING, _zones)


def _person_days(x):
    """Person-days by location, year, temperature and zone, where the zone is the trailing mean of the cell; years before the first zone have none."""
    pixels, places = _pixels(x)
    people = pixels.join(places, ["block_key", "row", "col"]).select("location_id", "cell", "population")
    zones = _zones(x).where("value is not null")
    return products.person_days(x.daily_grid.select(_cell(), "date", "value"), zones, people, rasters._tree(x.spark))


query("person_days_by_zone", "location_id:i year:i temperature:i zone:i person_days:d", "population edges daily_grid",
      f"""SELECT t.ancestor AS location_id, d.year, d.temperature, z.zone, SUM(p.population * d.n) AS person_days FROM ({_PEOPLE}) p
          JOIN (SELECT lat_i * 5 + lon_i AS cell, year(date) AS year, {rasters._BIN} AS temperature, COUNT(*) AS n FROM daily_grid GROUP BY 1, 2, 3) d ON d.cell = p.cell
          JOIN (SELECT cell, year, {rasters._ZONE} AS zone FROM ({_ROLLING}) r WHERE value IS NOT NULL) z ON z.cell = d.cell AND z.year = d.year
          JOIN {rasters._TREE.replace('AS c(', 'AS t(')} ON t.descendant = p.location_id GROUP BY 1, 2, 3, 4""", _person_days)  # fmt: skip
query("grid_reference", "month:i latitude:d longitude:d value:d", "daily_grid",
      "SELECT month, latitude, longitude, AVG(value) AS value FROM (SELECT year(date) AS year, month(date) AS month, latitude, longitude, AVG(value) AS value FROM daily_grid WHERE year(date) BETWEEN 1995 AND 1999 GROUP BY 1, 2, 3, 4) t GROUP BY 1, 2, 3",
      lambda x: products.reference(x.daily_grid, 1995, 1999))
