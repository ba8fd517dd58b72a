"""Queries over stations, rasters, polygons and person-days."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import coordinates, units
from meridian.operators import grid, spatial
from meridian.plans import products
from meridian.plans.fixtures import query
from meridian.sources import scratch, tables

# --- stations ---
_CLEAN = """SELECT station, CAST(DATE '2024-01-01' + CAST(day_no AS INT) AS DATE) AS date, lat, lon, (temp_f - 32) * 5 / 9 AS temperature, elevation FROM stations WHERE temp_f IS NOT NULL AND elevation IS NOT NULL"""


def _clean(x):
    rows = x.stations.na.drop(subset=["station", "lat", "lon", "temp_f", "elevation", "day_no"])
    date = F.date_add(F.lit("2024-01-01").cast("date"), F.col("day_no"))
    return rows.select("station", date.alias("date"), "lat", "lon", units.fahrenheit_to_celsius(F.col("temp_f")).alias("temperature"), "elevation")


query("clean_stations", "station date lat:d lon:d temperature:d elevation:d", "stations", _CLEAN, _clean)


def _ingested(x):
    path = scratch.path(x.spark, "stations")
    raw = x.stations.select(F.col("station").alias("STATION"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("day_no")).alias("DATE"), F.col("lat").alias("LATITUDE"), F.col("lon").alias("LONGITUDE"), F.col("elevation").alias("ELEVATION"), F.col("temp_f").alias("TEMP"))
    raw.write.option("header", True).csv(path)
    return tables.stations(x.spark, path).select(F.col("STATION").alias("station"), F.col("DATE").alias("date"), F.col("LATITUDE").alias("lat"), F.col("LONGITUDE").alias("lon"), F.col("ELEVATION").alias("elevation"), F.col("TEMP").alias("temp_f"))


query("station_ingest", "station date lat:d lon:d elevation:d temp_f:d", "stations",
      "SELECT station, CAST(DATE '2024-01-01' + CAST(day_no AS INT) AS DATE) AS date, lat, lon, elevation, temp_f FROM stations", _ingested)
_DAYS = "SELECT CAST(ts AS DATE) AS date, latitude, CASE WHEN longitude >= 180 THEN longitude - 360 ELSE longitude END AS longitude, AVG(value) - 273.15 AS value FROM hourly GROUP BY 1, 2, 3"


def _near(x):
    days = x.hourly.groupBy(F.to_date("ts").alias("date"), "latitude", coordinates.wrap_longitude(F.col("longitude")).alias("longitude")).agg(F.avg("value").alias("value"))
    days = days.withColumn("value", units.kelvin_to_celsius(F.col("value")))
    placed = spatial.nearest_coordinate(_clean(x), days.select(F.col("latitude").alias("coord")).distinct(), "lat", "latitude")
    placed = spatial.nearest_coordinate(placed, days.select(F.col("longitude").alias("coord")).distinct(), "lon", "longitude")
    return placed.join(days, ["date", "latitude", "longitude"], "left")


query("station_nearest_grid", "station date latitude:d longitude:d value:d", "stations hourly",
      f"""SELECT s.station, s.date, a.c AS latitude, o.c AS longitude, g.value FROM ({_CLEAN}) s
          JOIN (SELECT lat, arg_min(c, (abs(c - lat), -c)) AS c FROM (SELECT DISTINCT lat FROM stations) t CROSS JOIN (SELECT DISTINCT latitude AS c FROM ({_DAYS}) d) u GROUP BY lat) a ON a.lat = s.lat
          JOIN (SELECT lon, arg_min(c, (abs(c - lon), -c)) AS c FROM (SELECT DISTINCT lon FROM stations) t CROSS JOIN (SELECT DISTINCT longitude AS c FROM ({_DAYS}) d) u GROUP BY lon) o ON o.lon = s.lon
          LEFT JOIN ({_DAYS}) g ON g.date = s.date AND g.latitude = a.c AND g.longitude = o.c""", _near)  # fmt: skip


def _sampled(x):
    at = _clean(x).withColumns({"row": coordinates.pixel(F.col("lat"), 50.0, -2.0), "col": coordinates.pixel(F.col("lon"), -180.0, 9.0)})
    return at.join(x.fine_raster.select("row", "col", F.col("elevation").alias("target_elevation"), "class"), ["row", "col"], "left")


_SAMPLE = f"""SELECT s.*, f.elevation AS target_elevation, f.class FROM ({_CLEAN}) s LEFT JOIN fine_raster f
  ON f.row = CAST(FLOOR((s.lat - 50) / -2.0) AS INT) AND f.col = CAST(FLOOR((s.lon + 180) / 9.0) AS INT)"""
query("station_raster_sample", "station date target_elevation:d class:i", "stations fine_raster", _SAMPLE, _sampled)
query("station_elevation_fill", "station date elevation:d", "stations fine_raster", f"SELECT station, date, CASE WHEN elevation < -999 THEN target_elevation ELSE elevation END AS elevation FROM ({_SAMPLE}) q",
      lambda x: _sampled(x).withColumn("elevation", F.when(F.col("elevation") < -999, F.col("target_elevation")).otherwise(F.col("elevation"))))

# --- rasters ---
_COARSE = "CAST(FLOOR(row / 10) AS INT) AS coarse_row, CAST(FLOOR(col / 10) AS INT) AS coarse_col"
_AVERAGE = f"SELECT {_COARSE}, AVG(elevation) AS value FROM fine_raster GROUP BY 1, 2"
query("block_average", "coarse_row:i coarse_col:i value:d", "fine_raster", _AVERAGE, lambda x: grid.block_average(x.fine_raster, "elevation", 10))
query("majority_class", "coarse_row:i coarse_col:i value:i", "fine_raster",
      f"SELECT coarse_row, coarse_col, class AS value FROM (SELECT {_COARSE}, class, COUNT(*) AS n FROM fine_raster WHERE class IS NOT NULL GROUP BY 1, 2, 3) t QUALIFY ROW_NUMBER() OVER (PARTITION BY coarse_row, coarse_col ORDER BY n DESC, class) = 1",
      lambda x: grid.majority(x.fine_raster, "class", 10))
_UP = f"SELECT f.row, f.col, f.elevation, a.value FROM fine_raster f JOIN ({_AVERAGE}) a ON a.coarse_row = CAST(FLOOR(f.row / 10) AS INT) AND a.coarse_col = CAST(FLOOR(f.col / 10) AS INT)"
query("upsample_nearest", "row:i col:i value:d", "fine_raster", _UP, lambda x: grid.upsample(x.fine_raster, grid.block_average(x.fine_raster, "elevation", 10), 10))
query("elevation_anomaly", "row:i col:i anomaly:d", "fine_raster", f"SELECT row, col, value - elevation AS anomaly FROM ({_UP}) u",
      lambda x: grid.upsample(x.fine_raster, grid.block_average(x.fine_raster, "elevation", 10), 10).withColumn("anomaly", F.col("value") - F.col("elevation")))
query("mosaic_tiles", "row:i col:i elevation:d", "population", "SELECT row, col, elevation FROM population",
      lambda x: x.population.where("block_key < 'B-3'").unionByName(x.population.where("block_key >= 'B-3'")))
query("affine_pixel_index", "row:i col:i pixel_row:i pixel_col:i", "fine_raster",
      "SELECT row, col, CAST(FLOOR((90 - (row + 0.5) * 0.25 - 90) / -0.5) AS INT) AS pixel_row, CAST(FLOOR((-180 + (col + 0.5) * 0.25 + 180) / 0.5) AS INT) AS pixel_col FROM fine_raster",
      lambda x: x.fine_raster.withColumns({"pixel_row": coordinates.pixel(90 - (F.col("row") + 0.5) * 0.25, 90.0, -0.5), "pixel_col": coordinates.pixel(-180 + (F.col("col") + 0.5) * 0.25, -180.0, 0.5)}))
_KEY = "(CASE WHEN FLOOR(lat) >= 0 THEN 'N' ELSE 'S' END) || lpad(CAST(CAST(abs(FLOOR(lat)) AS INT) AS VARCHAR), 2, '0') || (CASE WHEN FLOOR(lon) >= 0 THEN 'E' ELSE 'W' END) || lpad(CAST(CAST(abs(FLOOR(lon)) AS INT) AS VARCHAR), 3, '0')"
query("dem_tile_key", "station tile", "stations", f"SELECT station, {_KEY} AS tile FROM stations", lambda x: x.stations.select("station", coordinates.elevation_tile(F.col("lat"), F.col("lon")).alias("tile")))


def _tiles(x):
    """Elevation of each station from the tile of its degree: rasters of a row a degree of latitude, from 45 south."""
    tiles = x.fine_raster.select(coordinates.elevation_tile(F.col("row").cast("double") - 45, F.col("col").cast("double") * 9 - 180).alias("tile"), "elevation")
    return x.stations.select("station", coordinates.elevation_tile(F.col("lat"), F.col("lon")).alias("tile")).join(tiles, "tile", "left")


query("dem_tile_scan", "station tile elevation:d", "stations fine_raster",
      f"SELECT s.station, s.tile, t.elevation FROM (SELECT station, {_KEY} AS tile FROM stations) s LEFT JOIN (SELECT {_KEY} AS tile, elevation FROM (SELECT row - 45.0 AS lat, col * 9.0 - 180 AS lon, elevation FROM fine_raster) r) t ON s.tile = t.tile", _tiles)

# --- polygons and population ---
_INSIDE = """SELECT row, col, arg_max(location_id, shape_order) AS location_id FROM (
  SELECT p.row, p.col, e.location_id, e.shape_order FROM fine_raster p JOIN edges e ON (e.y1 > p.row + 0.5) <> (e.y2 > p.row + 0.5)
    AND p.col + 0.5 < (e.x2 - e.x1) * (p.row + 0.5 - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY 1, 2, 3, 4 HAVING COUNT(*) % 2 = 1) t GROUP BY 1, 2"""


def _inside(x):
    centres = x.fine_raster.select("row", "col", (F.col("col") + 0.5).cast("double").alias("x"), (F.col("row") + 0.5).cast("double").alias("y"))
    return spatial.pixels_in_polygons(centres, x.edges)


query("pixel_in_polygon", "row:i col:i location_id:i", "fine_raster edges", _INSIDE, _inside)
def _inside_blocks(x):
    """Every block numbers its rows from 0, so that only block, row and column together tell a pixel."""
    pixels = x.population.select("block_key", (F.col("row") % 10).alias("row"), "col", (F.col("col") + 0.5).cast("double").alias("x"), (F.col("row") + 0.5).cast("double").alias("y"))
    return spatial.pixels_in_polygons(pixels, x.edges, tile=16.0, keys=("block_key", "row", "col"))


query("block_pixel_in_polygon", "block_key row:i col:i location_id:i", "population edges",
      f"SELECT p.block_key, p.row % 10 AS row, p.col, i.location_id FROM population p JOIN ({_INSIDE}) i ON i.row = p.row AND i.col = p.col", _inside_blocks)
query("shape_block_overlap", "block_key location_id:i col_start:i col_stop:i row_start:i row_stop:i", "bounds blocks",
      """SELECT block_key, location_id, GREATEST(0, LEAST(bxmax - bxmin, FLOOR(xmin - bxmin) - 10)) AS col_start, GREATEST(0, LEAST(bxmax - bxmin, CEIL(xmax - bxmin) + 10)) AS col_stop,
                GREATEST(0, LEAST(bymax - bymin, FLOOR(ymin - bymin) - 10)) AS row_start, GREATEST(0, LEAST(bymax - bymin, CEIL(ymax - bymin) + 10)) AS row_stop
         FROM blocks JOIN bounds ON xmin <= bxmax AND xmax >= bxmin AND ymin <= bymax AND ymax >= bymin""",
      lambda x: spatial.shapes_of_blocks(x.bounds, x.blocks))
query("shapes_with_latest_metadata", "location_id:i year_id:i population:d", "bounds leaf_facts",
      """SELECT b.location_id, f.year_id, f.population FROM bounds b LEFT JOIN (SELECT location_id - 1000 AS location_id, year_id, population FROM leaf_facts WHERE year_id = (SELECT MAX(year_id) FROM leaf_facts)) f
         ON b.location_id = f.location_id WHERE xmin <= 40 AND ymin <= 25""",
      lambda x: x.bounds.where("xmin <= 40 and ymin <= 25").join(
          x.leaf_facts.join(F.broadcast(x.leaf_facts.agg(F.max("year_id").alias("year_id"))), "year_id", "left_semi").withColumn("location_id", F.col("location_id") - 1000), "location_id", "left"))
query("list_blocks", "block_key", "population", "SELECT DISTINCT block_key FROM population", lambda x: x.population.select("block_key").distinct())
query("population_scan", "row:i col:i pop:d", "population", "SELECT row, col, pop FROM population WHERE block_key = 'B-2'", lambda x: x.population.where("block_key = 'B-2'"))
_CELL = "LEAST(GREATEST(CAST(FLOOR((row + 0.5) / 10) AS INT), 0), 4) AS lat_i, LEAST(GREATEST(CAST(FLOOR((col + 0.5) / 8) AS INT), 0), 4) AS lon_i"


def _cells(df):
    return df.withColumns({"lat_i": coordinates.clipped_cell(F.col("row") + 0.5, 0.0, 10.0, 5), "lon_i": coordinates.clipped_cell(F.col("col") + 0.5, 0.0, 8.0, 5)})


def _people(x):
    """Population by location and climate cell: pixels are summed before they meet the years."""
    return _cells(x.population).join(_inside(x), ["row", "col"]).groupBy("location_id", "lat_i", "lon_i").agg(F.sum("pop").alias("population"))


query("pixel_to_cell", "row:i col:i lat_i:i lon_i:i", "population", f"SELECT row, col, {_CELL} FROM population", lambda x: _cells(x.population))
query("pixel_weighted_climate", "location_id:i year:i weighted_climate:d population:d", "population edges daily_grid",
      f"""SELECT s.location_id, c.year, SUM(p.pop * c.value) AS weighted_climate, SUM(p.pop) AS population FROM (SELECT row, col, pop, {_CELL} FROM population) p
          JOIN ({_INSIDE}) s ON s.row = p.row AND s.col = p.col
          JOIN (SELECT year(date) AS year, lat_i, lon_i, AVG(value) AS value FROM daily_grid GROUP BY 1, 2, 3) c ON c.lat_i = p.lat_i AND c.lon_i = p.lon_i GROUP BY 1, 2""",
      lambda x: spatial.location_sums(
          _people(x).join(
              x.daily_grid.groupBy(F.year("date").alias("year"), "lat_i", "lon_i").agg(F.avg("value").alias("value")), ["lat_i", "lon_i"]), ["location_id", "year"]))
_A, _F = coordinates.AXIS, coordinates.FLATTENING
_E2 = _F * (2 - _F)
_E = _E2**0.5
query("equal_area_project", "station x:d y:d within:i", "stations",
      f"SELECT station, radians(lon) * {_A!r}::DOUBLE AS x, {_A / 2!r}::DOUBLE * {1 - _E2!r}::DOUBLE * (s / (1 - {_E2!r}::DOUBLE * s * s) - {1 / (2 * _E)!r}::DOUBLE * ln((1 - {_E!r}::DOUBLE * s) / (1 + {_E!r}::DOUBLE * s))) AS y, 1 AS within FROM (SELECT *, sin(radians(lat)) AS s FROM stations) t",
      lambda x: _projected(x.stations))


def _projected(df):
    px, py = coordinates.equal_area(F.col("lat"), F.col("lon"))
    back_lat, back_lon = coordinates.from_equal_area(F.col("x"), F.col("y"))
    near = (F.abs(back_lat - F.col("lat")) < 1e-6) & (F.abs(back_lon - F.col("lon")) < 1e-6)
    return df.withColumns({"x": px, "y": py}).withColumn("within", near.cast("int"))


# --- person-days ---
_BIN = "LEAST(GREATEST(CAST(FLOOR((CAST(round_even(value * 100, 0) AS BIGINT) + 3500) / 10) AS INT), 0), 799)"
_ZONE = "LEAST(GREATEST(CAST(FLOOR((CAST(round_even(value * 100, 0) AS BIGINT) + 2500) / 100) AS INT), 0), 59)"
query("digitize_bins", "date lat_i:i lon_i:i bin:i zone:i label:d", "daily_grid", f"SELECT date, lat_i, lon_i, {_BIN} AS bin, {_ZONE} AS zone, ROUND(-35 + {_BIN} * 0.1, 1) AS label FROM daily_grid",
      lambda x: x.daily_grid.select("date", "lat_i", "lon_i", coordinates.tenth_bin(F.col("value")).alias("bin"), coordinates.degree_bin(F.col("value")).alias("zone"), F.round(-35 + coordinates.tenth_bin(F.col("value")) * 0.1, 1).alias("label")))
_COUNTED = f"""SELECT d.lat_i, d.lon_i, d.year, d.temperature, z.zone, COUNT(*) AS n FROM (SELECT lat_i, lon_i, year(date) AS year, {_BIN} AS temperature FROM daily_grid) d
  JOIN (SELECT lat_i, lon_i, year, {_ZONE} AS zone FROM (SELECT lat_i, lon_i, year(date) AS year, AVG(value) AS value FROM daily_grid GROUP BY 1, 2, 3) a) z ON z.lat_i = d.lat_i AND z.lon_i = d.lon_i AND z.year = d.year GROUP BY 1, 2, 3, 4, 5"""
_PERSON = f"""SELECT s.location_id, c.year, c.temperature, c.zone, SUM(p.pop * c.n) AS person_days FROM (SELECT row, col, pop, {_CELL} FROM population) p
  JOIN ({_INSIDE}) s ON s.row = p.row AND s.col = p.col JOIN ({_COUNTED}) c ON c.lat_i = p.lat_i AND c.lon_i = p.lon_i GROUP BY 1, 2, 3, 4"""
KEYS = ["year", "temperature", "zone"]


def _person(x):
    cell = (F.col("lat_i") * 5 + F.col("lon_i")).alias("cell")
    people = _cells(x.population).join(_inside(x), ["row", "col"]).select("location_id", cell, F.col("pop").alias("population"))
    days = x.daily_grid.select(cell, F.year("date").alias("year"), coordinates.tenth_bin(F.col("value")).alias("temperature"))
    zones = x.daily_grid.groupBy(cell, F.year("date").alias("year")).agg(F.avg("value").alias("value")).select("cell", "year", coordinates.degree_bin(F.col("value")).alias("zone"))
    days = days.groupBy("cell", "year", "temperature").agg(F.count(F.lit(1)).alias("n")).join(zones, ["cell", "year"])
    return spatial.person_days(people, days, KEYS)


query("person_days", "location_id:i year:i temperature:i zone:i person_days:d", "population edges daily_grid", _PERSON, _person)
_TREE = "(VALUES (1, 1), (2, 2), (3, 3), (4, 4), (10, 1), (10, 2), (11, 3), (11, 4), (20, 1), (20, 2), (20, 3), (20, 4)) AS c(ancestor, descendant)"


def _tree(spark):
    """Two groups of the four shapes below one root."""
    return spark.createDataFrame([(20, 20), (10, 20), (11, 20), (1, 10), (2, 10), (3, 11), (4, 11)], "location_id int, parent_id int")


def _rolled(x):
    from meridian.operators.hierarchy import roll_up

    return roll_up(_person(x), _tree(x.spark), ["person_days"], KEYS)


query("person_days_rollup", "location_id:i year:i temperature:i zone:i person_days:d", "population edges daily_grid",
      f"SELECT ancestor AS location_id, year, temperature, zone, SUM(person_days) AS person_days FROM ({_PERSON}) p JOIN {_TREE} ON location_id = descendant GROUP BY 1, 2, 3, 4", _rolled)
_BY_ZONE = f"SELECT location_id, year, zone, SUM(person_days) AS person_days FROM ({_PERSON}) p GROUP BY 1, 2, 3"


def _by_zone(x):
    return _person(x).groupBy("location_id", "year", "zone").agg(F.sum("person_days").alias("person_days"))


query("dense_zero_fill", "location_id:i year:i zone:i person_days:d", "population edges daily_grid",
      f"""SELECT l.location_id, y.year, z.zone, COALESCE(p.person_days, 0) AS person_days FROM (SELECT DISTINCT location_id FROM ({_INSIDE}) a) l CROSS JOIN (SELECT DISTINCT year(date) AS year FROM daily_grid) y
          CROSS JOIN (SELECT CAST(range AS INT) AS zone FROM range(60)) z LEFT JOIN ({_BY_ZONE}) p ON p.location_id = l.location_id AND p.year = y.year AND p.zone = z.zone""",
      lambda x: spatial.zero_filled(_by_zone(x), [_inside(x).join(_cells(x.population), ["row", "col"]).select("location_id").distinct(), x.daily_grid.select(F.year("date").alias("year")).distinct(),
                                                  x.spark.range(60).select(F.col("id").cast("int").alias("zone"))], "person_days"))
_ZONES = range(20, 60)
query("pivot_bins", "location_id:i year:i " + " ".join(f"z{z}:d" for z in _ZONES), "population edges daily_grid",
      "SELECT location_id, year, " + ", ".join(f"COALESCE(SUM(person_days) FILTER (zone = {z}), 0) AS z{z}" for z in _ZONES) + f" FROM ({_BY_ZONE}) p GROUP BY 1, 2",
      lambda x: _by_zone(x).withColumn("z", F.concat(F.lit("z"), F.col("zone").cast("string"))).groupBy("location_id", "year").pivot("z", [f"z{z}" for z in _ZONES]).agg(F.sum("person_days")).na.fill(0.0))

_TENTHS = range(800)
query("pivot_temperature_bins", "location_id:i year:i zone:i " + " ".join(f"t{t}:d" for t in _TENTHS), "population edges daily_grid",
      "SELECT location_id, year, zone, " + ", ".join(f"COALESCE(SUM(person_days) FILTER (temperature = {t}), 0) AS t{t}" for t in _TENTHS) + f" FROM ({_PERSON}) p GROUP BY 1, 2, 3",
      lambda x: spatial.wide_bins(_person(x), ["location_id", "year", "zone"], "temperature", _TENTHS, "person_days"))

# --- products of rasters and stations ---
_WIDE = "SELECT CAST(FLOOR(row / 20) AS INT) AS r, CAST(FLOOR(col / 20) AS INT) AS c, AVG(elevation) AS wide FROM fine_raster GROUP BY 1, 2"
_FINE = "SELECT CAST(FLOOR(row / 5) AS INT) AS row, CAST(FLOOR(col / 5) AS INT) AS col, AVG(elevation) AS fine FROM fine_raster GROUP BY 1, 2"
_KIND = "SELECT row, col, class FROM (SELECT CAST(FLOOR(row / 5) AS INT) AS row, CAST(FLOOR(col / 5) AS INT) AS col, class, COUNT(*) AS n FROM fine_raster WHERE class IS NOT NULL GROUP BY 1, 2, 3) t QUALIFY ROW_NUMBER() OVER (PARTITION BY row, col ORDER BY n DESC, class) = 1"
_PREDICTORS = f"""SELECT f.row, f.col, f.fine AS elevation_target, w.wide AS elevation_coarse, w.wide - f.fine AS elevation_anomaly, k.class AS class_target FROM ({_FINE}) f
  LEFT JOIN ({_WIDE}) w ON w.r = CAST(FLOOR(f.row / 4) AS INT) AND w.c = CAST(FLOOR(f.col / 4) AS INT) LEFT JOIN ({_KIND}) k ON k.row = f.row AND k.col = f.col"""


def _predictors(x):
    return products.predictors(x.fine_raster.select("row", "col", "elevation"), x.fine_raster.select("row", "col", "class"), 5, 4)


query("downscale_predictors", "row:i col:i elevation_target:d elevation_coarse:d elevation_anomaly:d class_target:i", "fine_raster", _PREDICTORS, _predictors)


def _training(x):
    stations = x.stations.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day_no")))
    days = x.hourly.groupBy(F.to_date("ts").alias("date"), "latitude", "longitude").agg(F.avg("value").alias("value")).withColumn("value", units.kelvin_to_celsius(F.col("value")))
    return products.training_table(stations, days, _predictors(x), (50.0, -180.0), 9.0)


query("training_table", "station date latitude:d longitude:d temperature:d grid_temperature:d elevation:d class_target:i", "stations hourly fine_raster",
      f"""SELECT s.station, s.date, a.c AS latitude, o.c AS longitude, s.temperature, g.value AS grid_temperature, CASE WHEN s.elevation < -999 THEN p.elevation_target ELSE s.elevation END AS elevation, p.class_target FROM ({_CLEAN}) s
          JOIN (SELECT lat, arg_min(c, (abs(c - lat), -c)) AS c FROM (SELECT DISTINCT lat FROM stations) t CROSS JOIN (SELECT DISTINCT latitude AS c FROM ({_DAYS}) d) u GROUP BY lat) a ON a.lat = s.lat
          JOIN (SELECT lon, arg_min(c, (abs(c - lon), -c)) AS c FROM (SELECT DISTINCT lon FROM stations) t CROSS JOIN (SELECT DISTINCT longitude AS c FROM ({_DAYS}) d) u GROUP BY lon) o ON o.lon = s.lon
          JOIN (SELECT day, arg_min(c, (abs(c - day), -c)) AS c FROM (SELECT DISTINCT CAST(DATE '2024-01-01' + CAST(day_no AS INT) AS DATE) - DATE '1970-01-01' AS day FROM stations) t
                CROSS JOIN (SELECT DISTINCT CAST(date AS DATE) - DATE '1970-01-01' AS c FROM ({_DAYS}) d) u GROUP BY day) n ON n.day = CAST(s.date AS DATE) - DATE '1970-01-01'
          LEFT JOIN ({_DAYS}) g ON CAST(g.date AS DATE) - DATE '1970-01-01' = n.c AND g.latitude = a.c AND g.longitude = o.c
          LEFT JOIN ({_PREDICTORS}) p ON p.row = CAST(FLOOR((s.lat - 50) / -9.0) AS INT) AND p.col = CAST(FLOOR((s.lon + 180) / 9.0) AS INT)""", _training)  # fmt: skip
