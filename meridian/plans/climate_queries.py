"""Queries over hourly and daily grids: reductions, climatology, bias correction, series, regridding."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import coordinates, units

from meridian.operators import climate, grid, quality, spatial, temporal
from meridian.plans.fixtures import ORACLE, query
from meridian.plans import products
from meridian.plans.recipes import DAILY, suitability
from meridian.sources import scratch, tables

CELL = ["lat_i", "lon_i"]

# --- hourly ---
query("scan_hourly_variable", "event_id:i ts latitude:d longitude:d value:d", "hourly",
      "SELECT event_id, ts, latitude, longitude, value - 273.15 AS value FROM hourly WHERE variable = 'view'",
      lambda x: x.hourly.where("variable = 'view'").withColumn("value", units.kelvin_to_celsius(F.col("value"))))
query("wrap_longitude", "event_id:i longitude:d wrapped:d", "hourly",
      "SELECT event_id, longitude, CASE WHEN longitude >= 180 THEN longitude - 360 ELSE longitude END AS wrapped FROM hourly",
      lambda x: x.hourly.withColumn("wrapped", coordinates.wrap_longitude(F.col("longitude"))))
query("snap_axis", "event_id:i latitude:d longitude:d", "hourly",
      "SELECT event_id, ROUND((latitude + 0.01) / 0.1, 0) * 0.1 AS latitude, ROUND((longitude - 0.02) / 0.1, 0) * 0.1 AS longitude FROM hourly",
      lambda x: x.hourly.select("event_id", coordinates.snap(F.col("latitude") + 0.01).alias("latitude"), coordinates.snap(F.col("longitude") - 0.02).alias("longitude")))
query("unit_conversions", "event_id:i celsius:d millimetre:d rainfall:d wind:d fahrenheit_as_celsius:d", "hourly",
      """SELECT event_id, value - 273.15 AS celsius, value * 1000 AS millimetre, value * 86400 AS rainfall,
                value * log10(200) / log10(1000) AS wind, (value - 32) * 5 / 9 AS fahrenheit_as_celsius FROM hourly""",
      lambda x: x.hourly.select("event_id", units.kelvin_to_celsius(F.col("value")).alias("celsius"), units.metre_to_millimetre(F.col("value")).alias("millimetre"),
                                units.flux_to_rainfall(F.col("value")).alias("rainfall"), units.wind_at_two_metres(F.col("value")).alias("wind"),
                                units.fahrenheit_to_celsius(F.col("value")).alias("fahrenheit_as_celsius")))
query("calendar_parts", "event_id:i date year:i month:i dayofyear:i", "hourly",
      "SELECT event_id, CAST(ts AS DATE) AS date, year(ts) AS year, month(ts) AS month, dayofyear(ts) AS dayofyear FROM hourly",
      lambda x: x.hourly.select("event_id", F.to_date("ts").alias("date"), F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofyear("ts").alias("dayofyear")))
for how, fn in (("mean", "AVG"), ("max", "MAX"), ("min", "MIN"), ("sum", "SUM")):
    query(f"daily_{how}", "date lat_i:i lon_i:i value:d", "hourly",
          f"SELECT CAST(ts AS DATE) AS date, lat_i, lon_i, {fn}(value) AS value FROM hourly GROUP BY 1, 2, 3",
          lambda x, how=how: temporal.daily(x.hourly, how))
query("final_version_only", "event_id:i variable value:d", "hourly", "SELECT * FROM hourly WHERE expver = 1", lambda x: x.hourly.where("expver = 1"))


def _pair(x, a: str, b: str, recipe: str):
    """Daily means of two variables as the recipe's inputs, aligned by day and cell."""
    days = temporal.daily(x.hourly, "mean", ["variable", *CELL]).withColumnRenamed("date", "ts")
    return DAILY[recipe](*[days.where(F.col("variable") == v).drop("variable") for v in (a, b)])


_PAIR = """SELECT a.date, a.lat_i, a.lon_i, {0} AS value FROM
  (SELECT CAST(ts AS DATE) AS date, lat_i, lon_i, AVG(value) AS v FROM hourly WHERE variable = '{1}' GROUP BY 1, 2, 3) a JOIN
  (SELECT CAST(ts AS DATE) AS date, lat_i, lon_i, AVG(value) AS v FROM hourly WHERE variable = '{2}' GROUP BY 1, 2, 3) b
  ON a.date = b.date AND a.lat_i = b.lat_i AND a.lon_i = b.lon_i"""
_VP = """(CASE WHEN {0} > 0 THEN 6.1121 * exp((18.678 - ({0}) / 234.5) * ({0}) / (257.14 + ({0}))) ELSE 6.1115 * exp((23.036 - ({0}) / 333.7) * ({0}) / (279.82 + ({0}))) END)"""
query("wind_speed_daily", "date lat_i:i lon_i:i value:d", "hourly",
      _PAIR.format("log10(200) / log10(1000) * sqrt(a.v * a.v + b.v * b.v)", "view", "click"), lambda x: _pair(x, "view", "click", "wind_speed"))
query("relative_humidity_daily", "date lat_i:i lon_i:i value:d", "hourly",
      _PAIR.format("100 * " + _VP.format("b.v - 273.15") + " / " + _VP.format("a.v - 273.15"), "view", "click"), lambda x: _pair(x, "view", "click", "relative_humidity"))

# The same in the order of the products: hours are combined first, then averaged. Events are brought to hours.
_HOURS = "SELECT date_trunc('hour', ts) AS ts, variable, lat_i, lon_i, AVG(value) AS value FROM hourly GROUP BY 1, 2, 3, 4"
_BY_HOUR = """SELECT CAST(a.ts AS DATE) AS date, a.lat_i, a.lon_i, AVG({0}) AS value FROM (SELECT ts, lat_i, lon_i, value AS v FROM ({1}) h WHERE variable = 'view') a
  JOIN (SELECT ts, lat_i, lon_i, value AS v FROM ({1}) h WHERE variable = 'click') b ON a.ts = b.ts AND a.lat_i = b.lat_i AND a.lon_i = b.lon_i GROUP BY 1, 2, 3"""


def _hours(x, *variables: str):
    hours = x.hourly.groupBy(F.date_trunc("hour", "ts").alias("ts"), "variable", *CELL).agg(F.avg("value").alias("value"))
    return [hours.where(F.col("variable") == v).drop("variable") for v in variables]


query("historical_wind_speed", "date lat_i:i lon_i:i value:d", "hourly", _BY_HOUR.format("log10(200) / log10(1000) * sqrt(a.v * a.v + b.v * b.v)", _HOURS), lambda x: DAILY["wind_speed"](*_hours(x, "view", "click")))
query("historical_relative_humidity", "date lat_i:i lon_i:i value:d", "hourly", _BY_HOUR.format("100 * " + _VP.format("b.v - 273.15") + " / " + _VP.format("a.v - 273.15"), _HOURS),
      lambda x: DAILY["relative_humidity"](*_hours(x, "view", "click")))
for _name, _sql, _dataset in (
    ("mean_temperature", "AVG(value) - 273.15", None), ("max_temperature", "MAX(value) - 273.15", None), ("min_temperature", "MIN(value) - 273.15", None),
    ("sea_surface_temperature", "AVG(value) - 273.15", None), ("total_precipitation", "MAX(value) * 1000", "land"), ("total_precipitation", "SUM(value) * 1000", "single"),
):
    query(f"historical_{_name}" + (f"_{_dataset}" if _dataset else ""), "date lat_i:i lon_i:i value:d", "hourly",
          f"SELECT CAST(ts AS DATE) AS date, lat_i, lon_i, {_sql} AS value FROM hourly WHERE variable = 'view' GROUP BY 1, 2, 3",
          lambda x, name=_name, dataset=_dataset: DAILY[name](x.hourly.where("variable = 'view'").select("ts", *CELL, "value"), dataset=dataset))

# --- daily to annual ---
for how, fn in (("mean", "AVG"), ("max", "MAX"), ("min", "MIN"), ("sum", "SUM")):
    query(f"annual_{how}", "year:i lat_i:i lon_i:i value:d", "daily_grid",
          f"SELECT year(date) AS year, lat_i, lon_i, {fn}(value) AS value FROM daily_grid GROUP BY 1, 2, 3",
          lambda x, how=how: temporal.annual(x.daily_grid, how))
query("monthly_mean", "year:i month:i lat_i:i lon_i:i value:d", "daily_grid",
      "SELECT year(date) AS year, month(date) AS month, lat_i, lon_i, AVG(value) AS value FROM daily_grid GROUP BY 1, 2, 3, 4",
      lambda x: temporal.monthly_mean(x.daily_grid))
_CLIMATOLOGY = """SELECT month, lat_i, lon_i, AVG(value) AS value FROM
  (SELECT year(date) AS year, month(date) AS month, lat_i, lon_i, AVG(value) AS value FROM {0} WHERE year(date) BETWEEN 1995 AND 1999 GROUP BY 1, 2, 3, 4) t GROUP BY 1, 2, 3"""
query("reference_climatology", "month:i lat_i:i lon_i:i value:d", "daily_grid", _CLIMATOLOGY.format("daily_grid"),
      lambda x: temporal.climatology(climate.window(x.daily_grid, 1995, 1999)))
query("reference_window", "date lat_i:i lon_i:i value:d", "daily_grid", "SELECT * FROM daily_grid WHERE year(date) BETWEEN 1995 AND 1999",
      lambda x: climate.window(x.daily_grid, 1995, 1999))
_POOLED = "SELECT month(date) AS month, lat_i, lon_i, AVG(value) AS value FROM {0} WHERE year(date) BETWEEN 1995 AND 1999 GROUP BY 1, 2, 3"
query("member_monthly_mean", "month:i lat_i:i lon_i:i value:d", "grid_region", _POOLED.format("grid_region"),
      lambda x: temporal.pooled_monthly_mean(climate.window(x.grid_region, 1995, 1999)))
query("threshold_days", "year:i lat_i:i lon_i:i days:i", "daily_grid",
      "SELECT year(date) AS year, lat_i, lon_i, COUNT(*) FILTER (value > 30) AS days FROM daily_grid GROUP BY 1, 2, 3",
      lambda x: temporal.annual_days(x.daily_grid, temporal.over(F.col("value"), 30.0)))
query("between_days", "year:i lat_i:i lon_i:i days:i", "daily_grid",
      "SELECT year(date) AS year, lat_i, lon_i, COUNT(*) FILTER (value > 10 AND value < 20) AS days FROM daily_grid GROUP BY 1, 2, 3",
      lambda x: temporal.annual_days(x.daily_grid, temporal.between(F.col("value"), 10.0, 20.0)))
query("precipitation_days", "year:i lat_i:i lon_i:i days:i", "daily_grid",
      "SELECT year(date) AS year, lat_i, lon_i, COUNT(*) FILTER (precip > 0.55) AS days FROM daily_grid GROUP BY 1, 2, 3",
      lambda x: temporal.annual_days(x.daily_grid, temporal.over(F.col("precip"), 0.55)))
query("suitability_sum", "year:i lat_i:i lon_i:i value:d", "daily_grid",
      """SELECT year(date) AS year, lat_i, lon_i, SUM(CASE WHEN value <= 15 THEN 0.0 WHEN value < 20 THEN 0.2 * (value - 15) / 5 WHEN value < 25 THEN 0.2 + 0.8 * (value - 20) / 5
           WHEN value < 29 THEN 1 - 0.2 * (value - 25) / 4 WHEN value < 34 THEN 0.8 - 0.8 * (value - 29) / 5 ELSE 0 END) AS value FROM daily_grid GROUP BY 1, 2, 3""",
      lambda x: suitability(x.knots)(x.daily_grid))
query("validate_daily_cube", "year:i first_day last_day days:i cells:i missing:i rows:i valid", "daily_grid",
      """SELECT year(date) AS year, MIN(date) AS first_day, MAX(date) AS last_day, COUNT(DISTINCT date) AS days, COUNT(DISTINCT lat_i * 100 + lon_i) AS cells,
                COUNT(*) FILTER (value IS NULL) AS missing, COUNT(*) AS rows,
                COUNT(*) = 25 * dayofyear(make_date(year(date), 12, 31)) AND COUNT(DISTINCT date) = dayofyear(make_date(year(date), 12, 31))
                  AND COUNT(DISTINCT lat_i * 100 + lon_i) = 25 AND COUNT(*) FILTER (value IS NULL) = 0 AS valid
         FROM daily_grid GROUP BY year(date)""",
      lambda x: quality.daily_cube(x.daily_grid, 25))
query("empty_slices", "year:i month:i cell:i", "daily_region daily_grid",
      """SELECT m.year, m.month, c.cell FROM (SELECT DISTINCT year(date) AS year, month(date) AS month FROM daily_grid) m
         CROSS JOIN (SELECT n_nationkey AS cell FROM nation) c
         WHERE NOT EXISTS (SELECT 1 FROM daily_grid g WHERE year(g.date) = m.year AND month(g.date) = m.month AND g.lat_i * 5 + g.lon_i = c.cell AND g.value > 30)""",
      lambda x: quality.empty_slices(
          x.daily_grid.select(F.year("date").alias("year"), F.month("date").alias("month")).distinct().crossJoin(F.broadcast(x.nation.select(F.col("n_nationkey").alias("cell")))),
          x.daily_grid.where("value > 30").select(F.year("date").alias("year"), F.month("date").alias("month"), (F.col("lat_i") * 5 + F.col("lon_i")).alias("cell")), ["year", "month", "cell"]))
query("bbox_slice", "date latitude:d longitude:d value:d", "daily_grid",
      "SELECT * FROM daily_grid WHERE latitude BETWEEN -10.1 AND 10.1 AND longitude BETWEEN -10.1 AND 20.1",
      lambda x: x.daily_grid.where(F.col("latitude").between(max(-90.0, -10 - 0.1), min(90.0, 10 + 0.1)) & F.col("longitude").between(max(-180.0, -10 - 0.1), min(180.0, 20 + 0.1))))

# --- anomalies and bias correction ---
_ANOMALY = """SELECT t.date, t.lat_i, t.lon_i, {0} AS value FROM daily_grid t JOIN (""" + _POOLED.format("daily_grid") + """) r
  ON month(t.date) = r.month AND t.lat_i = r.lat_i AND t.lon_i = r.lon_i WHERE year(t.date) >= 2000"""  # fmt: skip
_FORMS = {"additive": ("t.value - r.value", "+"), "multiplicative": ("(t.value + 1) / (r.value + 1)", "*")}


def _anomaly(x, kind: str):
    forecast = x.daily_grid.where(F.col("date") >= F.lit("2000-01-01").cast("date"))
    return climate.anomaly(forecast, temporal.pooled_monthly_mean(climate.window(x.daily_grid, 1995, 1999)), kind)


for kind, (form, sign) in _FORMS.items():
    query(f"anomaly_{kind}", "date lat_i:i lon_i:i value:d", "daily_grid", _ANOMALY.format(form), lambda x, kind=kind: _anomaly(x, kind))
    query(f"bias_correct_{kind}", "date lat_i:i lon_i:i value:d", "daily_grid grid_region",
          f"SELECT a.date, a.lat_i, a.lon_i, h.value {sign} a.value AS value FROM ({_ANOMALY.format(form)}) a JOIN ({_CLIMATOLOGY.format('grid_region')}) h ON month(a.date) = h.month AND a.lat_i = h.lat_i AND a.lon_i = h.lon_i",
          lambda x, kind=kind: climate.bias_correct(_anomaly(x, kind), temporal.climatology(climate.window(x.grid_region, 1995, 1999)), kind))

#: A second component, and values before their units are changed, for the products of model members.
_MEMBER = "SELECT date, lat_i, lon_i, value AS v, precip AS u FROM daily_grid"
_SCENARIO = {
    "mean_temperature": ("v - 273.15", "r.value", "h.value + (t.value - r.value)"), "max_temperature": ("v - 273.15", "r.value", "h.value + (t.value - r.value)"),
    "min_temperature": ("v - 273.15", "r.value", "h.value + (t.value - r.value)"),
    "wind_speed": ("log10(200) / log10(1000) * sqrt(v * v + u * u)", "r.value", "h.value * ((t.value + 1) / (r.value + 1))"),
    "relative_humidity": ("v", "r.value", "h.value * ((t.value + 1) / (r.value + 1))"), "total_precipitation": ("v * 86400", "r.value", "h.value * ((t.value + 1) / (r.value + 1))"),
}


def _scenario(x, name: str):
    value, other = x.daily_grid.select("date", *CELL, "value"), x.daily_grid.select("date", *CELL, F.col("precip").alias("value"))
    sources = [value, other] if name == "wind_speed" else [value]
    members = [s.where(F.col("date") >= F.lit("2000-01-01").cast("date")) for s in sources]
    history = temporal.climatology(climate.window(x.grid_region, 1995, 1999))
    return products.scenario_variable(name, members, [climate.window(s, 1995, 1999) for s in sources], history)


for _name, (_value, _, _form) in _SCENARIO.items():
    query(f"scenario_{_name}", "date lat_i:i lon_i:i value:d", "daily_grid grid_region",
          f"""SELECT t.date, t.lat_i, t.lon_i, {_form} AS value FROM (SELECT date, lat_i, lon_i, {_value} AS value FROM ({_MEMBER}) m WHERE year(date) >= 2000) t
              JOIN (SELECT month(date) AS month, lat_i, lon_i, AVG({_value}) AS value FROM ({_MEMBER}) m WHERE year(date) BETWEEN 1995 AND 1999 GROUP BY 1, 2, 3) r ON r.month = month(t.date) AND r.lat_i = t.lat_i AND r.lon_i = t.lon_i
              JOIN ({_CLIMATOLOGY.format('grid_region')}) h ON h.month = month(t.date) AND h.lat_i = t.lat_i AND h.lon_i = t.lon_i""",
          lambda x, name=_name: _scenario(x, name))

# --- series ---
query("spliced_daily_series", "date lat_i:i lon_i:i value:d", "daily_grid grid_region",
      "SELECT date, lat_i, lon_i, value FROM daily_grid WHERE year(date) < 2000 UNION ALL SELECT date, lat_i, lon_i, value FROM grid_region WHERE year(date) >= 2000",
      lambda x: climate.splice(x.daily_grid.select("date", *CELL, "value"), x.grid_region.select("date", *CELL, "value"), 2000))
query("coalesce_sources", "date lat_i:i lon_i:i value:d", "daily_grid grid_region",
      "SELECT COALESCE(a.date, b.date) AS date, COALESCE(a.lat_i, b.lat_i) AS lat_i, COALESCE(a.lon_i, b.lon_i) AS lon_i, COALESCE(a.value, b.value) AS value FROM daily_grid a FULL JOIN grid_region b ON a.date = b.date AND a.lat_i = b.lat_i AND a.lon_i = b.lon_i",
      lambda x: climate.coalesce_sources(x.daily_grid, x.grid_region, ["date", *CELL]))
query("extend_last_year", "date cell:i value:d", "daily_region",
      """SELECT date, cell, value FROM daily_region WHERE year(date) < 2001 UNION ALL
         SELECT CAST(date + INTERVAL 366 DAY AS DATE), cell, value FROM daily_region WHERE year(date) = 2000""",
      lambda x: climate.extend_last_year(x.daily_region.where(F.year("date") < 2001).select("date", "cell", "value"), 2000, ["cell"]))
query("member_year_scan", "date cell:i value:d", "daily_region",
      """SELECT date, cell, value FROM daily_region WHERE year(date) BETWEEN 1995 AND 1999 UNION ALL
         SELECT date, cell, value FROM daily_region WHERE year(date) = 2000""",
      lambda x: climate.window(x.daily_region, 1995, 1999).unionByName(climate.window(x.daily_region, 2000, 2000)).select("date", "cell", "value"))
query("calendar_align", "cell:i date value:d", "model_calendar",
      """SELECT cell, date, CASE WHEN lo IS NULL THEN hv WHEN hi IS NULL OR lo = hi THEN lv ELSE lv + (hv - lv) * (pos - lo) / (hi - lo) END AS value FROM (
           SELECT *, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER b AS lo, last_value(value IGNORE NULLS) OVER b AS lv,
                  first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER f AS hi, first_value(value IGNORE NULLS) OVER f AS hv FROM (
             SELECT cell, year + (dayofyear - 1) / days_in_year::DOUBLE AS pos, value, NULL::DATE AS date FROM model_calendar UNION ALL
             SELECT cell, year + (dayofyear(d) - 1) / dayofyear(make_date(year, 12, 31))::DOUBLE, NULL, d FROM (
               SELECT cell, year, CAST(UNNEST(generate_series(make_date(year, 1, 1)::TIMESTAMP, make_date(year, 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d
               FROM (SELECT DISTINCT cell, CAST(year AS INT) AS year FROM model_calendar) y) z) u
           WINDOW b AS (PARTITION BY cell ORDER BY pos RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY cell ORDER BY pos RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) w
         WHERE date IS NOT NULL""",
      lambda x: climate.align_calendar(x.model_calendar, ["cell"]))

query("member_scan", "cell:i date value:d", "model_calendar",
      f"""WITH a AS ({ORACLE['calendar_align']}) SELECT cell, date, value FROM a WHERE year(date) BETWEEN 1999 AND 2001 UNION ALL
          SELECT cell, CAST(date + INTERVAL 365 DAY AS DATE), value FROM a WHERE year(date) = 2001 AND NOT EXISTS (SELECT 1 FROM a b WHERE b.cell = a.cell AND year(b.date) = 2002)""",
      lambda x: climate.member_scan(x.model_calendar, ["cell"], (1999, 2002), last=2001))
query("member_reference_scan", "cell:i date value:d", "model_calendar",
      "SELECT cell, CAST(make_date(year, 1, 1) + CAST(dayofyear - 1 AS INT) AS DATE) AS date, value FROM model_calendar WHERE year BETWEEN 1995 AND 1999",
      lambda x: climate.member_scan(x.model_calendar, ["cell"], reference=(1995, 1999)))

# --- grids ---
query("grid_template", "row:i col:i x:d y:d nation:i", "daily_grid",
      """SELECT r AS row, c AS col, -22.5 + (c + 0.5) * 5 AS x, 22.5 - (r + 0.5) * 5 AS y, n_nationkey AS nation FROM range(9) t(r), range(9) u(c)
         LEFT JOIN nation ON CAST(FLOOR(n_nationkey / 5) AS INT) = CAST(FLOOR(r / 2) AS INT) AND n_nationkey % 5 = CAST(FLOOR(c / 2) AS INT) AND r % 2 = 0 AND c % 2 = 0""",
      lambda x: grid.template(x.spark, -22.5, -22.5, 45.0, 5.0).join(
          x.nation.select((F.floor(F.col("n_nationkey") / 5) * 2).cast("int").alias("row"), (F.col("n_nationkey") % 5 * 2).alias("col"), F.col("n_nationkey").alias("nation")), ["row", "col"], "left"))
_AXIS = """SELECT t.coord, CASE WHEN hi IS NOT NULL THEN lo END AS lo, CASE WHEN lo IS NOT NULL THEN hi END AS hi, CASE WHEN lo = hi THEN 0.0 ELSE (t.coord - lo) / (hi - lo) END AS weight
  FROM {0} t LEFT JOIN (SELECT t.coord, (SELECT MAX({1}) FROM daily_grid WHERE {1} <= t.coord) AS lo, (SELECT MIN({1}) FROM daily_grid WHERE {1} >= t.coord) AS hi FROM {0} t) b ON t.coord = b.coord"""
query("axis_brackets", "coord:d lo:d hi:d weight:d", "daily_grid target_lat", _AXIS.format("target_lat", "latitude"),
      lambda x: grid.brackets(x.daily_grid.select(F.col("latitude").alias("coord")).distinct(), x.target_lat))
_TARGETS = "(SELECT DISTINCT date FROM daily_grid) d CROSS JOIN target_lat a CROSS JOIN target_lon o"
query("regrid_bilinear", "date latitude:d longitude:d value:d", "daily_grid target_lat target_lon",
      f"""SELECT d.date, a.coord AS latitude, o.coord AS longitude, CASE WHEN v.have = v.need THEN v.value END AS value FROM {_TARGETS}
          LEFT JOIN (SELECT g.date, y.coord AS lat, x.coord AS lon, SUM(y.w * x.w * g.value) AS value, COUNT(*) AS have, MAX(y.n * x.n) AS need FROM daily_grid g
            JOIN (SELECT *, COUNT(*) OVER (PARTITION BY coord) AS n FROM (SELECT coord, lo AS s, 1 - weight AS w FROM ({_AXIS.format('target_lat', 'latitude')}) p UNION ALL SELECT coord, hi, weight FROM ({_AXIS.format('target_lat', 'latitude')}) q) e WHERE w > 0) y ON y.s = g.latitude
            JOIN (SELECT *, COUNT(*) OVER (PARTITION BY coord) AS n FROM (SELECT coord, lo AS s, 1 - weight AS w FROM ({_AXIS.format('target_lon', 'longitude')}) p UNION ALL SELECT coord, hi, weight FROM ({_AXIS.format('target_lon', 'longitude')}) q) e WHERE w > 0) x ON x.s = g.longitude
            GROUP BY 1, 2, 3) v ON v.date = d.date AND v.lat = a.coord AND v.lon = o.coord""",
      lambda x: grid.bilinear(x.daily_grid, x.target_lat, x.target_lon))
_NODE = "(SELECT coord, CASE WHEN weight <= 0.5 THEN lo ELSE hi END AS s FROM ({0}) p WHERE lo IS NOT NULL)"
query("regrid_nearest", "date latitude:d longitude:d value:d", "daily_grid target_lat target_lon",
      f"""SELECT d.date, a.coord AS latitude, o.coord AS longitude, g.value FROM {_TARGETS}
          LEFT JOIN {_NODE.format(_AXIS.format('target_lat', 'latitude'))} y ON y.coord = a.coord LEFT JOIN {_NODE.format(_AXIS.format('target_lon', 'longitude'))} x ON x.coord = o.coord
          LEFT JOIN daily_grid g ON g.date = d.date AND g.latitude = y.s AND g.longitude = x.s""",
      lambda x: grid.nearest(x.daily_grid, x.target_lat, x.target_lon))
_FILL = """SELECT date, latitude, longitude, CASE WHEN lo IS NULL THEN hv WHEN hi IS NULL OR {1} - lo <= hi - {1} THEN lv ELSE hv END AS value FROM (
  SELECT *, last_value(CASE WHEN value IS NOT NULL THEN {1} END IGNORE NULLS) OVER b AS lo, last_value(value IGNORE NULLS) OVER b AS lv,
         first_value(CASE WHEN value IS NOT NULL THEN {1} END IGNORE NULLS) OVER f AS hi, first_value(value IGNORE NULLS) OVER f AS hv FROM {0}
  WINDOW b AS (PARTITION BY date, {2} ORDER BY {1} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY date, {2} ORDER BY {1} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) w"""
query("nearest_fill_axis", "date latitude:d longitude:d value:d", "dense_grid", _FILL.format("(" + _FILL.format("dense_grid", "longitude", "latitude") + ") z", "latitude", "longitude"),
      lambda x: grid.fill_gaps(x.dense_grid))

_BLOCKS = "(VALUES ('A', -10.0, 0.0, -20.0, -10.0), ('B', -20.0, 20.0, 0.0, 20.0), ('C', 85.0, 90.0, 170.0, 180.0)) AS b(block_key, lat_min, lat_max, lon_min, lon_max)"
query("block_bbox_slice", "block_key date latitude:d longitude:d value:d", "daily_grid",
      f"""SELECT b.block_key, g.date, g.latitude, g.longitude, g.value FROM daily_grid g JOIN {_BLOCKS}
          ON g.latitude BETWEEN GREATEST(-90, lat_min - 0.1) AND LEAST(90, lat_max + 0.1) AND g.longitude BETWEEN GREATEST(-180, lon_min - 0.1) AND LEAST(180, lon_max + 0.1)""",
      lambda x: spatial.block_slice(x.daily_grid.select("date", "latitude", "longitude", "value"), x.spark.sql(f"SELECT block_key, CAST(lat_min AS DOUBLE) lat_min, CAST(lat_max AS DOUBLE) lat_max, CAST(lon_min AS DOUBLE) lon_min, CAST(lon_max AS DOUBLE) lon_max FROM {_BLOCKS}")))


def _historical(x):
    """Land data with gaps on the grid, region means as the coarser source, both brought to a finer grid."""
    single = x.grid_region.select("date", (20.0 - 10 * F.col("lat_i")).alias("latitude"), (-20.0 + 10 * F.col("lon_i")).alias("longitude"), "value")
    land = x.daily_grid.select("date", "latitude", "longitude", "value")
    return products.historical_daily(*[climate.window(df, 2000, 2000) for df in (land, single)], x.target_lat.where("coord >= -20"), x.target_lon.where("coord <= 20"))


_BOTH = "SELECT COALESCE(a.date, b.date) AS date, COALESCE(a.latitude, b.latitude) AS latitude, COALESCE(a.longitude, b.longitude) AS longitude, COALESCE(a.value, b.value) AS value FROM (SELECT date, latitude, longitude, value FROM daily_grid WHERE year(date) = 2000) a FULL JOIN (SELECT date, CAST(20 - 10 * lat_i AS DOUBLE) AS latitude, CAST(-20 + 10 * lon_i AS DOUBLE) AS longitude, value FROM grid_region WHERE year(date) = 2000) b ON a.date = b.date AND a.latitude = b.latitude AND a.longitude = b.longitude"
_STEPS = "(SELECT CAST(20 - 5 * i AS DOUBLE) AS c, CAST(20 - 10 * FLOOR(i / 2) AS DOUBLE) AS hi, CAST(20 - 10 * CEIL(i / 2.0) AS DOUBLE) AS lo FROM range(9) t(i))"
_EAST = "(SELECT CAST(-20 + 5 * i AS DOUBLE) AS c, CAST(-20 + 10 * FLOOR(i / 2) AS DOUBLE) AS lo, CAST(-20 + 10 * CEIL(i / 2.0) AS DOUBLE) AS hi FROM range(9) t(i))"
_GRID = f"""SELECT d.date, y.c AS latitude, x.c AS longitude, (a.value + b.value + c.value + e.value) / 4 AS value FROM (SELECT DISTINCT date FROM ({_BOTH}) q) d CROSS JOIN {_STEPS} y CROSS JOIN {_EAST} x
  LEFT JOIN ({_BOTH}) a ON a.date = d.date AND a.latitude = y.lo AND a.longitude = x.lo LEFT JOIN ({_BOTH}) b ON b.date = d.date AND b.latitude = y.lo AND b.longitude = x.hi
  LEFT JOIN ({_BOTH}) c ON c.date = d.date AND c.latitude = y.hi AND c.longitude = x.lo LEFT JOIN ({_BOTH}) e ON e.date = d.date AND e.latitude = y.hi AND e.longitude = x.hi"""
query("historical_daily_grid", "date latitude:d longitude:d value:d", "daily_grid grid_region target_lat target_lon", _FILL.format("(" + _FILL.format(f"({_GRID}) g", "longitude", "latitude") + ") z", "latitude", "longitude"), _historical)

# --- sinks ---
def _roundtrip(x):
    path = scratch.path(x.spark, "packed")
    daily = x.daily_grid.select(F.year("date").alias("year"), "date", *CELL, "value")
    tables.write_packed(daily, path, 0.01, ["year"])
    return tables.read_packed(x.spark, path, 0.01)


query("write_packed_roundtrip", "date lat_i:i lon_i:i value:d", "daily_grid",
      "SELECT date, lat_i, lon_i, round_even(value / 0.01, 0) * 0.01 AS value FROM daily_grid", _roundtrip)
_TASKS = "SELECT DISTINCT v.variable, year(date) AS year FROM daily_grid CROSS JOIN (SELECT DISTINCT event_type AS variable FROM events) v"
query("incremental_worklist", "variable year:i", "daily_grid", f"SELECT * FROM ({_TASKS}) t WHERE year % 2 = 1",
      lambda x: quality.remaining(
          t := x.daily_grid.select(F.year("date").alias("year")).distinct().crossJoin(F.broadcast(x.events.select(F.col("event_type").alias("variable")).distinct())),
          t.where("year % 2 = 0"), ["variable", "year"]))

_DUE = "SELECT DISTINCT v.variable, year(date) AS year FROM daily_grid CROSS JOIN (SELECT DISTINCT event_type AS variable FROM events) v"
query("worklist_counts", "variable to_run:i complete:i", "daily_grid",
      f"SELECT variable, COUNT(*) FILTER (year % 2 = 1) AS to_run, COUNT(*) FILTER (year % 2 = 0) AS complete FROM ({_DUE}) t GROUP BY 1",
      lambda x: quality.work_counts(
          t := x.daily_grid.select(F.year("date").alias("year")).distinct().crossJoin(F.broadcast(x.events.select(F.col("event_type").alias("variable")).distinct())),
          t.where("year % 2 = 0"), ["variable", "year"], ["variable"]))
query("packing_overflow", "date lat_i:i lon_i:i value:d", "daily_grid", "SELECT date, lat_i, lon_i, value FROM daily_grid WHERE abs(round_even(value / 0.001, 0)) > 32767 OR round_even(value / 0.001, 0) = -32767",
      lambda x: quality.beyond_packing(x.daily_grid, 0.001))
_HOLES = "CASE WHEN (lat_i + lon_i + dayofyear(date)) % 7 = 0 THEN {0} ELSE value END"


def _with_nan(x):
    """A table as a sensor's file may hold it, NaN where it has no value, read back through the library's scan."""
    path = scratch.path(x.spark, "with-nan")
    x.daily_grid.select("date", *CELL, "latitude", "longitude", F.expr(_HOLES.format("double('NaN')")).alias("value")).write.parquet(path)
    return tables.read(x.spark, path)


query("scan_without_nan", "year:i lat_i:i lon_i:i mean:d total:d days:i", "daily_grid",
      f"SELECT year(date) AS year, lat_i, lon_i, AVG(v) AS mean, COALESCE(SUM(v), 0) AS total, COUNT(*) FILTER (v > 30) AS days FROM (SELECT *, {_HOLES.format('NULL')} AS v FROM daily_grid) t GROUP BY 1, 2, 3",
      lambda x: _with_nan(x).groupBy(F.year("date").alias("year"), *CELL).agg(F.avg("value").alias("mean"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"), F.count_if(temporal.over(F.col("value"), 30.0)).alias("days")))


def _problems(x):
    """The grid against axes shifted by one step in longitude, with gaps, a column too many and values of a wrong type beside."""
    cube = _with_nan(x).select("date", "latitude", "longitude", "value", "lat_i")
    lat, lon = (x.daily_grid.select(c.alias("coord")).distinct() for c in (F.col("latitude"), F.col("longitude") + 10))
    return quality.cube_problems(cube, lat, lon)


query("cube_problems", "year:i problem", "daily_grid",
      f"""WITH c AS (SELECT year(date) AS year, date, longitude, {_HOLES.format('NULL')} AS v FROM daily_grid), y AS (SELECT DISTINCT year FROM c), a AS (SELECT DISTINCT longitude + 10 AS lon FROM daily_grid)
          SELECT NULL AS year, 'extra column lat_i' AS problem UNION ALL SELECT year, 'first day' FROM c GROUP BY 1 HAVING MIN(date) <> make_date(year, 1, 1) UNION ALL
          SELECT year, 'last day' FROM c GROUP BY 1 HAVING MAX(date) <> make_date(year, 12, 31) UNION ALL SELECT year, 'number of days' FROM c GROUP BY 1 HAVING COUNT(DISTINCT date) <> dayofyear(make_date(year, 12, 31)) UNION ALL
          SELECT year, 'missing values' FROM c GROUP BY 1 HAVING COUNT(*) FILTER (v IS NULL) > 0 UNION ALL
          SELECT DISTINCT year, 'longitude off the axis' FROM c WHERE longitude NOT IN (SELECT lon FROM a) UNION ALL
          SELECT DISTINCT y.year, 'longitude lacking' FROM y CROSS JOIN a WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.year = y.year AND c.longitude = a.lon) UNION ALL
          SELECT DISTINCT y.year, 'latitude lacking' FROM y CROSS JOIN (SELECT DISTINCT latitude FROM daily_grid) l WHERE NOT EXISTS (SELECT 1 FROM daily_grid g WHERE year(g.date) = y.year AND g.latitude = l.latitude)""", _problems)  # fmt: skip
