"""Products over small tables whose results can be told by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from meridian.functions import units
from meridian.plans import products

DAY = datetime.date


def axis(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "coord double")


def cube(spark, dates, lats, lons, value):
    rows = [(d, float(y), float(x), value(d, y, x)) for d in dates for y in lats for x in lons]
    return spark.createDataFrame(rows, "date date, latitude double, longitude double, value double")


def test_scenario_daily(spark):
    window = cube(spark, [DAY(2020, 1, 1), DAY(2021, 1, 1)], (0, 2), (0, 2), lambda d, y, x: 10.0 + d.year - 2020)
    member = cube(spark, [DAY(2050, 1, 5)], (0, 2), (0, 2), lambda d, y, x: 12.5)
    historical = spark.createDataFrame([(1, float(y), float(x), 20.0) for y in (0, 1, 2, 3) for x in (0, 1, 2)], "month int, latitude double, longitude double, value double")
    out = products.scenario_daily(member, window, historical, "additive", axis(spark, (0, 1, 2, 3)), axis(spark, (0, 1, 2))).collect()
    assert len(out) == 12 and {r["value"] for r in out} == {22.0}  # beyond the member's grid by the nearest
    out = products.scenario_daily(member, window, historical, "multiplicative", axis(spark, (0, 1)), axis(spark, (0, 1))).collect()
    assert {round(r["value"], 9) for r in out} == {round(20 * 13.5 / 11.5, 9)}


def test_historical_daily(spark):
    land = cube(spark, [DAY(2000, 1, 1)], (0, 1), (0, 1), lambda d, y, x: None if (y, x) == (1, 1) else 1.0)
    single = cube(spark, [DAY(2000, 1, 1)], (0, 2), (0, 2), lambda d, y, x: 5.0)
    out = {(r["latitude"], r["longitude"]): r["value"] for r in products.historical_daily(land, single, axis(spark, (0, 1)), axis(spark, (0, 1, 2))).collect()}
    assert out[0, 0] == 1.0 and out[1, 1] == 5.0 and out[1, 2] == 5.0 and out[0, 2] == 1.0
    sea = products.sea_surface_daily(single, axis(spark, (0, 1, 3)), axis(spark, (0,))).collect()
    assert {r["value"] for r in sea} == {5.0} and len(sea) == 3


def test_aligned(spark):
    u = cube(spark, [DAY(2000, 1, 1)], (0, 1), (0, 1), lambda d, y, x: 3.0)
    v = cube(spark, [DAY(2000, 1, 1)], (0, 2), (0, 2), lambda d, y, x: 4.0)
    assert {r["value"] for r in products.aligned([u, v], units.magnitude).collect()} == {5.0}


def test_reference_and_zones(spark):
    daily = cube(spark, [DAY(2019, 1, 1), DAY(2019, 1, 2), DAY(2023, 1, 1), DAY(2024, 1, 1)], (0,), (0,), lambda d, y, x: float(d.year - 2018))
    assert [r["value"] for r in products.reference(daily).collect()] == [3.0]
    annual = spark.createDataFrame([(0, y, float(y)) for y in range(1985, 1996)], "cell int, year int, value double")
    zones = {r["year"]: r["value"] for r in products.temperature_zone(annual, ["cell"], years=5).collect()}
    assert zones[1990] == 1988.0 and min(zones) == 1990


def test_locations(spark):
    values = spark.createDataFrame([(0, 2000, "a", "m", 10.0), (1, 2000, "a", "m", 20.0)], "cell int, year_id int, scenario string, measure string, value double")
    pixels = spark.createDataFrame([("b", 0, 0, 0, 1.0), ("b", 0, 1, 0, 2.0), ("b", 0, 2, 1, 3.0)], "block_key string, row int, col int, cell int, population double")
    places = spark.createDataFrame([("b", 0, 0, 2), ("b", 0, 1, 2), ("b", 0, 2, 3)], "block_key string, row int, col int, location_id int")
    tree = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "location_id int, parent_id int")
    out = {r["location_id"]: (r["population"], r["value"]) for r in products.location_results(values, pixels, places, tree).collect()}
    assert out == {1: (6.0, 15.0), 2: (3.0, 10.0), 3: (3.0, 20.0)}


def test_person_days(spark):
    daily = spark.createDataFrame([(0, DAY(2000, 1, d), 10.0 + d) for d in (1, 2, 3)], "cell int, date date, value double")
    zones = spark.createDataFrame([(0, 2000, 12.3)], "cell int, year int, value double")
    people = spark.createDataFrame([(2, 0, 5.0), (3, 0, 7.0)], "location_id int, cell int, population double")
    tree = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "location_id int, parent_id int")
    out = products.person_days(daily, zones, people, tree).groupBy("location_id").agg(F.sum("person_days").alias("n"))
    assert {r["location_id"]: r["n"] for r in out.collect()} == {1: 36.0, 2: 15.0, 3: 21.0}


def test_predictors_and_training(spark):
    dem = spark.createDataFrame([(r, c, float(r)) for r in range(8) for c in range(8)], "row int, col int, elevation double")
    classes = spark.createDataFrame([(r, c, 1 if c < 4 else 2) for r in range(8) for c in range(8)], "row int, col int, class int")
    table = products.predictors(dem, classes, 2, 2)
    got = {(r["row"], r["col"]): (r["elevation_target"], r["elevation_coarse"], r["elevation_anomaly"], r["class_target"]) for r in table.collect()}
    assert len(got) == 16 and got[0, 0] == (0.5, 1.5, 1.0, 1) and got[3, 3] == (6.5, 5.5, -1.0, 2)
    stations = spark.createDataFrame([("s", DAY(2000, 1, 1), 1.5, 0.5, 50.0, -999.9), ("t", DAY(2000, 1, 1), 1.5, 0.5, None, 1.0)], "station string, date date, lat double, lon double, temp_f double, elevation double")
    daily = cube(spark, [DAY(2000, 1, 1)], (1, 2), (0, 359), lambda d, y, x: 10.0 * y + x)
    out = products.training_table(stations, daily, table, (2.0, 0.0), 0.5).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["temperature"], r["latitude"], r["longitude"], r["grid_temperature"]) == (pytest.approx(10.0), 2.0, 0.0, 20.0)
    assert (r["row"], r["col"], r["elevation"]) == (1, 1, 2.5)
