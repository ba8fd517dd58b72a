"""Small cases worked out by hand, and invariants."""

import datetime
import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from meridian.functions import coordinates, units
from meridian.operators import climate, ensemble, grid, hierarchy, quality, spatial, temporal
from meridian.plans.recipes import DAILY, Recipe
from meridian.sources import scratch, tables

DAY = datetime.date


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_fill_nearest_ties_and_empty_lines(spark):
    line = [("a", 0.0, None), ("a", 1.0, 5.0), ("a", 2.0, None), ("a", 3.0, 9.0), ("a", 4.0, None), ("b", 0.0, None), ("b", 1.0, None)]
    df = spark.createDataFrame(line, "line string, longitude double, value double")
    got = {(r["line"], r["longitude"]): r["value"] for r in grid.fill_nearest(df, "longitude", ["line"]).collect()}
    assert [got["a", float(x)] for x in range(5)] == [5, 5, 5, 9, 9]  # halfway: the lower one
    assert got["b", 0.0] is None and got["b", 1.0] is None


def test_regrid(spark):
    cells = [(1, float(y), float(x), 10.0 * y + x) for y in (0, 1) for x in (0, 2)]
    df = spark.createDataFrame(cells, "date int, latitude double, longitude double, value double")
    lat, lon = (spark.createDataFrame([(float(v),) for v in vs], "coord double") for vs in ((0, 0.5, 1.5), (0, 1, 2)))
    got = {(r["latitude"], r["longitude"]): r["value"] for r in grid.bilinear(df, lat, lon).collect()}
    assert got[0.5, 1.0] == 6.0 and got[0.0, 2.0] == 2.0 and got[1.5, 1.0] is None
    holed = grid.bilinear(df.where("not (latitude = 1 and longitude = 2)"), lat, lon)
    holed = {(r["latitude"], r["longitude"]): r["value"] for r in holed.collect()}
    assert holed[0.5, 1.0] is None and holed[0.0, 1.0] == 1.0  # a corner without weight isn't needed
    near = {(r["latitude"], r["longitude"]): r["value"] for r in grid.nearest(df, lat, lon).collect()}
    assert near[0.5, 1.0] == 0.0  # halfway: the lower one
    constant = grid.bilinear(df.withColumn("value", F.lit(7.0)), lat, lon)
    assert {r["value"] for r in constant.collect()} == {7.0, None}


def test_calendars(spark):
    model = [("c", 2000, d, 360, float(d)) for d in range(1, 361)]
    out = climate.align_calendar(spark.createDataFrame(model, "cell string, year int, dayofyear int, days_in_year int, value double"), ["cell"])
    got = [r["value"] for r in out.orderBy("date").collect()]
    assert len(got) == 366 and got[0] == 1.0 and got == sorted(got) and got[-1] == 360.0
    real = [("c", 2001, d, 365, float(d)) for d in range(1, 366)]
    same = climate.align_calendar(spark.createDataFrame(real, "cell string, year int, dayofyear int, days_in_year int, value double"), ["cell"])
    assert [r["value"] for r in same.orderBy("date").collect()] == [float(d) for d in range(1, 366)]


def test_extend_last_year(spark):
    df = spark.createDataFrame([(DAY(2099, 1, 1), "a", 1.0), (DAY(2099, 12, 31), "a", 2.0), (DAY(2099, 5, 1), "b", 3.0), (DAY(2100, 5, 1), "b", 4.0)], "date date, cell string, value double")
    got = rows(climate.extend_last_year(df, 2099, ["cell"]).where("year(date) = 2100"), "date", "cell", "value")
    assert got == [(DAY(2100, 1, 1), "a", 1.0), (DAY(2100, 5, 1), "b", 4.0), (DAY(2100, 12, 31), "a", 2.0)]


def test_missing_values(spark):
    df = spark.createDataFrame([(DAY(2000, 1, 1), 0, 0, None), (DAY(2000, 1, 2), 0, 0, float("nan"))], "date date, lat_i int, lon_i int, value double")
    df = df.withColumn("value", units.missing(F.col("value")))
    assert rows(temporal.annual(df, "sum"), "value") == [(0.0,)] and rows(temporal.annual(df, "mean"), "value") == [(None,)]
    assert rows(temporal.annual_days(df, temporal.over(F.col("value"), -1e9)), "days") == [(0,)]


def test_climatology_weighs_years_alike(spark):
    days = [(DAY(2000, 2, d), 0, 0, 1.0) for d in range(1, 30)] + [(DAY(2001, 2, 1), 0, 0, 3.0)]
    df = spark.createDataFrame(days, "date date, lat_i int, lon_i int, value double")
    assert rows(temporal.climatology(df), "value") == [(2.0,)]
    assert rows(temporal.pooled_monthly_mean(df), "value")[0][0] == pytest.approx(32 / 30)


def test_interpolation(spark):
    knots = spark.createDataFrame([(10.0, 0.0), (20.0, 1.0), (30.0, 0.5)], "temperature double, suitability double")
    df = spark.createDataFrame([(v,) for v in (-5.0, 10.0, 15.0, 20.0, 25.0, 30.0, 99.0, None)], "value double")
    got = {r["value"]: r["mapped"] for r in temporal.interpolate(df, knots).collect()}
    assert got == {-5.0: 0.0, 10.0: 0.0, 15.0: 0.5, 20.0: 1.0, 25.0: 0.75, 30.0: 0.5, 99.0: 0.5, None: None}


def test_rolling_mean_needs_all_years(spark):
    df = spark.createDataFrame([("a", y, v) for y, v in zip(range(2000, 2005), (1.0, 2.0, None, 4.0, 6.0), strict=True)], "cell string, year int, value double")
    assert [r["rolling"] for r in temporal.rolling_mean(df, ["cell"], 2).orderBy("year").collect()] == [None, 1.5, None, None, 5.0]


def test_pack(spark):
    df = spark.createDataFrame([(v,) for v in (1.234, -1.236, None, 1e9, 327.0)], "v double").withColumn("p", units.pack(F.col("v"), 0.01))
    got = {r["v"]: (r["p"], r["u"]) for r in df.withColumn("u", units.unpack(F.col("p"), 0.01)).collect()}
    assert got[None] == (-32767, None) and got[1e9] == (-32767, None) and got[1.234][0] == 123
    assert all(abs(u - v) <= 0.005 + 1e-9 for v, (_, u) in got.items() if u is not None)


def test_roll_up_keeps_sums(spark):
    tree = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 2, 1), (4, 2, 1), (5, 1, 1)], "location_id int, parent_id int, most_detailed int").withColumn("level", F.lit(0))
    facts = spark.createDataFrame([(3, 2000, 1.0), (4, 2000, 2.0), (5, 2000, 4.0), (99, 2000, 8.0), (3, 2000, 16.0)], "location_id int, year_id int, population double")
    assert rows(hierarchy.roll_up(facts, tree, ["population"]), "location_id", "population") == [(1, 23.0), (2, 19.0), (3, 17.0), (4, 2.0), (5, 4.0)]
    assert rows(hierarchy.missing_locations(tree, facts.where("location_id <> 5")), "location_id") == [(5,)]
    pruned = hierarchy.prune(tree, spark.createDataFrame([(2,)], "location_id int"))
    assert rows(pruned, "location_id", "most_detailed") == [(1, 0), (2, 1), (5, 1)]
    named = tree.withColumn("location_name", F.element_at(F.array(*map(F.lit, ("World", "B", "y", "x", "A"))), F.col("location_id")))
    assert rows(hierarchy.depth_first(named), "position", "location_id") == [(1, 1), (2, 5), (3, 2), (4, 4), (5, 3)]


def test_polygons(spark):
    square = [(1, 1, 0, 0, 4, 0), (1, 1, 4, 0, 4, 4), (1, 1, 4, 4, 0, 4), (1, 1, 0, 4, 0, 0)]
    later = [(2, 2, 2, 2, 6, 2), (2, 2, 6, 2, 6, 6), (2, 2, 6, 6, 2, 6), (2, 2, 2, 6, 2, 2)]
    edges = spark.createDataFrame([tuple(map(float, e)) for e in square + later], "location_id double, shape_order double, x1 double, y1 double, x2 double, y2 double")
    pixels = spark.createDataFrame([(r, c, c + 0.5, r + 0.5) for r in range(7) for c in range(7)], "row int, col int, x double, y double")
    for band in (1.0, 100.0):
        got = {(r["row"], r["col"]): r["location_id"] for r in spatial.pixels_in_polygons(pixels, edges, band).collect()}
        assert got[0, 0] == 1 and got[3, 3] == 2 and got[5, 5] == 2 and (6, 6) not in got and (0, 5) not in got and len(got) == 28


def test_person_days_match_the_naive_sum(spark):
    people = spark.createDataFrame([(1, 0, 5.0), (1, 0, 7.0), (1, 1, 1.0), (2, 1, 2.0)], "location_id int, cell int, population double")
    days = spark.createDataFrame([(0, 3, 2), (0, 4, 1), (1, 3, 10)], "cell int, bin int, n int")
    assert rows(spatial.person_days(people, days, ["bin"]), "location_id", "bin", "person_days") == [(1, 3, 34.0), (1, 4, 12.0), (2, 3, 20.0)]


def test_coordinates(spark):
    df = spark.createDataFrame([(7.5, 10.2), (-5.0, -123.4), (-0.5, 0.0)], "lat double, lon double")
    assert [r[0] for r in df.select(coordinates.elevation_tile(F.col("lat"), F.col("lon"))).collect()] == ["N07E010", "S05W124", "S01E000"]
    wrapped = spark.createDataFrame([(190.0,), (-181.0,), (180.0,), (0.0,)], "x double").select(coordinates.wrap_longitude(F.col("x")))
    assert [r[0] for r in wrapped.collect()] == [-170.0, 179.0, -180.0, 0.0]
    bins = spark.createDataFrame([(-35.0,), (-34.9,), (-99.0,), (99.0,), (0.1,)], "t double").select(coordinates.tenth_bin(F.col("t")), coordinates.degree_bin(F.col("t")))
    assert [tuple(r) for r in bins.collect()] == [(0, 0), (1, 0), (0, 0), (799, 59), (351, 25)]
    x, y = coordinates.equal_area(F.lit(90.0), F.lit(180.0))
    assert tuple(round(v, 2) for v in spark.range(1).select(x, y).first()) == (20037508.34, 6363885.33)


def test_draws_are_stable_and_shared(spark):
    members = spark.createDataFrame([("b", "r1"), ("a", "r2"), ("a", "r1"), ("a", "r1")], "source string, variant string")
    one, two = (rows(ensemble.draw_map(spark, m), "draw", "source", "variant") for m in (members, members.orderBy(F.desc("variant"))))
    assert one == two and len(one) == 100 and {(s, v) for _, s, v in one} == {("a", "r1"), ("a", "r2"), ("b", "r1")}
    assert ensemble.draw_map(spark, members.limit(0)).count() == 0


def test_series_that_overlap_fail(spark):
    df = spark.createDataFrame([("a", 2000, 1.0)], "cell string, year int, value double")
    with pytest.raises(Exception, match="in history and scenario"):
        ensemble.compile_series(df, df, ["cell", "year"]).collect()


def test_history_flags(spark):
    tasks = spark.createDataFrame([("historical", "era5", 2000), ("ssp245", "m_r1", 2050), ("historical", "era5", 2050), ("ssp245", "era5", 2050)], "scenario string, gcm_member string, year int")
    assert rows(quality.history_flags(tasks), "scenario", "year", "flags") == [("historical", 2050, 2), ("ssp245", 2050, 1)]


def test_recipes(spark):
    hours = spark.createDataFrame([(datetime.datetime(2000, 1, 1, h), 0, 0, 273.15 + h) for h in range(24)], "ts timestamp, lat_i int, lon_i int, value double")
    assert rows(DAILY["max_temperature"](hours), "value")[0][0] == pytest.approx(23.0)
    assert rows(DAILY["total_precipitation"](hours, dataset="land"), "value")[0][0] == pytest.approx(296150.0)
    with pytest.raises(KeyError):
        DAILY["total_precipitation"](hours, dataset="other")
    with pytest.raises(ValueError):
        Recipe(("a", "b"), [lambda a, b: a])(hours)


def test_only_written_partitions_are_replaced(spark):
    path = scratch.path(spark, "parts")
    tables.write(spark.createDataFrame([(1, 1.0), (2, 2.0)], "year int, v double"), path, ["year"])
    tables.write(spark.createDataFrame([(2, 5.0)], "year int, v double"), path, ["year"])
    assert rows(tables.read(spark, path), "year", "v") == [(1, 1.0), (2, 5.0)] and rows(tables.read(spark, path, year=[1]), "v") == [(1.0,)]


def test_the_library_stands_without_training_operators(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/meridian", tmp_path / "meridian", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(q) == set(o), set(q) ^ set(o)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_hierarchy_of_any_depth(spark):
    """Trees of one to forty levels are summed and ordered; a cycle raises."""
    tree = lambda n: spark.createDataFrame([(i, max(1, i - 1), f"n{i}") for i in range(1, n + 1)], "location_id int, parent_id int, location_name string")
    for n in (1, 7, 10, 40):
        assert hierarchy.closure(tree(n)).count() == n * (n + 1) // 2
        assert [r["location_id"] for r in hierarchy.depth_first(tree(n)).orderBy("position").collect()] == list(range(1, n + 1))
    facts = spark.createDataFrame([(10, 2000, 3.0)], "location_id int, year_id int, population double")
    assert rows(hierarchy.roll_up(facts, tree(10), ["population"]), "location_id", "population") == [(i, 3.0) for i in range(1, 11)]
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "location_id int, parent_id int")
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.closure(ring)


def test_polygons_of_several_blocks(spark):
    """Pixels of two blocks with one row and column are two pixels."""
    square = [(1, 1, 0, 0, 4, 0), (1, 1, 4, 0, 4, 4), (1, 1, 4, 4, 0, 4), (1, 1, 0, 4, 0, 0)]
    edges = spark.createDataFrame([tuple(map(float, e)) for e in square], "location_id double, shape_order double, x1 double, y1 double, x2 double, y2 double")
    pixels = spark.createDataFrame([("A", 0, 0, 0.5, 0.5), ("B", 0, 0, 2.5, 2.5), ("C", 0, 0, 9.5, 2.5)], "block_key string, row int, col int, x double, y double")
    for tile in (1.0, 64.0):
        assert rows(spatial.pixels_in_polygons(pixels, edges, tile=tile, keys=("block_key", "row", "col")), "block_key", "location_id") == [("A", 1.0), ("B", 1.0)]


def test_large_keys_are_split_on_writing(spark):
    """A key is no task of its own: its rows go to files by size, and each file has its rows in order."""
    path = scratch.path(spark, "large")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        tables.write(spark.range(200_000).selectExpr("1 as year", "id", "rand(3) as v"), path, ["year"], ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    found = tables.read(spark, path)
    assert found.select(F.input_file_name()).distinct().count() > 1 and found.count() == 200_000


def test_catalogue_and_flags(spark):
    entries = spark.createDataFrame([("s", "e", "v", "day", "m", "one", 1), ("s", "e", "v", "day", "m", "two", 2), ("s", "e", "v", "month", "m", "three", 3)],
                                    "source_id string, experiment_id string, variable_id string, table_id string, member_id string, zstore string, position int")
    assert rows(ensemble.catalogue(entries, "s", table="day"), "zstore") == [("two",)] and ensemble.catalogue(entries, "other").count() == 0
    flags = spark.createDataFrame([("Yes",), ("No",), ("?",), (None,)], "f string").select("f", ensemble.yes_or_no("f").alias("b"))
    assert {r["f"]: r["b"] for r in flags.collect()} == {"Yes": True, "No": False, "?": None, None: None}


def test_cube_without_a_column(spark):
    df = spark.createDataFrame([(DAY(2000, 1, 1), 1.0, "x")], "date date, latitude double, value string")
    lat = spark.createDataFrame([(1.0,)], "coord double")
    assert rows(quality.cube_problems(df, lat, lat), "problem") == [("missing column longitude",), ("type of value string",)]


def test_nearest_coordinate(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (-9.0,), (9.0,), (None,)], "c double")
    axis = spark.createDataFrame([(0.0,), (1.0,), (3.0,)], "coord double")
    assert {r["c"]: r["n"] for r in spatial.nearest_coordinate(df, axis, "c", "n").collect()} == {0.5: 1.0, 0.49: 0.0, -9.0: 0.0, 9.0: 3.0, None: None}
