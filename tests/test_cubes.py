"""Packed cubes, lines of a grid, the source catalogue and the log of written partitions."""

import datetime
import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.functions import units
from meridian.operators import climate, ensemble, grid, packed, temporal
from meridian.plans import cube_queries  # noqa: F401  (it registers its queries)
from meridian.plans.fixtures import ORACLE, QUERIES
from meridian.sources import catalogue, manifest, scratch, tables

DAY = datetime.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def axis(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "coord double")


def values(df, *keys):
    return {tuple(r[k] for k in keys): r["value"] for r in df.collect()}


@pytest.fixture(scope="module")
def days(spark):
    """Three years of two cells, one of them a leap year, with gaps in the second cell."""
    rng = np.random.default_rng(1)
    rows = []
    for k in range(1096):
        date = DAY(1999, 1, 1) + datetime.timedelta(days=k)
        rows.append((0, 0, date, float(rng.normal(20, 10))))
        if k % 5:
            rows.append((0, 1, date, None if k % 7 == 0 else float(rng.normal(20, 10))))
    return spark.createDataFrame(rows, "lat_i int, lon_i int, date date, value double").repartition(4).cache()


def test_packed_is_the_long_form(spark, days):
    cube = packed.pack_years(days, 0.01)
    path = scratch.path(spark, "cube")
    tables.write(cube, path, ["year"])
    cube = tables.read(spark, path)
    assert cube.count() == 6 and {r[0] for r in cube.select(F.size("values")).collect()} == {365, 366}
    stored = days.withColumn("value", units.unpack(units.pack(F.col("value"), 0.01), 0.01))
    want = values(stored.where("value is not null"), "lat_i", "lon_i", "date")
    assert values(packed.days(cube, 0.01).where("value is not null"), "lat_i", "lon_i", "date") == want
    key = ("year", "lat_i", "lon_i")
    for how in ("mean", "max", "min", "sum"):
        a, b = values(packed.annual(cube, how, 0.01), *key), values(temporal.annual(stored, how), *key)
        assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], rel_tol=1e-12) for k in a)
    for condition in (lambda v: temporal.over(v, 30.0), lambda v: temporal.between(v, 10.0, 20.0)):
        rows = lambda df: {tuple(r) for r in df.collect()}
        assert rows(packed.annual_days(cube, condition, 0.01)) == rows(temporal.annual_days(stored, condition(F.col("value"))))
    knots = spark.createDataFrame([(15.0, 0.0), (25.0, 1.0), (34.0, 0.0)], "temperature double, suitability double")
    a = values(packed.curve_sum(cube, knots, 0.01), *key)
    b = values(temporal.annual(temporal.interpolate(stored, knots).withColumn("value", F.coalesce("mapped", F.lit(0.0))), "sum"), *key)
    assert all(math.isclose(a[k], b[k], rel_tol=1e-9) for k in b)


def test_packed_reductions_make_no_rows_and_no_shuffle(spark, days):
    path = scratch.path(spark, "cube")
    tables.write(packed.pack_years(days, 0.01), path, ["year"])
    cube = tables.read(spark, path)
    for df in (packed.annual(cube, "mean", 0.01), packed.annual_days(cube, lambda v: v > 30, 0.01)):
        assert not re.search(r"Generate|Exchange", plan(df))


def test_packed_edges(spark):
    rows = spark.createDataFrame([(0, 0, DAY(2000, 12, 31), 1.0), (0, 1, DAY(2001, 1, 1), None), (0, 2, DAY(2001, 3, 1), 400.0)], "lat_i int, lon_i int, date date, value double")
    cube = packed.pack_years(rows, 0.01)
    got = {r["lon_i"]: r["values"] for r in cube.collect()}
    assert got[0] == [packed.MISSING] * 365 + [100] and got[1] == got[2] == [packed.MISSING] * 365  # 400 is beyond the 16 bits
    assert values(packed.annual(cube, "mean", 0.01), "lon_i") == {(0,): 1.0, (1,): None, (2,): None}
    assert values(packed.annual(cube, "sum", 0.01), "lon_i") == {(0,): 1.0, (1,): 0.0, (2,): 0.0}
    assert packed.pack_years(rows.limit(0), 0.01).count() == 0
    with pytest.raises(Exception, match="twice"):
        packed.pack_years(rows.unionAll(rows), 0.01).collect()


def test_packed_wide_keeps_values_beyond_16_bits(spark):
    """400, the number that marks a missing value and 1e9 are kept, and only their years are wide."""
    rows = spark.createDataFrame([(k, 0, DAY(2001, 1, 1 + i), v) for k, vs in enumerate([(1.0, 400.0, None), (-327.67, 2.0), (1e9, -1.0), (327.67, -327.68)]) for i, v in enumerate(vs)], "lat_i int, lon_i int, date date, value double")
    path = scratch.path(spark, "cube")
    tables.write(packed.pack_years(rows, 0.01, wide=True), path, ["year"])
    cube = tables.read(spark, path)
    assert {r["lat_i"]: r["wide"] is not None for r in cube.collect()} == {0: True, 1: True, 2: True, 3: False}
    want = {(r["lat_i"], r["date"]): r["value"] for r in rows.collect() if r["value"] is not None}
    assert values(packed.days(cube, 0.01).where("value is not null"), "lat_i", "date") == pytest.approx(want, rel=1e-12)
    for how, want in (("max", (400, 2, 1e9, 327.67)), ("min", (1, -327.67, -1, -327.68)), ("sum", (401, -325.67, 1e9 - 1, -0.01)), ("mean", (200.5, -162.835, (1e9 - 1) / 2, -0.005))):
        assert values(packed.annual(cube, how, 0.01), "lat_i") == pytest.approx({(k,): v for k, v in enumerate(want)}, rel=1e-12)
    assert {r["lat_i"]: r["days"] for r in packed.annual_days(cube, lambda v: v > 300, 0.01).collect()} == {0: 1, 1: 0, 2: 1, 3: 1}
    knots = spark.createDataFrame([(0.0, 0.0), (1e9, 1.0)], "temperature double, suitability double")
    assert values(packed.curve_sum(cube, knots, 0.01), "lat_i")[2,] == pytest.approx(1.0)
    both = packed.combine(cube, cube, units.magnitude, (0.01,) * 3)
    assert values(packed.annual(both, "max", 0.01), "lat_i") == pytest.approx({(0,): 565.69, (1,): 463.4, (2,): 1414213562.37, (3,): 463.41}, rel=1e-12)


def test_packed_wind_speed_of_large_sums(spark, tmp_path):
    """5,000 lines a day, whose discounts add to more than 16 bits hold at 0.01: the query has what its SQL has."""
    lines = spark.range(10_000).selectExpr("0L as l_suppkey", "timestamp(date_add(date'2001-01-01', int(id % 2))) as l_shipdate", "double(310 + id % 5) as l_quantity", "0.1D as l_discount")
    for name, df in (("lineitem", lines), ("supplier", spark.sql("select 0L as s_suppkey, 7 as s_nationkey"))):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    for name in ("lineitem", "supplier"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(ORACLE["packed_wind_speed"]).fetchall()
    assert want[0][-1] > 5000 and [tuple(r) for r in QUERIES["packed_wind_speed"](spark, str(tmp_path)).collect()] == want


def test_lines_with_gaps_are_as_null_values(spark):
    """A source that leaves out its missing places, and one that has them as null."""
    rng = np.random.default_rng(2)
    rows = [(d, float(10 * y), float(7 * x), None if rng.random() < 0.3 else float(rng.normal())) for d in range(3) for y in range(6) for x in range(5)]
    full = spark.createDataFrame(rows, "date int, latitude double, longitude double, value double")
    lat, lon = axis(spark, np.arange(-5, 60, 2.5)), axis(spark, np.arange(0, 30, 3.5))
    source = axis(spark, range(0, 60, 10)), axis(spark, range(0, 35, 7))
    key = ("date", "latitude", "longitude")
    by = {(d, y, x): v for d, y, x, v in rows}
    for way in (grid.bilinear, grid.nearest):
        a, b = values(way(full, lat, lon, source=source), *key), values(way(full.where("value is not null"), lat, lon, source=source), *key)
        assert a == b and len(a) == 3 * 26 * 9
    for (d, y, x), v in values(grid.bilinear(full, lat, lon), *key).items():
        corners = [(by.get((d, 10.0 * j, 7.0 * i)), (1 - abs(y / 10 - j)) * (1 - abs(x / 7 - i))) for j in range(6) for i in range(5) if abs(y / 10 - j) < 1 and abs(x / 7 - i) < 1]
        inside = 0 <= y <= 50 and 0 <= x <= 28 and all(c is not None for c, _ in corners)
        assert v is None if not inside else math.isclose(v, sum(c * w for c, w in corners), abs_tol=1e-12)
    for how, way in (("bilinear", grid.bilinear), ("nearest", grid.nearest)):
        for df in (full, full.where("latitude = 20 or value > 1"), full.where("longitude = 7 and latitude in (10, 40)")):
            assert values(grid.filled(df, lat, lon, how=how), *key) == values(grid.fill_gaps(way(df, lat, lon)), *key)
    with pytest.raises(Exception, match="twice"):
        grid.bilinear(full.unionAll(full), lat, lon).collect()
    assert grid.bilinear(full.limit(0), lat, lon).count() == 0


def test_regrid_and_fill_take_three_exchanges(spark, tmp_path):
    spark.range(1).selectExpr("date'2000-01-01' as date", "1.0 as latitude", "2.0 as longitude", "3.0 as value").write.parquet(f"{tmp_path}/g")
    df, target = spark.read.parquet(f"{tmp_path}/g"), axis(spark, (0, 1))
    text = plan(grid.filled(df, target, target, source=(target, target)))
    assert len(re.findall(r"Exchange hashpartitioning\(date", text)) == 3 and "Window" not in text


def test_annual_mean_goes_both_ways(spark):
    rng = np.random.default_rng(4)
    rows = [(DAY(y, 1, 1) + datetime.timedelta(days=d), float(a), float(b), float(rng.normal()) if y == 2000 or (d, a, b) != (3, 1, 1) else None) for y in (2000, 2001) for d in range(20) for a in range(3) for b in range(3)]
    df = spark.createDataFrame(rows, "date date, latitude double, longitude double, value double")
    lat, lon = axis(spark, (-1, 0.5, 1.5)), axis(spark, (0, 0.25, 2, 9))
    key = ("year", "latitude", "longitude")
    got = values(grid.annual_mean(df, lat, lon), *key)
    long = grid.fill_gaps(grid.bilinear(df, lat, lon)).groupBy(F.year("date").alias("year"), "latitude", "longitude").agg(F.avg("value").alias("value"))
    want = values(long, *key)
    assert got.keys() == want.keys() and len(got) == 24 and all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in got)


def test_calendar_takes_neighbours_over_empty_years(spark):
    rows = [(0, 1999, 360, 360, 1.0), (0, 2000, 1, 360, None), (0, 2001, 5, 360, None), (0, 2002, 181, 360, 4.0), (1, 2000, 1, 360, None)]
    df = spark.createDataFrame(rows, "cell int, year int, dayofyear int, days_in_year int, value double")
    out = climate.align_calendar(df, ["cell"])
    got = values(out, "cell", "date")
    at = lambda d: d.year + (d.timetuple().tm_yday - 1) / (366 if d.year == 2000 else 365)
    lo, hi = 1999 + 359 / 360, 2002.5
    for d in (DAY(2000, 1, 1), DAY(2000, 7, 3), DAY(2001, 12, 31), DAY(2002, 3, 1)):
        assert math.isclose(got[0, d], 1 + 3 * (at(d) - lo) / (hi - lo))
    assert got[0, DAY(1999, 1, 1)] == 1.0 and got[0, DAY(2002, 12, 31)] == 4.0 and got[1, DAY(2000, 5, 5)] is None
    assert len(got) == 365 + 366 + 365 + 365 + 366 and "unboundedfollowing" not in plan(out).lower()


def test_draws_take_no_list(spark):
    """An ensemble of very many variants of one source; the places are those of numpy's stream."""
    many = spark.range(200_000).selectExpr("'big' as source", "lpad(id, 6, '0') as variant").unionByName(spark.createDataFrame([("a", "r1"), ("a", "r2")], "source string, variant string"))
    got = [tuple(r) for r in ensemble.draw_map(spark, many.unionByName(many), 20, 7).orderBy("draw").collect()]
    state, want = np.random.RandomState(7), []
    for d in range(20):
        if state.randint(0, 2):
            want.append((d, "big", f"{state.randint(0, 200_000):06}"))
        else:
            want.append((d, "a", f"r{1 + state.randint(0, 2)}"))
    assert got == want


@pytest.fixture
def due(spark):
    return spark.createDataFrame([(y, m) for y in (2000, 2001, 2002) for m in ("a", "b")], "year int, measure string")


def test_a_run_that_died_is_taken_up(spark, due):
    path, log = scratch.path(spark, "table"), scratch.path(spark, "log")
    asked = []

    def compute(batch, dies=None):
        asked.extend(tuple(r) for r in batch.orderBy("year", "measure").collect())
        wrong = F.when(F.col("year") == (dies or 0), F.raise_error(F.lit("died"))).otherwise(F.lit(1.0))
        rows = batch.where("measure = 'a' or year < 2002").withColumn("value", wrong)
        return rows.unionByName(rows)

    with pytest.raises(Exception, match="died"):
        manifest.run(due, lambda b: compute(b, 2001), path, log, "t", "year", "one")
    # Files without an entry, as a run may leave them, are not read.
    spark.createDataFrame([(2001, "a", 9.0)], "year int, measure string, value double").write.mode("append").partitionBy("year", "measure").parquet(path)
    schema, keys = "year int, measure string, value double", "year int, measure string"
    assert {r["year"] for r in manifest.read(spark, path, log, "t", schema, keys).collect()} == {2000}
    assert manifest.pending(due, log, "t").count() == 4 and manifest.pending(due, log, "other").count() == 6
    asked.clear()
    assert manifest.run(due, compute, path, log, "t", "year", "two") == 2
    assert asked == [(2001, "a"), (2001, "b"), (2002, "a"), (2002, "b")]
    rows = manifest.read(spark, path, log, "t", schema, keys).collect()
    assert len(rows) == 10 and {r["value"] for r in rows} == {1.0}
    entries = {(r["year"], r["measure"]): (r["rows"], r["run"]) for r in manifest.entries(spark, log, "t", keys).collect()}
    assert entries[2000, "b"] == (2, "one") and entries[2002, "a"] == (2, "two") and entries[2002, "b"] == (0, "two")  # a partition without rows is finished too
    assert manifest.pending(due, log, "t").count() == 0 and manifest.pending(due, log, "t", overwrite=True).count() == 6
    assert manifest.run(due, compute, path, log, "t", "year", "three") == 0


@pytest.fixture(scope="module")
def store(spark):
    path = scratch.path(spark, "store")
    rows = [(f"v{v}", m, 10.04 * m, 359.96, float("nan") if m == 3 else 273.15 + v) for v in range(3) for m in range(1, 13)]
    tables.write(spark.createDataFrame(rows, "variable string, month int, lat double, longitude double, value double"), path, ["variable", "month"])
    return catalogue.Source(path, "lat double, longitude double, value double, variable string, month int", ("variable", "month"), {"lat": "latitude"}, {"v0": units.kelvin_to_celsius}, 0.1, True)


def test_catalogue(spark, store):
    df = catalogue.scan(spark, store, variable="v0", month=[1, 3])
    got = {r["month"]: (round(r["latitude"], 9), round(r["longitude"], 9), r["value"]) for r in df.collect()}
    assert got == {1: (10.0, 0.0, 0.0), 3: (30.1, 0.0, None)}
    text = plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*variable[^\]]*= v0[^\]]*month[^\]]*IN \(1,3\)", text)
    mixed = {(r["variable"], r["month"]): r["value"] for r in catalogue.scan(spark, store, month=1).collect()}
    assert mixed == {("v0", 1): 0.0, ("v1", 1): 274.15, ("v2", 1): 275.15}
    with pytest.raises(catalogue.EmptySlice):
        catalogue.scan(spark, store, variable="none")
    with pytest.raises(KeyError):
        catalogue.scan(spark, store, year=2000)


def test_catalogue_is_pruned_by_a_work_list(spark, store, tmp_path):
    spark.createDataFrame([("v1", 2), ("v2", 5)], "variable string, month int").write.parquet(f"{tmp_path}/work")
    work = spark.read.parquet(f"{tmp_path}/work").where("month > 1")
    df = catalogue.scan_of(work, store, spark)
    assert {(r["variable"], r["month"]) for r in df.collect()} == {("v1", 2), ("v2", 5)}
    assert "dynamicpruning" in plan(df).lower()
