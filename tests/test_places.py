"""Polygons by tiles, mosaics, systems of coordinates, trees and numbers in order."""

import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.operators import hierarchy, order, spatial, tiles
from meridian.plans import cube_queries  # noqa: F401  (it registers its queries)
from meridian.plans.fixtures import QUERIES
from meridian.sources import scratch


def polygon(i, corners):
    return [(i, i, *map(float, a), *map(float, b)) for a, b in zip(corners, [*corners[1:], corners[0]], strict=True)]


EDGES = "location_id int, shape_order int, x1 double, y1 double, x2 double, y2 double"


def inside(x, y, edges):
    return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for _, _, x1, y1, x2, y2 in edges) % 2 == 1


@pytest.fixture(scope="module")
def shapes():
    rng = np.random.default_rng(5)
    star = [(60 + (50 if k % 2 else 20) * math.cos(k * math.pi / 9), 70 + (50 if k % 2 else 20) * math.sin(k * math.pi / 9)) for k in range(18)]
    rough = [(20 + (15 + rng.random() * 10) * math.cos(a), 110 + (15 + rng.random() * 10) * math.sin(a)) for a in np.linspace(0, 2 * math.pi, 60)[:-1]]
    return {1: polygon(1, [(0, 0), (128, 0), (128, 64), (64, 64), (64, 128), (0, 128)]), 2: polygon(2, star), 3: polygon(3, rough), 4: polygon(4, [(90, 90), (90, 90), (91, 95)]), 5: polygon(5, [(-30, -20), (-5, -20), (-5, 3)])}


def test_cover_of_polygons(spark, shapes):
    """Concave, rough, thin and negative polygons, with edges on the borders of tiles: the same as a test of every edge."""
    edges = spark.createDataFrame([e for es in shapes.values() for e in es], EDGES)
    cells = [(r, c, c + 0.5, r + 0.5) for r in range(-22, 140) for c in range(-32, 140)]
    pixels = spark.createDataFrame(cells, "row int, col int, x double, y double").cache()
    want = {}
    for r, c, x, y in cells:
        for i, es in shapes.items():
            if inside(x, y, es):
                want[r, c] = i
    for tile, levels, split in ((64.0, 2, 8), (32.0, 3, 2), (16.0, 1, 1)):
        got = spatial.pixels_in_polygons(pixels, edges, tile=tile, levels=levels, split=split)
        assert {(r["row"], r["col"]): r["location_id"] for r in got.collect()} == want


def test_pixels_inside_make_no_edge_test(spark, shapes):
    """A square of 1,000 pixels a side: only pixels of tiles along its border are tested."""
    edges = spark.createDataFrame(polygon(1, [(3, 3), (1003, 3), (1003, 1003), (3, 1003)]), EDGES)
    found = spatial.cover(edges)
    kinds = {r["__edge"]: r["count"] for r in found.groupBy("__edge").count().collect()}
    assert kinds == {True: 4 * 125, False: 124 * 124}
    pixels = spark.range(1010 * 1010).selectExpr("cast(id div 1010 as int) as row", "cast(id % 1010 as int) as col").selectExpr("row", "col", "col + 0.5D as x", "row + 0.5D as y")
    met = spatial.on_cover(pixels, found, ("row", "col"), 8.0)
    tested = met.where("__edge").count()
    assert met.where("not __edge").count() == 124 * 124 * 64 and tested < 4 * 126 * 64
    assert spatial.pixels_in_polygons(pixels, edges).count() == 1000 * 1000


def test_mosaic(spark):
    """Overlaps by rank, gaps of a tile filled by the next, nodata without a tile, and a box without any."""
    index = spark.createDataFrame([("a", 0.0, 10.0, 1.0, 2, 3, 2), ("b", 2.0, 10.0, 1.0, 2, 2, 1), ("far", 50.0, 10.0, 1.0, 2, 2, 0)], "tile string, x0 double, y0 double, step double, rows int, cols int, rank int")
    pixels = spark.createDataFrame([("a", r, c, 10.0 * r + c) for r in range(2) for c in range(3)] + [("b", 0, 0, None), ("b", 0, 1, 101.0), ("b", 1, 0, 110.0), ("b", 1, 1, 111.0), ("far", 0, 0, 9.0)], "tile string, row int, col int, value double")
    got = {(r["row"], r["col"]): r["value"] for r in tiles.mosaic(pixels, index, (1.0, 8.0, 5.0, 11.0), 1.0, -1.0).collect()}
    assert got == {(0, c): -1.0 for c in range(4)} | {(1, 0): 1.0, (1, 1): 2.0, (1, 2): 101.0, (1, 3): -1.0, (2, 0): 11.0, (2, 1): 110.0, (2, 2): 111.0, (2, 3): -1.0}
    assert {r["value"] for r in tiles.mosaic(pixels, index, (100.0, 0.0, 103.0, 2.0), 1.0, -32768.0).collect()} == {-32768.0}
    assert {r["tile"] for r in tiles.covering(index, (3.0, 8.0, 4.0, 9.0)).collect()} == {"b"} and tiles.covering(index, (5.0, 8.0, 6.0, 9.0), 3.0).count() == 2
    with pytest.raises(Exception, match="off the raster"):
        tiles.mosaic(pixels, index.withColumn("x0", F.col("x0") + 0.5), (1.0, 8.0, 5.0, 11.0), 1.0).collect()
    with pytest.raises(ValueError):
        tiles.mosaic(pixels, index, (1.0, 8.0, 5.5, 11.0), 1.0)


def test_cut_into_tiles(spark):
    """Overlapping tiles, tiles across blocks and over the raster's edge or beyond it, and pixels left of the origin: the same as a test of every tile."""
    rng = np.random.default_rng(3)
    cells = {(r, c): float(rng.random()) for r in range(-5, 40) for c in range(-7, 50) if rng.random() < 0.9}
    raster = spark.createDataFrame([(*k, v) for k, v in cells.items()], "row int, col int, value double")
    corners = [(f"{k}", *map(int, rng.integers(-30, 60, 2)), *map(int, rng.integers(1, 40, 2))) for k in range(60)]
    index = spark.createDataFrame([(t, 4 + left * 0.5, 8 - top * 0.5, 0.5, rows, cols) for t, left, top, rows, cols in corners], "tile string, x0 double, y0 double, step double, rows int, cols int")
    want = sorted((t, r - top, c - left, v) for t, left, top, rows, cols in corners for (r, c), v in cells.items() if 0 <= r - top < rows and 0 <= c - left < cols)
    for block in (1, 8, 16, 100):
        assert sorted(map(tuple, tiles.cut(raster, index, 4.0, 8.0, 0.5, block).collect())) == want
    with pytest.raises(Exception, match="off the raster"):
        tiles.cut(raster, index, 4.25, 8.0, 0.5).collect()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the generated tables")
def test_tile_mosaic_tests_no_pixel_with_every_tile(spark):
    plan = QUERIES["tile_mosaic"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(NestedLoopJoin|CartesianProduct).*\brow#", plan)


def test_area_after_a_round_trip(spark):
    edges = spark.createDataFrame(polygon(1, [(10, 10), (20, 10), (20, 30), (10, 30)]) + polygon(2, [(170, -10), (200, -10), (200, 10), (170, 10)]) + polygon(3, [(5, 5), (6, 6), (5, 5)]), EDGES)
    got = {r["location_id"]: r for r in spatial.round_trip_change(edges, "ESRI:54034").collect()}
    assert got[1]["area"] == 200 and got[1]["change"] < 1e-9 and not got[1]["wrong"]
    sphere = 6371007.18**2 * math.radians(10) * (math.sin(math.radians(30)) - math.sin(math.radians(10)))
    assert abs(got[1]["projected"] / sphere - 1) < 0.01
    assert got[2]["area"] == 200 and not got[2]["wrong"]  # cut at the antimeridian
    assert got[3]["change"] is None and got[3]["wrong"]
    assert {r["wrong"] for r in spatial.round_trip_change(edges.where("location_id = 1"), "EPSG:4326", -1.0).collect()} == {True}
    with pytest.raises(ValueError, match="unsupported"):
        spatial.round_trip_change(edges, "EPSG:3857")


def test_nearest_on_irregular_axes(spark):
    rng = np.random.default_rng(6)
    for coords in ([7.0], [0.0, 1e9], [*rng.normal(size=300), 1e6], np.arange(0, 5000, 1.0), [-3.5, -3.5, 2.0, 2.0000001]):
        asked = [*rng.normal(0, 5, 200), -1e9, 1e9, 5e8, *[float(c) for c in coords][:5], -0.75]
        df = spark.createDataFrame([(float(a),) for a in asked] + [(None,)], "c double")
        axis = spark.createDataFrame([(float(c),) for c in coords] + [(None,), (float("nan"),)], "coord double")
        have = sorted({float(c) for c in coords})
        for r in spatial.nearest_coordinate(df, axis, "c", "n").collect():
            assert r["n"] == (None if r["c"] is None else min(have, key=lambda s: (abs(s - r["c"]), -s)))
    assert {r["n"] for r in spatial.nearest_coordinate(df, axis.limit(0), "c", "n").collect()} == {None}


def test_plan_of_a_tree_does_not_grow(spark):
    tree = lambda n: spark.createDataFrame([(i, max(1, i - 1)) for i in range(1, n + 1)], "location_id int, parent_id int")
    size = lambda n: len(hierarchy.closure(tree(n))._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(10) == size(70) <= 4


def test_numbers_in_order(spark):
    rows = spark.range(20_000).withColumn("k", F.xxhash64("id") % 500)
    got = order.numbered(rows, [F.col("k"), F.col("id")], "n").collect()
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["n"])] == sorted((r["k"], r["id"]) for r in got)
    assert sorted(r["n"] for r in got) == list(range(1, 20_001))
    assert order.numbered(rows.limit(0), [F.col("id")], "n").count() == 0


def test_scratch_is_cleaned(spark):
    df = scratch.written(spark.range(3).toDF("id"), "mine")
    files = df.inputFiles()
    assert files and df.count() == 3 and scratch.clean(spark) >= 1 and scratch.clean(spark) == 0
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(files[0].rpartition("/")[0])
