"""Polygons, pixels and stations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions import coordinates


def _at(c: Column | str, size: float) -> Column:
    return F.floor((F.col(c) if isinstance(c, str) else c) / F.lit(size))


SHAPE = ("location_id", "shape_order")


def _odd(points: DataFrame, keys: Sequence[str], edges: DataFrame, band: float) -> DataFrame:
    """Which points (keys, a shape, x, y) are in their shape: an odd number of its edges lie to their right. A point meets the edges of its band."""
    listed = edges.where("y1 <> y2").withColumn("__band", F.explode(F.sequence(_at(F.least("y1", "y2"), band), _at(F.greatest("y1", "y2"), band))))
    crossing = (F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))
    right = F.col("x") < (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    met = points.withColumn("__band", _at("y", band)).join(listed, [*SHAPE, "__band"]).where(crossing & right)
    return met.groupBy(*keys, *SHAPE).agg(F.count(F.lit(1)).alias("__n")).where("__n % 2 = 1").drop("__n")


def _crossed(edges: DataFrame, size: float) -> DataFrame:
    """Tiles that edges touch: for each row of tiles the columns from one end of the edge's part in it to the other."""
    rows = edges.withColumn("__ty", F.explode(F.sequence(_at(F.least("y1", "y2"), size), _at(F.greatest("y1", "y2"), size))))
    part = lambda y: F.when(F.col("y1") == F.col("y2"), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (y - F.col("y1")) / (F.col("y2") - F.col("y1")))))
    x = lambda y: F.col("x1") + (F.col("x2") - F.col("x1")) * part(y)
    flat = F.col("y1") == F.col("y2")
    ends = [F.when(flat, F.col("x1")).otherwise(x(F.col("__ty") * size)), F.when(flat, F.col("x2")).otherwise(x((F.col("__ty") + 1) * size))]
    little = F.lit(1e-9) * (F.abs(F.col("x1")) + F.abs(F.col("x2")) + 1)  # a tile more does no harm
    return rows.select(*SHAPE, "__ty", F.explode(F.sequence(_at(F.least(*ends) - little, size), _at(F.greatest(*ends) + little, size))).alias("__tx")).distinct()


def cover(edges: DataFrame, tile: float = 64.0, levels: int = 2, split: int = 8, band: float = 8.0) -> DataFrame:
    """The tiles of each polygon (shape, __tx, __ty of tiles of the finest size) and whether its edges touch them (``__edge``); others lie inside.

    From coarse tiles of size ``tile`` down to ``tile / split ** (levels - 1)``: tiles that no edge touches are inside or outside as their centre
    is, and only touched ones are split further, so that a large polygon costs as many tests as its border has tiles.
    """
    bounds = edges.groupBy(*SHAPE).agg(*[f(F.col(c)).alias(n) for f, c, n in ((F.min, "x1", "__x0"), (F.max, "x1", "__x1"), (F.min, "y1", "__y0"), (F.max, "y1", "__y1"))])
    tiles = bounds.select(*SHAPE, F.explode(F.sequence(_at("__x0", tile), _at("__x1", tile))).alias("__tx"), "__y0", "__y1")
    tiles = tiles.select(*SHAPE, "__tx", F.explode(F.sequence(_at("__y0", tile), _at("__y1", tile))).alias("__ty"))
    found = None
    for level in range(levels):
        size, finer = tile / split**level, split ** (levels - 1 - level)
        crossed = _crossed(edges, size)
        key = [*SHAPE, "__tx", "__ty"]
        touched, plain = tiles.join(crossed, key, "left_semi"), tiles.join(crossed, key, "left_anti")
        centres = plain.withColumns({"x": (F.col("__tx") + 0.5) * size, "y": (F.col("__ty") + 0.5) * size})
        inside = _odd(centres, ["__tx", "__ty"], edges, band)
        parts = lambda df, n: df.withColumn("__tx", F.explode(F.sequence(F.col("__tx") * n, F.col("__tx") * n + n - 1))).withColumn("__ty", F.explode(F.sequence(F.col("__ty") * n, F.col("__ty") * n + n - 1)))
        part = parts(inside.select(*key), finer).withColumn("__edge", F.lit(False))
        found = part if found is None else found.unionByName(part)
        tiles = parts(touched.select(*key), split) if level < levels - 1 else touched.select(*key)
    return found.unionByName(tiles.withColumn("__edge", F.lit(True)))


def pixels_in_polygons(pixels: DataFrame, edges: DataFrame, band: float = 8.0, tile: float = 64.0, keys: Sequence[str] = ("row", "col"), levels: int = 2, split: int = 8) -> DataFrame:
    """The ``keys`` of ``pixels`` (with x, y) and the ``location_id`` of the polygon that holds their centre; of several the last in shape_order.

    ``keys`` tell pixels apart, such as block_key, row and col where there are several blocks. Polygons are covered by tiles; a pixel meets the
    polygons of its tile, and is in those whose tile lies inside. Only pixels of tiles that edges touch are tested, by the edges of their band.
    ``edges``: location_id, shape_order, x1, y1, x2, y2.
    """
    met = on_cover(pixels, cover(edges, tile, levels, split, band), keys, tile / split ** (levels - 1))
    tested = _odd(met.where("__edge"), keys, edges, band)
    inside = met.where("not __edge").select(*keys, *SHAPE).unionByName(tested)
    return inside.groupBy(*keys).agg(F.max_by("location_id", "shape_order").alias("location_id"))


def on_cover(pixels: DataFrame, tiles: DataFrame, keys: Sequence[str], size: float) -> DataFrame:
    """Pixels with the shapes of their tile; ``__edge`` where the pixel is still to be tested."""
    placed = pixels.select(*keys, "x", "y", _at("x", size).alias("__tx"), _at("y", size).alias("__ty"))
    return placed.join(tiles, ["__tx", "__ty"]).select(*keys, "x", "y", *SHAPE, "__edge")


def areas(edges: DataFrame, x: tuple[str, str] = ("x1", "x2"), y: tuple[str, str] = ("y1", "y2")) -> DataFrame:
    """The area of each polygon from its edges in turn (sum of the cross products of their ends)."""
    cross = F.col(x[0]) * F.col(y[1]) - F.col(x[1]) * F.col(y[0])
    return edges.groupBy("location_id").agg((F.abs(F.sum(cross)) / 2).alias("area"))


def round_trip_change(edges: DataFrame, crs: str, tolerance: float = 1e-6) -> DataFrame:
    """The area of each polygon before it goes to a system and back, there (``projected``), the relative change, and whether it is too large.

    ``edges``: location_id and x1, y1, x2, y2 in degrees. Corners are cut at the system's bounds first, as it has no places beyond. A polygon
    without area has no change to tell, and is listed as wrong. An unknown system raises ``ValueError``.
    """
    cut = edges.select("location_id", *[a.alias(n) for k in "12" for a, n in zip(coordinates.cut(crs, F.col(f"y{k}"), F.col(f"x{k}")), (f"y{k}", f"x{k}"), strict=True)])
    back = cut
    for k in "12":
        there = coordinates.project(crs, F.col(f"y{k}"), F.col(f"x{k}"))
        back = back.withColumns({f"__x{k}": there[0], f"__y{k}": there[1]})
        lat, lon = coordinates.unproject(crs, F.col(f"__x{k}"), F.col(f"__y{k}"))
        back = back.withColumns({f"__lat{k}": lat, f"__lon{k}": lon})
    before, after = areas(back), areas(back, ("__lon1", "__lon2"), ("__lat1", "__lat2")).withColumnRenamed("area", "__after")
    change = F.try_divide(F.abs(F.col("__after") - F.col("area")), F.col("area"))
    there = areas(back, ("__x1", "__x2"), ("__y1", "__y2")).withColumnRenamed("area", "projected")
    return before.join(after, "location_id").join(there, "location_id").select("location_id", "area", "projected", change.alias("change"), F.coalesce(change > tolerance, F.lit(True)).alias("wrong"))


def shapes_of_blocks(bounds: DataFrame, blocks: DataFrame, buffer: int = 10, tile: float = 64.0) -> DataFrame:
    """Which shapes touch which block, and their pixel window in it: a buffer around, cut at the block.

    ``bounds``: location_id, xmin, ymin, xmax, ymax; ``blocks``: block_key, bxmin, bymin, bxmax, bymax, in pixels of size 1, rows downwards.
    Both are listed by the square tiles that they touch and joined on the tile; a pair counts in the first tile that both touch.
    """
    at = lambda c: F.floor(F.col(c) / F.lit(tile))

    def listed(df: DataFrame, x0: str, y0: str, x1: str, y1: str) -> DataFrame:
        return df.withColumn("__tx", F.explode(F.sequence(at(x0), at(x1)))).withColumn("__ty", F.explode(F.sequence(at(y0), at(y1))))

    both = listed(blocks, "bxmin", "bymin", "bxmax", "bymax").join(listed(bounds, "xmin", "ymin", "xmax", "ymax"), ["__tx", "__ty"])
    first = (F.col("__tx") == F.greatest(at("bxmin"), at("xmin"))) & (F.col("__ty") == F.greatest(at("bymin"), at("ymin")))
    meets = (F.col("xmin") <= F.col("bxmax")) & (F.col("xmax") >= F.col("bxmin")) & (F.col("ymin") <= F.col("bymax")) & (F.col("ymax") >= F.col("bymin"))
    width, height = F.col("bxmax") - F.col("bxmin"), F.col("bymax") - F.col("bymin")
    cut = lambda x, top: F.greatest(F.lit(0), F.least(top, x)).cast("int")
    return both.where(first & meets).select(
        "block_key", "location_id",
        cut(F.floor(F.col("xmin") - F.col("bxmin")) - buffer, width).alias("col_start"), cut(F.ceil(F.col("xmax") - F.col("bxmin")) + buffer, width).alias("col_stop"),
        cut(F.floor(F.col("ymin") - F.col("bymin")) - buffer, height).alias("row_start"), cut(F.ceil(F.col("ymax") - F.col("bymin")) + buffer, height).alias("row_stop"),
    )


def block_slice(df: DataFrame, blocks: DataFrame, buffer: float = 0.1) -> DataFrame:
    """Cells of a grid (latitude, longitude) for each block (block_key, lat_min, lat_max, lon_min, lon_max), with a buffer around, cut at the world's bounds.

    Cells and blocks meet on whole degrees, so that it is no join of all cells and blocks.
    """
    low = lambda c, end: F.greatest(F.lit(end), F.col(c) - buffer)
    high = lambda c, end: F.least(F.lit(end), F.col(c) + buffer)
    wide = blocks.select("block_key", low("lat_min", -90.0).alias("__s"), high("lat_max", 90.0).alias("__n"), low("lon_min", -180.0).alias("__w"), high("lon_max", 180.0).alias("__e"))
    listed = wide.withColumn("__y", F.explode(F.sequence(F.floor("__s"), F.floor("__n")))).withColumn("__x", F.explode(F.sequence(F.floor("__w"), F.floor("__e"))))
    met = df.withColumns({"__y": F.floor("latitude"), "__x": F.floor("longitude")}).join(listed, ["__y", "__x"])
    inside = F.col("latitude").between(F.col("__s"), F.col("__n")) & F.col("longitude").between(F.col("__w"), F.col("__e"))
    return met.where(inside).select("block_key", *df.columns)


def nearest_coordinate(df: DataFrame, axis: DataFrame, column: str, into: str) -> DataFrame:
    """``df`` with the nearest of the axis' coordinates (column ``coord``); halfway the larger one, null where ``column`` or the axis is.

    The axis is cut into as many equal buckets as it has coordinates; each bucket lists its own and the next ones on both sides, so that a
    look-up is a join on the bucket and a choice of about three. Each different coordinate of ``df`` is looked up once.
    """
    coords = axis.select(F.col("coord").cast("double").alias("coord")).where("coord is not null and not isnan(coord)").distinct()
    size = coords.agg(F.min("coord").alias("__low"), F.max("coord").alias("__high"), F.count(F.lit(1)).alias("__count"))
    bucket = lambda c: F.greatest(F.lit(0), F.least(F.col("__count"), F.coalesce(F.try_divide((c - F.col("__low")) * F.col("__count"), F.col("__high") - F.col("__low")).cast("long"), F.lit(0))))
    inside = lambda c: F.greatest(F.col("__low"), F.least(F.col("__high"), c))
    have = coords.crossJoin(F.broadcast(size)).groupBy(bucket(F.col("coord")).alias("__b")).agg(F.array_sort(F.collect_list("coord")).alias("__in"))
    order = Window.orderBy("__b")
    ends = have.select("__b", "__in", F.lag("__b").over(order).alias("__before"), F.array_max(F.lag("__in").over(order)).alias("__lo"), F.array_min(F.lead("__in").over(order)).alias("__hi"))
    # Empty buckets belong to the next one that has coordinates.
    rows = ends.withColumn("__at", F.explode(F.sequence(F.coalesce(F.col("__before") + 1, F.col("__b")), F.col("__b"))))
    near = rows.select("__at", F.array_compact(F.concat(F.array("__lo"), F.col("__in"), F.array("__hi"))).alias("__near"))
    asked = df.select(F.col(column).alias("__c")).where(F.col("__c").isNotNull()).distinct()
    asked = asked.crossJoin(F.broadcast(size)).where("__count > 0").select("__c", bucket(inside(F.col("__c"))).alias("__at"))
    c = F.col("__c")
    best = F.aggregate(
        "__near", F.lit(None).cast("double"),
        lambda acc, s: F.when(acc.isNull() | (F.abs(s - c) <= F.abs(acc - c)), s).otherwise(acc),
    )
    found = asked.join(near, "__at").select("__c", best.alias(into))
    return df.join(found, df[column] == found["__c"], "left").drop("__c")


def location_sums(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted climate and population; population counts where the climate is missing too."""
    weighted = F.coalesce(F.sum(F.col("value") * F.col("population")), F.lit(0.0)).alias("weighted_climate")
    return pixels.groupBy(*keys).agg(weighted, F.coalesce(F.sum("population"), F.lit(0.0)).alias("population"))


def person_days(population: DataFrame, days: DataFrame, keys: list[str]) -> DataFrame:
    """Person-days by location, temperature bin and zone.

    ``population``: location_id, cell, population, summed over pixels; ``days``: cell, keys and n, days counted. Pixels times days are
    never formed: the two sums are joined on the cell.
    """
    people = population.groupBy("location_id", "cell").agg(F.sum("population").alias("population"))
    counted = days.groupBy("cell", *keys).agg(F.sum("n").alias("n"))
    return people.join(counted, "cell").groupBy("location_id", *keys).agg(F.sum(F.col("population") * F.col("n")).alias("person_days"))


def zero_filled(df: DataFrame, dims: list[DataFrame], value: str) -> DataFrame:
    """Every combination of the dimensions, 0 where there is none. The dimensions are small tables of keys."""
    grid = dims[0]
    for d in dims[1:]:
        grid = grid.crossJoin(d)
    return grid.join(df, grid.columns, "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def wide_bins(df: DataFrame, keys: Sequence[str], bins: str, numbers: Sequence[int], value: str, prefix: str = "t") -> DataFrame:
    """A column for each bin, 0 where there is none."""
    named = df.withColumn("__name", F.concat(F.lit(prefix), F.col(bins).cast("string")))
    return named.groupBy(*keys).pivot("__name", [f"{prefix}{n}" for n in numbers]).agg(F.sum(value)).na.fill(0.0)


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key; ties are settled by all other columns."""
    last = Window.partitionBy(*keys).orderBy(F.desc(order), *[F.desc(c) for c in df.columns if c not in (*keys, order)])
    return df.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")
