"""Grids: templates, axes, regridding, filling of gaps, and coarse and fine rasters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.functions.arrays import dense


def template(spark: SparkSession, x_min: float, y_min: float, stride: float, resolution: float) -> DataFrame:
    """Cells of an empty square raster, rows from the top: row, col and the centre (x, y)."""
    n = round(stride / resolution)
    if abs(n * resolution - stride) > 1e-9 * stride:
        raise ValueError("stride must be a multiple of resolution")
    rows = spark.range(n).select(F.col("id").cast("int").alias("row"))
    cells = rows.select("row", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("col"))
    return cells.select("row", "col", (F.lit(float(x_min)) + (F.col("col") + 0.5) * F.lit(float(resolution))).alias("x"), (F.lit(float(y_min + stride)) - (F.col("row") + 0.5) * F.lit(float(resolution))).alias("y"))


def brackets(source: DataFrame, target: DataFrame) -> DataFrame:
    """For each coordinate of the target axis the source coordinates around it (lo, hi) and the weight of hi; null outside the source axis.

    Both have a column ``coord``. An axis is one array, and each target looks its place up in it.
    """
    axis = source.agg(F.array_sort(F.collect_set("coord")).alias("__axis"))
    c = F.col("coord")
    lo = F.array_max(F.filter("__axis", lambda s: s <= c))
    hi = F.array_min(F.filter("__axis", lambda s: s >= c))
    out = target.crossJoin(F.broadcast(axis)).select("coord", lo.alias("lo"), hi.alias("hi"))
    inside = F.col("lo").isNotNull() & F.col("hi").isNotNull()
    weight = F.when(F.col("lo") == F.col("hi"), F.lit(0.0)).otherwise((c - F.col("lo")) / (F.col("hi") - F.col("lo")))
    return out.select("coord", F.when(inside, F.col("lo")).alias("lo"), F.when(inside, F.col("hi")).alias("hi"), F.when(inside, weight).alias("weight"))


def axes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The coordinates of a grid, as tables with a column ``coord``."""
    return df.select(F.col("latitude").alias("coord")).distinct(), df.select(F.col("longitude").alias("coord")).distinct()


def _targets(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: the source axis as an array, and for each target coordinate the places in it around it and the weight of the second one."""
    axis = source.where("coord is not null").agg(F.array_sort(F.collect_set("coord")).alias("__axis"))
    coords = target.agg(F.array_sort(F.collect_set("coord")).alias("__coords"))
    lo = lambda c: F.size(F.filter("__axis", lambda s: s <= c)) - 1
    hi = lambda c: F.size("__axis") - F.size(F.filter("__axis", lambda s: s >= c))
    row = axis.crossJoin(coords).select("__axis", F.transform("__coords", lambda c: F.struct(c.alias("coord"), lo(c).alias("lo"), hi(c).alias("hi"))).alias("__t"))
    at = lambda k: F.get("__axis", k)
    weight = lambda t: F.when(t["lo"] == t["hi"], F.lit(0.0)).otherwise((t["coord"] - at(t["lo"])) / (at(t["hi"]) - at(t["lo"])))
    inside = lambda t: (t["lo"] >= 0) & (t["hi"] < F.size("__axis"))
    return row.select("__axis", F.transform("__t", lambda t: F.struct(t["coord"].alias("coord"), F.when(inside(t), t["lo"]).alias("lo"), t["hi"].alias("hi"), weight(t).alias("w"))).alias("__targets"))


def _between(line: Column, t: Column) -> Column:
    """Linear between two places of a line; a place without weight may be missing."""
    lo, hi = F.get(line, t["lo"]), F.get(line, t["hi"])
    return F.when(t["lo"].isNull(), F.lit(None)).when(t["w"] == 0, lo).otherwise(lo * (1 - t["w"]) + hi * t["w"])


def _nearer(line: Column, t: Column) -> Column:
    """The nearer of two places of a line; halfway the lower one."""
    return F.when(t["lo"].isNotNull(), F.get(line, F.when(t["w"] <= 0.5, t["lo"]).otherwise(t["hi"])))


def _filled(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``lines`` (keys and ``__line``, an array of coord and value in order) with missing values from the nearest known one; halfway the lower.

    Each known value is repeated over the places that are nearest to it, which looks at each gap once.
    """
    known = F.filter(F.transform("__line", lambda p, i: F.struct(i.alias("i"), p["coord"].alias("coord"), p["value"].alias("value"))), lambda y: y["value"].isNotNull())
    lines = lines.select(*keys, "__line", known.alias("__known"))
    at = lambda k: F.get("__known", k)
    gap = lambda y, k: F.slice("__line", y["i"] + 2, at(k + 1)["i"] - y["i"] - 1)
    near = lambda y, k: F.size(F.filter(gap(y, k), lambda p: p["coord"] - y["coord"] <= at(k + 1)["coord"] - p["coord"]))
    after = F.transform("__known", lambda y, k: F.when(k + 1 < F.size("__known"), near(y, k)).otherwise(F.size("__line") - 1 - y["i"]))
    lines = lines.select(*keys, "__line", "__known", after.alias("__after"))
    before = lambda y, k: F.when(k == 0, y["i"]).otherwise(y["i"] - at(k - 1)["i"] - 1 - F.get("__after", k - 1))
    values = F.flatten(F.transform("__known", lambda y, k: F.array_repeat(y["value"], 1 + before(y, k) + F.get("__after", k))))
    filled = F.zip_with("__line", values, lambda p, v: F.struct(p["coord"].alias("coord"), v.alias("value")))
    return lines.select(*keys, F.when(F.size("__known") > 0, filled).otherwise(F.col("__line")).alias("__line"))


def _along(df: DataFrame, axis: str, source: DataFrame, target: DataFrame, keys: Sequence[str], value: Callable[[Column, Column], Column], fill: bool = False) -> DataFrame:
    """Values on a target axis. A line of the grid is one array, so that a target is two look-ups; ``keys`` name the line."""
    points = F.array_sort(F.collect_list(F.struct(F.col(axis).cast("double").alias("at"), F.col("value").cast("double").alias("value"))))
    lines = df.groupBy(*keys).agg(points.alias("__points")).crossJoin(F.broadcast(_targets(source, target)))
    twice = F.size(F.array_distinct(F.transform("__points", lambda p: p["at"]))) < F.size("__points")
    lines = lines.withColumn("__points", F.when(twice, F.raise_error(F.lit("a place is twice in a grid"))).otherwise(F.col("__points")))
    # A line with all its places is as the axis; in another one each place is looked up.
    whole, values = F.size("__points") == F.size("__axis"), F.transform("__points", lambda p: p["value"])
    placed = F.transform("__points", lambda p: F.struct((F.array_position("__axis", p["at"]).cast("int") - 1).alias("at"), p["value"].alias("value")))
    lines = lines.select(*keys, "__targets", F.size("__axis").alias("__size"), F.when(whole, values).alias("__line"), F.when(~whole, placed).alias("__placed"))
    lines = lines.select(*keys, "__targets", F.coalesce("__line", dense(F.col("__placed"), F.col("__size"))).alias("__line"))
    found = F.transform("__targets", lambda t: F.struct(t["coord"].alias("coord"), value(F.col("__line"), t).alias("value")))
    lines = lines.select(*keys, found.alias("__line"))
    return _cells(_filled(lines, keys) if fill else lines, axis, keys)


def _cells(lines: DataFrame, axis: str, keys: Sequence[str]) -> DataFrame:
    """A row for each place of the lines. The outer form, as for the other one Spark would add a filter on the array, and work the line out for it again."""
    return lines.select(*keys, F.inline_outer("__line")).where("coord is not null").withColumnRenamed("coord", axis)


def _regridded(df: DataFrame, lat: DataFrame, lon: DataFrame, keys: Sequence[str], source: tuple[DataFrame, DataFrame] | None, value: Callable[[Column, Column], Column], fill: bool = False) -> DataFrame:
    df = df.where("latitude is not null and longitude is not null").select(*keys, "latitude", "longitude", "value")
    at_lat, at_lon = source or axes(df)
    columns = _along(df, "latitude", at_lat, lat, [*keys, "longitude"], value)
    out = _along(columns, "longitude", at_lon, lon, [*keys, "latitude"], value, fill)
    if fill:
        line = F.array_sort(F.collect_list(F.struct(F.col("latitude").alias("coord"), "value")))
        columns = [*keys, "longitude"]
        out = _cells(_filled(out.groupBy(*columns).agg(line.alias("__line")), columns), "latitude", columns)
    return out.select(*keys, "latitude", "longitude", "value")


def bilinear(df: DataFrame, lat: DataFrame, lon: DataFrame, keys: Sequence[str] = ("date",), source: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Values on a target grid by separable linear interpolation: null outside the source axes or where a corner with weight is missing.

    Every step that has a place gets all target cells. Along latitude first, then along longitude, with one exchange for each.
    ``source``: the axes of ``df`` where they are known, else they are read from it.
    """
    return _regridded(df, lat, lon, keys, source, _between)


def nearest(df: DataFrame, lat: DataFrame, lon: DataFrame, keys: Sequence[str] = ("date",), source: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Values of the nearest node on a target grid; halfway the lower one, null outside the source axes."""
    return _regridded(df, lat, lon, keys, source, _nearer)


def filled(df: DataFrame, lat: DataFrame, lon: DataFrame, keys: Sequence[str] = ("date",), source: tuple[DataFrame, DataFrame] | None = None, how: str = "bilinear") -> DataFrame:
    """``bilinear`` or ``nearest``, and then ``fill_gaps``, in three exchanges: gaps along longitude are filled in the lines as they are made."""
    return _regridded(df, lat, lon, keys, source, {"bilinear": _between, "nearest": _nearer}[how], fill=True)


def fill_nearest(df: DataFrame, axis: str, keys: Sequence[str]) -> DataFrame:
    """Missing values from the nearest value along an axis, beyond its ends too; halfway the lower coordinate. ``keys``: the line.

    Two running windows, one in each direction: a frame that ends at the row costs the same for each of them, however long the line is.
    """
    line = Window.partitionBy(*keys)
    known = F.when(F.col("value").isNotNull(), F.struct(F.col(axis).alias("at"), "value"))
    last = lambda order: F.last(known, ignorenulls=True).over(line.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    filled = df.withColumn("__lo", last(F.col(axis).asc())).withColumn("__hi", last(F.col(axis).desc()))
    lo, hi, c = F.col("__lo"), F.col("__hi"), F.col(axis)
    value = F.when(hi.isNull() | (c - lo["at"] <= hi["at"] - c), lo["value"]).otherwise(hi["value"])
    return filled.withColumn("value", F.when(lo.isNull(), hi["value"]).otherwise(value)).drop("__lo", "__hi")


def fill_gaps(df: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Gaps of a grid filled along longitude, then along latitude."""
    return fill_nearest(fill_nearest(df, "longitude", [*keys, "latitude"]), "latitude", [*keys, "longitude"])


def annual_mean(df: DataFrame, lat: DataFrame, lon: DataFrame) -> DataFrame:
    """Annual means (year, latitude, longitude, value) of daily values brought to a target grid and filled.

    Regridding and filling are the same weights on each day of a year in which no cell lacks a day, so that there the mean is taken first and
    one grid a year is brought to the target instead of 365. Years with a gap go the whole way, day by day.
    """
    cube = df.where("latitude is not null and longitude is not null").select(F.year("date").alias("year"), "date", "latitude", "longitude", "value")
    source = axes(cube)
    cells = source[0].agg(F.count(F.lit(1)).alias("__lat")).crossJoin(source[1].agg(F.count(F.lit(1)).alias("__lon")))
    facts = cube.groupBy("year").agg(F.count("value").alias("__have"), F.count_distinct("date").alias("__days")).crossJoin(F.broadcast(cells))
    whole = facts.where(F.col("__have") == F.col("__days") * F.col("__lat") * F.col("__lon")).select("year")
    place = ["year", "latitude", "longitude"]
    first = cube.join(whole, "year", "left_semi").groupBy(*place).agg(F.avg("value").alias("value"))
    early = filled(first, lat, lon, ["year"], source)
    days = filled(cube.join(whole, "year", "left_anti"), lat, lon, ["year", "date"], source)
    return early.select(*place, "value").unionByName(days.groupBy(*place).agg(F.avg("value").alias("value")))


def coarse(factor: int, row: str = "row", col: str = "col") -> tuple[Column, Column]:
    return F.floor(F.col(row) / factor).cast("int").alias("coarse_row"), F.floor(F.col(col) / factor).cast("int").alias("coarse_col")


def block_average(df: DataFrame, value: str, factor: int) -> DataFrame:
    return df.groupBy(*coarse(factor)).agg(F.avg(value).alias("value"))


def majority(df: DataFrame, value: str, factor: int) -> DataFrame:
    """The commonest class of each coarse cell, nodata left out; of equally common ones the smallest."""
    return df.where(F.col(value).isNotNull()).groupBy(*coarse(factor)).agg(F.mode(value, True).alias("value"))


def upsample(fine: DataFrame, coarse_values: DataFrame, factor: int) -> DataFrame:
    """Each fine cell with the value of the coarse one that holds it."""
    row, col = coarse(factor)
    return fine.withColumns({"coarse_row": row, "coarse_col": col}).join(coarse_values, ["coarse_row", "coarse_col"], "left").drop("coarse_row", "coarse_col")
