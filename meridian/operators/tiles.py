"""Rasters that are stored as tiles, cut from one raster or read by a box.

``tiles``: tile, x0 and y0 (the upper left corner), step (size of a pixel), rows, cols and rank, which settles overlaps. ``pixels``: tile, row,
col (from the corner) and value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Box = tuple[float, float, float, float]


def covering(tiles: DataFrame, box: Box, buffer: float = 0.0) -> DataFrame:
    """The tiles that share an area with a box (x and y of its lower left and upper right corner) and a buffer around it."""
    x0, y0, x1, y1 = box[0] - buffer, box[1] - buffer, box[2] + buffer, box[3] + buffer
    right, bottom = F.col("x0") + F.col("cols") * F.col("step"), F.col("y0") - F.col("rows") * F.col("step")
    return tiles.where((F.col("x0") < x1) & (right > x0) & (F.col("y0") > y0) & (bottom < y1))


def _corner(x0: float, y1: float, step: float) -> tuple[Column, Column]:
    """Column and row of a tile's upper left corner in a raster from ``x0`` and ``y1``; a tile off that raster raises."""
    left, top = (F.col("x0") - x0) / step, (y1 - F.col("y0")) / step
    off = (F.abs(F.col("step") - step) > 1e-9) | (F.abs(left - F.round(left)) > 1e-6) | (F.abs(top - F.round(top)) > 1e-6)
    checked = F.when(off, F.raise_error(F.concat(F.lit("a tile is off the raster: "), F.col("tile").cast("string")))).otherwise(F.round(left).cast("int"))
    return checked, F.round(top).cast("int")


def cut(raster: DataFrame, tiles: DataFrame, x0: float, y1: float, step: float, block: int = 16) -> DataFrame:
    """The pixels of each tile (tile, row and col from its corner, and what else the raster has) out of one raster (row and col from ``x0`` and
    ``y1``); tiles may overlap, and those beyond the raster have no pixels.

    Tiles and pixels meet in blocks of ``block`` pixels a side, so that a pixel is tested with the tiles at its block alone; blocks about as large
    as the tiles are best.
    """
    left, top = _corner(x0, y1, step)
    corners = tiles.select("tile", left.alias("__left"), top.alias("__top"), "rows", "cols")
    at = lambda c: F.floor(c / block)
    blocks = corners.withColumn("__r", F.explode(F.sequence(at(F.col("__top")), at(F.col("__top") + F.col("rows") - 1))))
    blocks = blocks.withColumn("__c", F.explode(F.sequence(at(F.col("__left")), at(F.col("__left") + F.col("cols") - 1))))
    met = raster.withColumns({"__r": at(F.col("row")), "__c": at(F.col("col"))}).join(blocks, ["__r", "__c"])
    row, col = F.col("row") - F.col("__top"), F.col("col") - F.col("__left")
    met = met.where((row >= 0) & (row < F.col("rows")) & (col >= 0) & (col < F.col("cols")))
    return met.select("tile", row.alias("row"), col.alias("col"), *[c for c in raster.columns if c not in ("row", "col")])


def mosaic(pixels: DataFrame, tiles: DataFrame, box: Box, step: float, nodata: float | None = None) -> DataFrame:
    """One raster over a box (row and col from its upper left corner, value): of overlapping tiles the first by rank that has a value there,
    ``nodata`` where none has one, so that a box without tiles is a whole raster too.

    The index of tiles is joined first, so that only tiles of the box are read; a tile whose pixels are not of the raster's size, or don't lie
    on its lines, raises.
    """
    x0, y1 = box[0], box[3]
    cols, rows = round((box[2] - box[0]) / step), round((box[3] - box[1]) / step)
    if abs(cols * step - (box[2] - box[0])) > 1e-9 or abs(rows * step - (box[3] - box[1])) > 1e-9:
        raise ValueError("the box must be whole pixels wide and high")
    left, top = _corner(x0, y1, step)
    near = covering(tiles, box).select("tile", "rank", left.alias("__left"), top.alias("__top"))
    placed = pixels.where("value is not null").join(near, "tile")
    placed = placed.select((F.col("row") + F.col("__top")).alias("row"), (F.col("col") + F.col("__left")).alias("col"), "rank", "tile", "value")
    placed = placed.where(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1))
    first = placed.groupBy("row", "col").agg(F.min_by("value", F.struct("rank", "tile")).alias("value"))
    spark = pixels.sparkSession
    lines = spark.range(rows).select(F.col("id").cast("int").alias("row"))
    grid = lines.select("row", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("col"))
    return grid.join(first, ["row", "col"], "left").select("row", "col", F.coalesce("value", F.lit(nodata).cast("double")).alias("value"))
