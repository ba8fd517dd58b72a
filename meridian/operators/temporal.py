"""Reductions in time over cells of a grid. Missing values are null; ``keys`` name the cell and whatever else is kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ("lat_i", "lon_i")


def _reducer(how: str, value: str) -> Column:
    if how == "sum":  # of nothing but missing values: 0
        return F.coalesce(F.sum(value), F.lit(0.0))
    return {"mean": F.avg, "max": F.max, "min": F.min}[how](value)


def daily(df: DataFrame, how: str, keys: Sequence[str] = CELL, ts: str = "ts", value: str = "value") -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("date"), *keys).agg(_reducer(how, value).alias("value"))


def annual(df: DataFrame, how: str, keys: Sequence[str] = CELL, value: str = "value") -> DataFrame:
    return df.groupBy(F.year("date").alias("year"), *keys).agg(_reducer(how, value).alias("value"))


def monthly_mean(df: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    return df.groupBy(F.year("date").alias("year"), F.month("date").alias("month"), *keys).agg(F.avg("value").alias("value"))


def climatology(df: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    """Each month's mean over the years, every year weighing the same whatever its number of days."""
    return monthly_mean(df, keys).groupBy("month", *keys).agg(F.avg("value").alias("value"))


def pooled_monthly_mean(df: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    """Each month's mean over all days of all years."""
    return df.groupBy(F.month("date").alias("month"), *keys).agg(F.avg("value").alias("value"))


def over(value: Column, threshold: float) -> Column:
    """Strictly above; a missing value is not."""
    return F.coalesce(value > F.lit(threshold), F.lit(False))


def between(value: Column, low: float, high: float) -> Column:
    """Strictly between."""
    return F.coalesce((value > F.lit(low)) & (value < F.lit(high)), F.lit(False))


def annual_days(df: DataFrame, condition: Column, keys: Sequence[str] = CELL) -> DataFrame:
    """Days a year on which a condition holds."""
    return df.groupBy(F.year("date").alias("year"), *keys).agg(F.count_if(condition).alias("days"))


def intervals(knots: DataFrame, x: str, y: str) -> DataFrame:
    """Knots of a piecewise-linear curve as half-open intervals, and one beyond either end on which the end value holds."""
    order = Window.orderBy(x)
    steps = knots.select(
        F.col(x).cast("double").alias("x0"), F.lead(F.col(x).cast("double")).over(order).alias("x1"),
        F.col(y).cast("double").alias("y0"), F.lead(F.col(y).cast("double")).over(order).alias("y1"),
        F.row_number().over(order).alias("n"),
    )
    far = F.lit(float("inf"))
    first = steps.where("n = 1").select((-far).alias("x0"), F.col("x0").alias("x1"), F.col("y0"), F.col("y0").alias("y1"))
    rest = steps.select("x0", F.coalesce("x1", far).alias("x1"), "y0", F.coalesce("y1", "y0").alias("y1"))
    return first.unionByName(rest)


def curve(knots: DataFrame, x: str = "temperature", y: str = "suitability") -> DataFrame:
    """The intervals of a curve as one array row, ``__curve``."""
    return intervals(knots, x, y).agg(F.array_sort(F.collect_list(F.struct("x0", "x1", "y0", "y1"))).alias("__curve"))


def on_curve(curve: Column, v: Column) -> Column:
    """A curve at a value; constant beyond its ends, null where the value is."""
    step = F.get(F.filter(curve, lambda s: (s["x0"] <= v) & (v < s["x1"])), F.lit(0))
    flat = (step["y1"] == step["y0"]) | (step["x0"] == float("-inf")) | (step["x1"] == float("inf"))
    mapped = F.when(flat, step["y0"]).otherwise(step["y0"] + (step["y1"] - step["y0"]) * (v - step["x0"]) / (step["x1"] - step["x0"]))
    return F.when(v.isNotNull(), mapped)


def interpolate(df: DataFrame, knots: DataFrame, value: str = "value", x: str = "temperature", y: str = "suitability") -> DataFrame:
    """``df`` with ``mapped``, the curve through the knots at ``value``; constant beyond its ends, null where the value is.

    The knots become one array a row long: a lookup in it stays inside the projection, where a range join would need all pairs.
    """
    return df.crossJoin(F.broadcast(curve(knots, x, y))).withColumn("mapped", on_curve(F.col("__curve"), F.col(value))).drop("__curve")


def rolling_mean(df: DataFrame, keys: Sequence[str], years: int = 10, value: str = "value") -> DataFrame:
    """Mean of the last ``years`` rows by year; null unless all of them have a value."""
    last = Window.partitionBy(*keys).orderBy("year").rowsBetween(1 - years, 0)
    return df.withColumn("rolling", F.when(F.count(value).over(last) == years, F.avg(value).over(last)))
