"""Bias correction and the splicing of series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.temporal import CELL


def window(df: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Days of some years, both included, as a range of dates that a scan can use."""
    return df.where(F.col("date").between(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(F.lit(last_year), F.lit(12), F.lit(31))))


def difference(value: Column, reference: Column) -> Column:
    return value - reference


def ratio(value: Column, reference: Column) -> Column:
    """Relative to the reference; one is added to both, so that a reference of almost nothing doesn't blow up."""
    return (value + 1) / (reference + 1)


def anomaly(target: DataFrame, reference: DataFrame, kind: str, keys: Sequence[str] = CELL) -> DataFrame:
    """Daily anomalies against the monthly reference of the same cell: ``kind`` additive or multiplicative."""
    ref = reference.select("month", *keys, F.col("value").alias("__reference"))
    joined = target.withColumn("month", F.month("date")).join(ref, ["month", *keys])
    change = {"additive": difference, "multiplicative": ratio}[kind]
    return joined.select("date", *keys, change(F.col("value"), F.col("__reference")).alias("value"))


def bias_correct(anomalies: DataFrame, historical: DataFrame, kind: str, keys: Sequence[str] = CELL) -> DataFrame:
    """Anomalies put on top of the observed monthly climatology."""
    ref = historical.select("month", *keys, F.col("value").alias("__reference"))
    joined = anomalies.withColumn("month", F.month("date")).join(ref, ["month", *keys])
    value = F.col("__reference") + F.col("value") if kind == "additive" else F.col("__reference") * F.col("value")
    return joined.select("date", *keys, value.alias("value"))


def splice(history: DataFrame, scenario: DataFrame, first_year: int) -> DataFrame:
    """History before ``first_year``, the scenario from then on."""
    start = F.make_date(F.lit(first_year), F.lit(1), F.lit(1))
    return history.where(F.col("date") < start).unionByName(scenario.where(F.col("date") >= start))


def coalesce_sources(preferred: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The preferred value where there is one, else the other, over the places of both."""
    a, b = preferred.select(*keys, F.col("value").alias("__a")), fallback.select(*keys, F.col("value").alias("__b"))
    return a.join(b, list(keys), "full").select(*keys, F.coalesce("__a", "__b").alias("value"))


def extend_last_year(df: DataFrame, last: int, keys: Sequence[str]) -> DataFrame:
    """``df`` with the year after ``last`` filled from it, shifted by its number of days, for cells that have no day of that year."""
    days = 366 if last % 4 == 0 and (last % 100 or last % 400 == 0) else 365
    have = df.where(F.year("date") == last + 1).select(*keys).distinct()
    added = df.where(F.year("date") == last).join(have, list(keys), "left_anti").withColumn("date", F.date_add("date", days))
    return df.unionByName(added)


def member_scan(member: DataFrame, keys: Sequence[str], years: tuple[int, int] | None = None, reference: tuple[int, int] = (2019, 2023), last: int = 2099) -> DataFrame:
    """Days of a model member (year, dayofyear, days_in_year of its own calendar).

    Without ``years`` the reference window, as the model has it: its day of the year counted from the first of January. With ``years``, first
    and last, days of the real calendar; the year after ``last`` is filled from it where the member lacks it.
    """
    if years is None:
        rows = member.where(F.col("year").between(*reference))
        return rows.select(*keys, F.date_add(F.make_date("year", F.lit(1), F.lit(1)), F.col("dayofyear") - 1).alias("date"), "value")
    real = align_calendar(member, keys)
    return window(extend_last_year(real, last, keys) if years[0] <= last + 1 <= years[1] else real, *years)


def align_calendar(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values of a model's calendar (year, dayofyear, days_in_year) on the days of the real one, linear in the decimal year.

    Before the first and after the last value of a cell the nearest one holds; equal calendars are left as they are.
    Each year of a cell is a merge of its own: its known values, its days, and one value of the years before and after. Those two come from a
    running look at the first and last known value of each year, so that no frame is longer than a year.
    """
    at = F.col("year") + (F.col("dayofyear") - 1) / F.col("days_in_year").cast("double")
    known = F.when(F.col("value").isNotNull(), F.struct(at.alias("at"), F.col("value").cast("double").alias("value")))
    source = df.select(*keys, "year", known.alias("known"))
    ends = source.groupBy(*keys, "year").agg(F.min("known").alias("first"), F.max("known").alias("last"))
    cell = Window.partitionBy(*keys)
    near = lambda column, order: F.last(column, ignorenulls=True).over(cell.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    around = ends.select(*keys, "year", near("last", F.col("year").asc()).alias("__before"), near("first", F.col("year").desc()).alias("__after"))
    around = around.select(*keys, "year", F.explode(F.array("__before", "__after")).alias("known")).where("known is not null")
    first, last = F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
    days = ends.select(*keys, "year", F.explode(F.sequence(first, last)).alias("date"), F.dayofyear(last).alias("n"))
    target = days.select(*keys, "year", (F.col("year") + (F.dayofyear("date") - 1) / F.col("n").cast("double")).alias("at"), "date")
    points = source.where("known is not null").unionByName(around).select(*keys, "year", F.col("known.at").alias("at"), "known")
    both = points.unionByName(target, allowMissingColumns=True)
    # Of a value and a day at the same time the value comes first, in both directions.
    one, is_day = Window.partitionBy(*keys, "year"), F.col("date").isNotNull()
    running = lambda order: F.last("known", ignorenulls=True).over(one.orderBy(order, is_day).rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("__lo", running(F.col("at").asc())).withColumn("__hi", running(F.col("at").desc()))
    lo, hi = F.col("__lo"), F.col("__hi")
    inside = lo["value"] + (hi["value"] - lo["value"]) * (F.col("at") - lo["at"]) / (hi["at"] - lo["at"])
    value = F.when(lo.isNull(), hi["value"]).when(hi.isNull() | (lo["at"] == hi["at"]), lo["value"]).otherwise(inside)
    return both.where(is_day).select(*keys, "date", value.alias("value"))
