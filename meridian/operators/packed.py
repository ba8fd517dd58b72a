"""A daily cube packed by year: one row a cell and year, its days as an array of 16-bit numbers, and reductions over the arrays.

A year of a cell is one row instead of 365, and its values are two bytes each. Reductions look at the array alone: no row a day is made, and
nothing is shuffled, as a row has all that its result needs. Sums are of whole numbers, and so exact. Days without a value hold ``MISSING``.
A cube packed with ``wide`` has a second array of that name, null but in years with a value beyond 16 bits: there it holds the year's whole
numbers as fractions, so that such a value is kept; without it, it is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.arrays import dense
from meridian.functions.units import missing
from meridian.operators.temporal import CELL, curve, on_curve

MISSING = -32767


def _stored(lines: DataFrame, keys: Sequence[str], wide: bool) -> DataFrame:
    """Lines of whole numbers (``__line``) in their storage form."""
    narrow = lambda v: v.try_cast("smallint")
    beyond = F.exists("__line", lambda v: v.isNotNull() & (narrow(v).isNull() | (v == MISSING)))
    values = F.transform("__line", lambda v: F.coalesce(narrow(v), F.lit(MISSING).cast("smallint"))).alias("values")
    return lines.select(*keys, "year", values, *([F.when(beyond, F.col("__line")).alias("wide")] if wide else []))


def _line(packed: DataFrame) -> Column:
    """The whole numbers of a year as fractions, null where a day has no value."""
    line = F.transform("values", lambda v: F.when(v != MISSING, v.cast("double")))
    return F.coalesce(F.col("wide"), line) if "wide" in packed.columns else line


def _whole(x: Column, scale: float, offset: float = 0.0) -> Column:
    return missing(F.rint((x - F.lit(offset)) / F.lit(scale)))


def _value(whole: Column, scale: float, offset: float = 0.0) -> Column:
    return whole * F.lit(scale) + F.lit(offset)


def pack_years(df: DataFrame, scale: float, offset: float = 0.0, keys: Sequence[str] = CELL, wide: bool = False) -> DataFrame:
    """(keys, year, values, and wide if asked for) of daily values (date, keys, value): a value for each day of the real calendar. A day given twice raises."""
    point = F.struct((F.dayofyear("date") - 1).alias("at"), _whole(F.col("value"), scale, offset).alias("value"))
    years = df.groupBy(*keys, F.year("date").alias("year")).agg(F.array_sort(F.collect_list(point)).alias("__points"))
    days = F.dayofyear(F.make_date("year", F.lit(12), F.lit(31)))
    return _stored(years.select(*keys, "year", dense(F.col("__points"), days).alias("__line")), keys, wide)


def days(packed: DataFrame, scale: float, offset: float = 0.0, keys: Sequence[str] = CELL) -> DataFrame:
    """The days of a packed cube as rows again (date, keys, value), null where a day has no value."""
    rows = packed.select(*keys, "year", F.posexplode(_line(packed)).alias("__day", "__whole"))
    return rows.select(F.date_add(F.make_date("year", F.lit(1), F.lit(1)), F.col("__day")).alias("date"), *keys, _value(F.col("__whole"), scale, offset).alias("value"))


def _present(line: Column) -> Column:
    return F.filter(line, lambda v: v.isNotNull())


def _total(line: Column) -> Column:
    return F.aggregate(line, F.lit(0.0), lambda total, v: total + v)


def annual(packed: DataFrame, how: str, scale: float, offset: float = 0.0, keys: Sequence[str] = CELL) -> DataFrame:
    """The year's mean, max, min or sum of each cell; null where it has no value, but a sum of nothing is 0."""
    rows = packed.select("year", *keys, _present(_line(packed)).alias("__v"))
    n, raw = F.size("__v"), F.col("__v")
    value = {
        "mean": lambda: F.when(n > 0, _total(raw) / n * F.lit(scale) + F.lit(offset)),
        "max": lambda: F.array_max(raw) * F.lit(scale) + F.lit(offset),
        "min": lambda: F.array_min(raw) * F.lit(scale) + F.lit(offset),
        "sum": lambda: _total(raw) * F.lit(scale) + n * F.lit(offset),
    }[how]()
    return rows.select("year", *keys, value.alias("value"))


def annual_days(packed: DataFrame, condition: Callable[[Column], Column], scale: float, offset: float = 0.0, keys: Sequence[str] = CELL) -> DataFrame:
    """Days a year on which a condition on the value holds, as ``temporal.over`` and ``temporal.between`` give it."""
    return packed.select("year", *keys, F.size(F.filter(_line(packed), lambda v: condition(_value(v, scale, offset)))).alias("days"))


def curve_sum(packed: DataFrame, knots: DataFrame, scale: float, offset: float = 0.0, keys: Sequence[str] = CELL, x: str = "temperature", y: str = "suitability") -> DataFrame:
    """The year's sum of a piecewise-linear curve at the values of each cell; the curve is one array row."""
    rows = packed.crossJoin(F.broadcast(curve(knots, x, y)))
    mapped = F.aggregate(_line(packed), F.lit(0.0), lambda total, v: total + F.coalesce(on_curve(F.col("__curve"), _value(v, scale, offset)), F.lit(0.0)))
    return rows.select("year", *keys, mapped.alias("value"))


def combine(a: DataFrame, b: DataFrame, how: Callable[[Column, Column], Column], scales: tuple[float, float, float], keys: Sequence[str] = CELL) -> DataFrame:
    """A packed cube of two variables, day by day, over the cells and years of both; missing where one of them is, and wide if one of them is.
    ``scales``: of a, b and the result."""
    lines = a.select(*keys, "year", _line(a).alias("__a")).join(b.select(*keys, "year", _line(b).alias("__b")), [*keys, "year"])
    made = F.zip_with("__a", "__b", lambda v, w: _whole(how(_value(v, scales[0]), _value(w, scales[1])), scales[2]))
    return _stored(lines.select(*keys, "year", made.alias("__line")), keys, "wide" in a.columns or "wide" in b.columns)
