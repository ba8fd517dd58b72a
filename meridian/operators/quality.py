"""Checks whose result is a table of what is wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.units import pack


def daily_cube(df: DataFrame, cells: int) -> DataFrame:
    """For each year of a daily cube (date, latitude, longitude, value) all figures at once, and whether it is whole.

    ``cells``: those of the target grid. The number of days is that of the calendar.
    """
    facts = df.groupBy(F.year("date").alias("year")).agg(
        F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count_distinct("date").alias("days"),
        F.count_distinct(F.struct("latitude", "longitude")).alias("cells"), F.count_if(F.col("value").isNull()).alias("missing"), F.count(F.lit(1)).alias("rows"),
    )
    due = F.dayofyear(F.make_date("year", F.lit(12), F.lit(31)))
    whole = (F.col("days") == due) & (F.col("cells") == cells) & (F.col("missing") == 0) & (F.col("rows") == due * cells)
    return facts.withColumn("valid", whole)


#: Columns of a daily cube, and types that its values may have.
CUBE, FRACTIONS = ("date", "latitude", "longitude", "value"), ("float", "double")


def cube_problems(df: DataFrame, lat: DataFrame, lon: DataFrame) -> DataFrame:
    """All that is wrong with a daily cube at once, as (year, problem); nothing if it is as it should be.

    Columns (missing, extra) and the type of the values count for the whole table, with a null year. For each year: first and last day, number
    of days, coordinates that are not on the target axes (column ``coord``) or that the year lacks, and missing values, NaN among them.
    """
    spark, kinds = df.sparkSession, dict(df.dtypes)
    whole = [f"missing column {c}" for c in CUBE if c not in kinds] + [f"extra column {c}" for c in df.columns if c not in CUBE]
    if kinds.get("value", "double") not in FRACTIONS:
        whole.append(f"type of value {kinds['value']}")
    out = spark.createDataFrame([(None, x) for x in whole], "year int, problem string")
    if any(c not in kinds for c in CUBE):
        return out
    cube = df.withColumn("year", F.year("date"))
    wrong = F.col("value").isNull() | F.isnan(F.col("value").cast("double"))
    facts = cube.groupBy("year").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count_distinct("date").alias("days"), F.count_if(wrong).alias("missing"))
    start, end = F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
    tests = [("first day", F.col("first") != start), ("last day", F.col("last") != end), ("number of days", F.col("days") != F.dayofyear(end)), ("missing values", F.col("missing") > 0)]
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))
    out = out.unionByName(facts.select("year", F.explode(found).alias("problem")))
    for axis, coords in (("latitude", lat), ("longitude", lon)):
        have, due = cube.select("year", F.col(axis).alias("coord")).distinct(), facts.select("year").crossJoin(coords.select("coord").distinct())
        for name, x, y in ((f"{axis} off the axis", have, due), (f"{axis} lacking", due, have)):
            out = out.unionByName(x.join(y, ["year", "coord"], "left_anti").select("year", F.lit(name).alias("problem")).distinct())
    return out


def beyond_packing(df: DataFrame, scale: float, offset: float = 0.0) -> DataFrame:
    """Rows with a value that the 16-bit form can't hold and would take for a missing one."""
    return df.where(F.col("value").isNotNull() & (pack(F.col("value"), scale, offset) == -32767))


def work_counts(expected: DataFrame, done: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """How many of the expected partitions are to be run and how many are complete, for each ``by``."""
    marked = expected.join(done.select(*keys).distinct().withColumn("__done", F.lit(True)), keys, "left")
    return marked.groupBy(*by).agg(F.count_if(F.col("__done").isNull()).alias("to_run"), F.count("__done").alias("complete"))


def empty_slices(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Expected slices without a row."""
    return expected.join(found.select(*keys).distinct(), keys, "left_anti")


def history_flags(tasks: DataFrame, first_scenario_year: int = 2024, history: str = "historical", member: str = "era5") -> DataFrame:
    """Tasks (scenario, gcm_member, year) of which only some of the three say that they are history."""
    flags = [(F.col("year") < first_scenario_year).cast("int"), (F.col("scenario") == history).cast("int"), (F.col("gcm_member") == member).cast("int")]
    n = flags[0] + flags[1] + flags[2]
    return tasks.withColumn("flags", n).where("flags not in (0, 3)")


def remaining(expected: DataFrame, done: DataFrame, keys: list[str], overwrite: bool = False) -> DataFrame:
    """Expected partitions that are still to be computed: all of them with ``overwrite``."""
    return expected if overwrite else expected.join(done.select(*keys).distinct(), keys, "left_anti")
