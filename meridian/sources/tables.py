"""Reading and writing of keyed tables. Filters on partition keys and columns reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meridian.functions.units import missing, pack, unpack

#: Scale of the 16-bit form of each variable.
SCALES = {
    "mean_temperature": 0.01, "max_temperature": 0.01, "min_temperature": 0.01, "sea_surface_temperature": 0.01, "wind_speed": 0.01,
    "relative_humidity": 0.01, "total_precipitation": 0.1, "annual_precipitation": 10.0, "days": 1.0,
}


def read(spark: SparkSession, path: str, schema: StructType | str | None = None, columns: list[str] | None = None, **keys) -> DataFrame:
    """A table with equality filters; a key given as None is no filter, one given as a list takes any of its values. NaN is read as null."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    for name, value in keys.items():
        if value is not None:
            df = df.where(F.col(name).isin(value) if isinstance(value, (list, tuple)) else F.col(name) == F.lit(value))
    return without_nan(df.select(*columns) if columns else df)


def without_nan(df: DataFrame) -> DataFrame:
    """Every column of fractions with null for NaN: each scan goes through this, as Spark's sums would keep a NaN."""
    return df.withColumns({c: missing(F.col(f"`{c}`")).cast(kind) for c, kind in df.dtypes if kind in ("float", "double")})


def write(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None = None) -> None:
    """Write a table by its keys; only the partitions that ``df`` has are replaced. Spark splits a large key over tasks, and joins small ones."""
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_packed(df: DataFrame, path: str, scale: float, partition_by: list[str], offset: float = 0.0) -> None:
    """Write ``value`` in its 16-bit form."""
    write(df.withColumn("value", pack(F.col("value"), scale, offset)), path, partition_by)


def read_packed(spark: SparkSession, path: str, scale: float, offset: float = 0.0, **keys) -> DataFrame:
    return read(spark, path, **keys).withColumn("value", unpack(F.col("value"), scale, offset))


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Station files of a folder (CSV with a header) as one table; the station's name is text, leading zeros and all."""
    schema = "STATION string, DATE date, LATITUDE double, LONGITUDE double, ELEVATION double, TEMP double"
    return without_nan(spark.read.option("header", True).schema(schema).csv(folder))
