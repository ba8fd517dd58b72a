"""Tables of a store by name: their partition keys, columns, axes and units, so that a scan asks for a slice and gets it in the library's form."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions import coordinates
from meridian.sources.tables import without_nan


class EmptySlice(ValueError):
    """A scan that should have rows has none."""


@dataclass(frozen=True)
class Source:
    """A partitioned table.

    ``schema`` states all columns, so that no file is opened to learn it; ``keys`` are its partition columns. ``rename``: names in the files to
    names of the library. ``units``: a step for the value of each variable, which the key ``variable`` tells. ``step``: that of the axes,
    to which coordinates are snapped; ``wrap``: longitudes run from 0 to 360 in the files.
    """

    path: str
    schema: str
    keys: tuple[str, ...]
    rename: Mapping[str, str] = field(default_factory=dict)
    units: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    step: float | None = None
    wrap: bool = False


def _in_units(source: Source, variable: object) -> Column:
    """The value in the library's units: one step where the scan names one variable, else one for each row's variable."""
    value = F.col("value")
    if isinstance(variable, str):
        return source.units[variable](value) if variable in source.units else value
    out = F.when(F.lit(False), value)
    for name, unit in source.units.items():
        out = out.when(F.col("variable") == name, unit(value))
    return out.otherwise(value)


def scan(spark: SparkSession, source: Source, may_be_empty: bool = False, **keys: object) -> DataFrame:
    """A slice of a table: the values of keys filter it (one, or a list of them; None is no filter), and partitions outside are not read.

    A key that the table doesn't have raises ``KeyError``, and a slice without a row ``EmptySlice``.
    """
    df = spark.read.schema(source.schema).parquet(source.path)
    for name, value in keys.items():
        if name not in source.keys:
            raise KeyError(f"{name} is no key of {source.path}")
        if value is not None:
            df = df.where(F.col(name).isin(list(value)) if isinstance(value, (list, tuple, range)) else F.col(name) == F.lit(value))
    if not may_be_empty and df.isEmpty():
        raise EmptySlice(f"no rows in {source.path} for {keys}")
    df = without_nan(df.withColumnsRenamed(dict(source.rename)))
    if source.units:
        df = df.withColumn("value", _in_units(source, keys.get("variable")))
    if source.wrap:
        df = df.withColumn("longitude", coordinates.wrap_longitude(F.col("longitude")))
    if source.step:
        df = df.withColumns({c: coordinates.snap(F.col(c), source.step) for c in ("latitude", "longitude")})
    return df


def scan_of(work: DataFrame, source: Source, spark: SparkSession, **keys: object) -> DataFrame:
    """The slices that a table of keys asks for: Spark prunes the partitions by it when the job runs."""
    on = [c for c in work.columns if c in source.keys]
    return scan(spark, source, may_be_empty=True, **keys).join(work.select(*on).distinct(), on, "left_semi")
