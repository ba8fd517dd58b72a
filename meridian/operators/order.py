"""A number for each row of an ordered table, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.sources import scratch


def numbered(df: DataFrame, by: Sequence[Column], into: str, label: str = "ordered") -> DataFrame:
    """``df`` with ``into``, 1 for the first row in the order ``by``.

    Rows are dealt to partitions by ranges of the order and sorted in each; a row's number is its place there after the rows of the partitions
    before, of which a window sees one count a partition. ``by`` should tell rows apart: those that it doesn't are in one partition.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The upper bits of the id are the number of the partition, the lower ones the place in it.
    placed = scratch.written(df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()), label)
    part = F.shiftright("__at", 33).alias("__part")
    counts = placed.groupBy(part).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("__part", (before - F.col("__first") + 1).alias("__shift"))
    found = placed.withColumn("__part", part).join(F.broadcast(counts), "__part")  # a row a partition
    return found.withColumn(into, F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")
