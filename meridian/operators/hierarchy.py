"""Locations in a tree, and sums rolled up along it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators.order import numbered
from meridian.sources import scratch


def _ancestors(hierarchy: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance) for each location and all above it, itself included, for trees of any depth.

    The distance is doubled: from all pairs up to 1, 2, 4, .. levels apart, those of twice as many are made with the ones that are just as far.
    Each round is written, so that the plan of the result is one scan whatever the depth. A cycle raises ``ValueError``.
    """
    step = hierarchy.select(F.col("location_id").alias("descendant"), F.array(F.struct(F.col("location_id").alias("a"), F.lit(0).alias("d")), F.struct(F.col("parent_id").alias("a"), F.lit(1).alias("d"))).alias("up"))
    out = step.select(F.inline("up").alias("ancestor", "distance"), "descendant").where("distance = 0 or ancestor <> descendant").select("ancestor", "descendant", "distance")
    length, most = 1, None
    while not (far := out.where(F.col("distance") == length)).isEmpty():
        if length >= 8:  # deeper than trees of locations are
            most = hierarchy.count() if most is None else most
            if length > most:
                raise ValueError("the tree has a cycle")
        far = far.select(F.col("descendant").alias("__from"), F.col("ancestor").alias("__to"))
        near = out.where("distance > 0")
        further = near.join(far, near["ancestor"] == far["__from"]).select(F.col("__to").alias("ancestor"), "descendant", (F.col("distance") + length).alias("distance"))
        out = scratch.written(out.unionByName(further), "ancestors")
        length *= 2
    return out


def closure(hierarchy: DataFrame) -> DataFrame:
    """(ancestor, descendant) for each location and all above it, itself included; a root is its own parent."""
    return _ancestors(hierarchy).select("ancestor", "descendant")


def roll_up(facts: DataFrame, hierarchy: DataFrame, sums: Sequence[str], keys: Sequence[str] = ("year_id",)) -> DataFrame:
    """Sums of each location and all above it; leaves may sit at any level, and locations outside the tree are left out.

    Facts are summed by location first, so that the join and its shuffle see one row a location and key.
    """
    summed = facts.groupBy("location_id", *keys).agg(*[F.sum(c).alias(c) for c in sums])
    pairs = closure(hierarchy)
    joined = summed.join(pairs, summed["location_id"] == pairs["descendant"])
    return joined.groupBy(F.col("ancestor").alias("location_id"), *keys).agg(*[F.sum(c).alias(c) for c in sums])


def weighted_mean(total: Column, weight: Column) -> Column:
    """Null where the weight is zero."""
    return F.try_divide(total, weight)


def prune(hierarchy: DataFrame, ids: DataFrame) -> DataFrame:
    """Without the children of the locations in ``ids``, which become most detailed themselves."""
    cut = ids.select(F.col("location_id").alias("__cut")).distinct()
    kept = hierarchy.join(cut, hierarchy["parent_id"] == cut["__cut"], "left_anti")
    marked = kept.join(cut, kept["location_id"] == cut["__cut"], "left")
    return marked.withColumn("most_detailed", F.when(F.col("__cut").isNotNull(), 1).otherwise(F.col("most_detailed"))).drop("__cut")


def subset(df: DataFrame, locations: DataFrame) -> DataFrame:
    return df.join(locations.select("location_id").distinct(), "location_id", "left_semi")


def missing_locations(hierarchy: DataFrame, facts: DataFrame) -> DataFrame:
    """Most detailed locations without facts."""
    return hierarchy.where("most_detailed = 1").join(facts.select("location_id").distinct(), "location_id", "left_anti").select("location_id", "level")


def depth_first(hierarchy: DataFrame, name: str = "location_name") -> DataFrame:
    """location_id with its ``position`` in depth-first order, siblings by name; locations without a root above them are left out.

    The path of names from the root is the order; it is numbered by ranges, so that no task sees all locations.
    """
    nodes = hierarchy.select(F.col("location_id").alias("ancestor"), F.struct(F.col(name).alias("n"), F.col("location_id").alias("i")).alias("node"), (F.col("parent_id") == F.col("location_id")).alias("root"))
    steps = _ancestors(hierarchy).join(nodes, "ancestor")
    line = F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("at"), "root", "node")))
    paths = steps.groupBy(F.col("descendant").alias("location_id")).agg(line.alias("line")).where(F.col("line")[0]["root"])
    paths = paths.select("location_id", F.col("line")["node"].alias("path"))
    return numbered(paths, [F.col("path")], "position", "depth-first").select("location_id", "position")
