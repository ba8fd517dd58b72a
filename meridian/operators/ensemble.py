"""Model members: their profiles and keys, which are kept, and the draws of an ensemble."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.operators.spatial import latest

MEMBER = ("variable", "scenario", "source", "variant")


def profile(rows: DataFrame, coordinates: Sequence[str] = ("year",), keys: Sequence[str] = MEMBER) -> DataFrame:
    """First and last year of each member, and whether a coordinate occurs twice."""
    doubled = [(F.count(c) > F.count_distinct(c)).alias(f"{c}_duplicates") for c in coordinates]
    return rows.groupBy(*keys).agg(F.min("year").alias("year_start"), F.max("year").alias("year_end"), *doubled)


def valid(start: int = 2020, end: int = 2099):
    """Whether a profile covers the years."""
    return (F.col("year_start") <= start) & (F.col("year_end") >= end)


def inclusion(profiles: DataFrame, scenarios: int = 3, start: int = 2020, end: int = 2099) -> DataFrame:
    """(variable, source, variant) of which all scenarios are valid."""
    kept = profiles.groupBy("variable", "source", "variant").agg(F.count_if(valid(start, end)).alias("n"))
    return kept.where(F.col("n") == scenarios).select("variable", "source", "variant")


def inclusion_table(kept: DataFrame, variables: Sequence[str]) -> DataFrame:
    """A row for each (source, variant) and a boolean column for each variable."""
    wide = kept.groupBy("source", "variant").pivot("variable", list(variables)).agg(F.lit(True))
    return wide.na.fill(False, subset=list(variables))


def catalogue(entries: DataFrame, source: str | None = None, experiment: str | None = None, variable: str | None = None, table: str | None = None, order: str = "position") -> DataFrame:
    """Entries of the model catalogue for a source, experiment, variable and table (None: any); of a member listed twice the last by ``order``."""
    for name, value in (("source_id", source), ("experiment_id", experiment), ("variable_id", variable), ("table_id", table)):
        if value is not None:
            entries = entries.where(F.col(name) == value)
    return latest(entries, ["source_id", "experiment_id", "variable_id", "member_id"], order)


def yes_or_no(column: str):
    """Yes and No as booleans, anything else as null."""
    return F.when(F.col(column) == "Yes", True).when(F.col(column) == "No", False)


def eligible(table: DataFrame, required: Sequence[str]) -> DataFrame:
    """Keys of the members that have all required variables."""
    condition = F.lit(True)
    for v in required:
        condition &= F.col(v)
    return table.where(condition).select(member_key().alias("gcm_member"))


def member_key():
    return F.concat_ws("_", "source", "variant")


def missing_members(present: DataFrame) -> DataFrame:
    """Members (scenario, gcm_member) that some scenario has and this one lacks."""
    have = present.select("scenario", "gcm_member").distinct()
    every = have.select("gcm_member").distinct().crossJoin(F.broadcast(have.select("scenario").distinct()))
    return every.join(have, ["scenario", "gcm_member"], "left_anti").select("scenario", "gcm_member")


def compile_series(history: DataFrame, scenario: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History and scenario as one series; a place that both have raises when the result is computed."""
    both = history.unionByName(scenario)
    twice = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    checked = F.when(twice > 1, F.raise_error(F.lit("a place is in history and scenario"))).otherwise(F.lit(True))
    return both.withColumn("__once", checked).where("__once").drop("__once")


def draw_map(spark: SparkSession, members: DataFrame, draws: int = 100, seed: int = 42) -> DataFrame:
    """(draw, source, variant): the source uniform among sources, the variant uniform among those of the source.

    Sources and the variants of each are ranked by name, so a draw doesn't depend on how they are found, and all scenarios share it. A task
    draws places from the number of variants of each source, which is all that it sees of the ensemble; the drawn places are then joined.
    numpy's legacy generator gives the same stream in every version; each draw takes one number for the source and one for the variant.
    """
    distinct = members.select("source", "variant").distinct()
    counts = distinct.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    listed = counts.agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("sources"))

    def drawn(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            for sources in batch["sources"]:
                state = np.random.RandomState(seed)
                names, rows = [r["source"] for r in sources], []
                for d in range(draws if names else 0):
                    k = state.randint(0, len(names))
                    rows.append((d, names[k], int(state.randint(0, sources[k]["n"]))))
                yield pd.DataFrame(rows, columns=["draw", "source", "place"])

    places = listed.mapInPandas(drawn, "draw int, source string, place int")
    ranked = distinct.withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy("variant")) - 1)
    return places.join(ranked, ["source", "place"]).select("draw", "source", "variant")


def draw_view(draws: DataFrame, compiled: DataFrame) -> DataFrame:
    """The data of each draw's member, in all scenarios; nothing is copied."""
    keyed = draws.select("draw", member_key().alias("gcm_member"))
    return compiled.join(F.broadcast(keyed), "gcm_member")


def summary(draws: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean and the 2.5th and 97.5th percentiles (linear between values) over the draws."""
    bounds = F.percentile(value, F.array(F.lit(0.025), F.lit(0.975)))
    return draws.groupBy(*keys).agg(F.avg(value).alias("mean"), bounds.alias("__p")).select(*keys, "mean", F.col("__p")[0].alias("lower"), F.col("__p")[1].alias("upper"))


def wide_draws(draws: DataFrame, keys: Sequence[str], numbers: Sequence[int], value: str = "value") -> DataFrame:
    """A column for each draw, named by its three digits."""
    named = draws.withColumn("__name", F.lpad(F.col("draw").cast("string"), 3, "0"))
    return named.groupBy(*keys).pivot("__name", [f"{n:03}" for n in numbers]).agg(F.first(value))
