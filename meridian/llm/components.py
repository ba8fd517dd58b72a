"""Connected components of a table of links, by alternating large and small stars.

Each star step links the neighbours of a node to the smallest of them; the steps end when nothing changes, after about log(nodes) rounds.
A node with very many links is a hot key of the join that gives each link its node's minimum: links carry a random-looking salt and the
minima are repeated for each salt, so such a node is spread over SALTS tasks. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import materialise

SALTS = 16


def with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """``links`` (n, x) with the minimum m of the node n, from ``least`` (n, m), which has each n once.

    The salted minima are SALTS times what Spark takes them for, so they are not to be broadcast on its estimate.
    """
    salted = links.withColumn("__salt", F.pmod(F.xxhash64("x"), F.lit(SALTS)).cast("int"))
    spread = least.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread.hint("merge"), ["n", "__salt"]).drop("__salt")


def _large(links: DataFrame) -> DataFrame:
    both = links.select(F.col("u").alias("n"), F.col("v").alias("x")).unionAll(links.select(F.col("v").alias("n"), F.col("u").alias("x")))
    least = both.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m"))
    return with_least(both.where("x > n"), least).select(F.col("x").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.col("u").alias("n"), F.col("v").alias("x"))
    least = down.groupBy("n").agg(F.min("x").alias("m"))
    moved = with_least(down, least).where("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (two bigint columns a and b) but the roots; the root is the smallest node reachable.

    Links in either direction, repeated links and links of a node to itself are allowed; an empty table gives an empty result.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, mark = materialise(links, "links"), None
    while True:
        new = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if new == mark or not new["n"]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = new
        links = materialise(_small(_large(links)), "links")
