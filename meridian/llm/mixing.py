"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a cap of ``max_epochs`` times its size. The budget is poured in proportion to the weights; a source that
reaches its cap stays there, and its excess goes to the others by weight until no source is above its cap. The fixed point has a closed
form: sort sources by cap / weight, and the level of the water is the first at which the next source still has room. Each document is then
taken whole ``floor(target / source size)`` times, and the rest of the target is filled by documents in a seeded order; the one at the
boundary gives its leading words only, so that a source takes its target to within a word.

Defined results: a null text has size 0 and is taken 0 words; a null source is a source of its own, after all others; rows with one doc_id
are separate documents in a fixed order; an empty table gives an empty result; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.llm.common import WORD, documents, materialise

WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """``sources`` (source, source_size), with ``target``. One row a source: its windows see that table only, never documents."""
    ranked = sources.withColumn("__rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod(F.col("__rank") - 1, F.lit(len(WEIGHTS))).cast("int") + 1)
    ranked = ranked.withColumn("__w", weight).withColumn("__cap", F.col("source_size") * F.lit(max_epochs))
    by_room = Window.orderBy(F.col("__cap") / F.col("__w"), "__rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = ranked.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(share)).alias("__budget"),
        F.coalesce(F.sum("__cap").over(by_room), F.lit(0.0)).alias("__full"),
        (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(by_room), F.lit(0.0))).alias("__open"),
    )
    # The level if all sources before this one are full; it holds where this one still has room, and the first such level is the answer.
    level = (F.col("__budget") - F.col("__full")) / F.col("__open")
    filled = filled.withColumn("__level", F.when(level * F.col("__w") <= F.col("__cap"), level))
    first = F.min(F.when(F.col("__level").isNotNull(), F.struct((F.col("__cap") / F.col("__w")).alias("a"), F.col("__rank").alias("b"), F.col("__level").alias("c")))).over(everything)
    filled = filled.withColumn("__water", first.getField("c"))
    target = F.when(F.col("__water").isNull(), F.col("__cap")).otherwise(F.least(F.col("__cap"), F.col("__water") * F.col("__w")))
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, share: float = 1.5, max_epochs: float = 2.0, seed: int = 42, digits: int = 3) -> DataFrame:
    """The columns of ``docs`` but text and n_chars (and those that clash), with size, source_size, target, repeats, part_words, taken.

    ``digits``: the seeded order is cut into 16**digits runs a source, each summed on its own, so that a source with a third of all rows is
    spread over as many tasks.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = docs.select("doc_id", "source", word_count().alias("size"), order.alias("__h"))
    sized = materialise(sized.withColumn("__run", F.substring("__h", 1, digits)), "mix-sizes")
    runs = sized.groupBy("source", "__run").agg(F.sum("size").alias("__n"))
    targets = water_fill(runs.groupBy("source").agg(F.sum("__n").alias("source_size")), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("__whole", whole)
    targets = targets.withColumn("__rest", F.floor(F.col("target") + 0.5).cast("long") - F.col("__whole") * F.col("source_size"))
    before = Window.partitionBy("source").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    starts = starts.join(targets, starts["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    within = Window.partitionBy("source", "__run").orderBy("__h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("__in_run", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = placed.join(starts, placed["source"].eqNullSafe(starts["source"]) & (placed["__run"] == starts["__run"]))
    part = F.greatest(F.lit(0), F.least(placed["size"], F.col("__rest") - F.col("__start") - F.col("__in_run")))
    joined = joined.withColumn("__part", part)
    full = (F.col("__part") == placed["size"]) & (placed["size"] > 0)
    return joined.select(
        placed["doc_id"], placed["source"], placed["size"], "source_size", "target",
        (F.col("__whole") + F.when(full, 1).otherwise(0)).cast("long").alias("repeats"),
        F.when(full, 0).otherwise(F.col("__part")).cast("long").alias("part_words"),
        (F.col("__whole") * placed["size"] + F.col("__part")).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, share: float = 1.5, max_epochs: float = 2.0, seed: int = 42) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document as often as it is taken, and its leading words where it is taken in part."""
    same = Window.partitionBy("doc_id", "source", "__size").orderBy(F.xxhash64("text"))
    numbered = docs.withColumn("__size", word_count()).withColumn("__no", F.row_number().over(same))
    plan = mix(docs, share, max_epochs, seed).where("repeats > 0 or part_words > 0")
    plan = plan.withColumn("__no", F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("repeats", "part_words")))
    plan = plan.select(F.col("doc_id").alias("__id"), F.col("source").alias("__src"), F.col("size").alias("__n"), F.col("__no").alias("__k"), F.col("repeats").alias("__repeats"), F.col("part_words").alias("__part"))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__src")) & (F.col("__size") == F.col("__n")) & (F.col("__no") == F.col("__k"))
    taken = numbered.join(plan, on)
    taken = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__repeats") + F.when(F.col("__part") > 0, 1).otherwise(0))))
    leading = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("__part").cast("int")), " ")
    text = F.when(F.col("__copy") > F.col("__repeats"), leading).otherwise(F.col("text"))
    changed = {"text": text} | ({"n_chars": F.length(text).cast("long")} if "n_chars" in docs.columns else {})
    return taken.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op2_mixing": op2_mixing}
#: Water-filling as a loop over levels would be a recursive query; sorted by room it is a running sum.
ORACLE = {
    "op2_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('42:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
src AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM src),
weighed AS (
  SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS cap FROM ranked),
leveled AS (
  SELECT *, (SUM(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget,
         COALESCE(SUM(cap) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
         SUM(w) OVER () - COALESCE(SUM(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_
  FROM weighed),
water AS (
  SELECT (budget - full_) / open_ AS level FROM leveled
  WHERE (budget - full_) / open_ * w <= cap ORDER BY cap / w, rk LIMIT 1),
target AS (
  SELECT source, source_size, CASE WHEN (SELECT level FROM water) IS NULL THEN cap ELSE LEAST(cap, (SELECT level FROM water) * w) END AS target FROM leveled),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(FLOOR(target / source_size) AS BIGINT) ELSE 0 END AS whole_ FROM target),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole_, CAST(FLOOR(p.target + 0.5) AS BIGINT) - p.whole_ * p.source_size AS rest,
         COALESCE(SUM(s.size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(whole_ * size + GREATEST(0, LEAST(size, rest - before)) AS BIGINT) AS taken FROM placed
"""
}
