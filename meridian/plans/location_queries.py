"""Queries over the tree of locations, model members and the ensemble."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from meridian.operators import ensemble, hierarchy, quality, spatial
from meridian.operators.temporal import rolling_mean
from meridian.plans.fixtures import query
from meridian.sources import scratch, tables

SUMS = ["weighted_climate", "population"]

# --- locations ---
_CLOSURE = """(SELECT location_id AS ancestor, location_id AS descendant FROM hierarchy
  UNION ALL SELECT b.location_id, a.location_id FROM hierarchy a JOIN hierarchy b ON a.parent_id = b.location_id WHERE a.location_id <> a.parent_id
  UNION ALL SELECT c.location_id, a.location_id FROM hierarchy a JOIN hierarchy b ON a.parent_id = b.location_id JOIN hierarchy c ON b.parent_id = c.location_id WHERE a.level >= 2
  UNION ALL SELECT d.location_id, a.location_id FROM hierarchy a JOIN hierarchy b ON a.parent_id = b.location_id JOIN hierarchy c ON b.parent_id = c.location_id JOIN hierarchy d ON c.parent_id = d.location_id WHERE a.level >= 3)"""
_ROLLED = f"SELECT ancestor AS location_id, year_id, SUM(weighted_climate) AS weighted_climate, SUM(population) AS population FROM leaf_facts JOIN {_CLOSURE} c ON location_id = descendant GROUP BY 1, 2"


def _rolled(x):
    out = hierarchy.roll_up(x.leaf_facts, x.hierarchy, SUMS)
    return out.withColumn("value", hierarchy.weighted_mean(F.col("weighted_climate"), F.col("population")))


query("hierarchy_rollup", "location_id:i year_id:i weighted_climate:d population:d value:d", "hierarchy leaf_facts",
      f"SELECT *, weighted_climate / NULLIF(population, 0) AS value FROM ({_ROLLED}) r", _rolled)
query("combine_blocks", "location_id:i year_id:i weighted_climate:d population:d", "hierarchy",
      """SELECT 1000 + l_suppkey AS location_id, year(l_shipdate) AS year_id, SUM(l_quantity * l_extendedprice / 1000) AS weighted_climate, SUM(l_quantity) AS population
         FROM lineitem GROUP BY 1, 2""",
      lambda x: x.lineitem.groupBy((F.col("l_partkey") % 5).alias("block"), (1000 + F.col("l_suppkey")).alias("location_id"), F.year("l_shipdate").alias("year_id"))
                 .agg(F.sum(F.col("l_quantity") * F.col("l_extendedprice") / 1000).alias("weighted_climate"), F.sum("l_quantity").alias("population"))
                 .groupBy("location_id", "year_id").agg(*[F.sum(c).alias(c) for c in SUMS]))
query("location_weighted_sums", "location_id:i year_id:i measure weighted_climate:d population:d", "hierarchy",
      """SELECT 1000 + l_suppkey AS location_id, year(l_shipdate) AS year_id, l_returnflag AS measure,
                COALESCE(SUM(l_quantity * CASE WHEN l_tax > 0 THEN l_discount END), 0) AS weighted_climate, SUM(l_quantity) AS population FROM lineitem GROUP BY 1, 2, 3""",
      lambda x: spatial.location_sums(x.lineitem.select((1000 + F.col("l_suppkey")).alias("location_id"), F.year("l_shipdate").alias("year_id"), F.col("l_returnflag").alias("measure"),
                                                        F.when(F.col("l_tax") > 0, F.col("l_discount")).alias("value"), F.col("l_quantity").alias("population")),
                                      ["location_id", "year_id", "measure"]))
_PRUNED = """SELECT location_id, parent_id, level, CASE WHEN location_id IN (SELECT location_id FROM prune_list) THEN 1 ELSE most_detailed END AS most_detailed
  FROM hierarchy WHERE parent_id NOT IN (SELECT location_id FROM prune_list)"""
query("prune_hierarchy", "location_id:i parent_id:i level:i most_detailed:i", "hierarchy prune_list", _PRUNED, lambda x: hierarchy.prune(x.hierarchy, x.prune_list))
query("subset_hierarchy_view", "location_id:i year_id:i weighted_climate:d population:d", "hierarchy leaf_facts prune_list",
      f"SELECT * FROM ({_ROLLED}) r WHERE location_id IN (SELECT location_id FROM ({_PRUNED}) p)",
      lambda x: hierarchy.subset(_rolled(x), hierarchy.prune(x.hierarchy, x.prune_list)))
query("missing_locations", "location_id:i level:i", "hierarchy prune_list leaf_facts",
      f"SELECT location_id, level FROM ({_PRUNED}) p WHERE most_detailed = 1 AND location_id NOT IN (SELECT location_id FROM leaf_facts)",
      lambda x: hierarchy.missing_locations(hierarchy.prune(x.hierarchy, x.prune_list), x.leaf_facts))
query("location_population", "location_id:i year_id:i population:d", "hierarchy",
      f"""SELECT ancestor AS location_id, year_id, SUM(population) AS population FROM
          (SELECT 1000 + l_suppkey AS id, year(l_shipdate) AS year_id, SUM(l_quantity) AS population FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 1 GROUP BY 1, 2) f
          JOIN {_CLOSURE} c ON id = descendant GROUP BY 1, 2""",
      lambda x: hierarchy.roll_up(x.lineitem.where("l_returnflag = 'A' and l_linenumber = 1").select((1000 + F.col("l_suppkey")).alias("location_id"), F.year("l_shipdate").alias("year_id"), F.col("l_quantity").alias("population")),
                                  x.hierarchy, ["population"]))
query("population_comparison", "location_id:i year_id:i population:d reference:d difference:d", "hierarchy leaf_facts",
      f"""SELECT r.location_id, r.year_id, r.population, f.reference, r.population - f.reference AS difference FROM ({_ROLLED}) r
          JOIN (SELECT 100 + s_nationkey AS location_id, year(l_shipdate) AS year_id, SUM(l_quantity) AS reference FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) f
          ON r.location_id = f.location_id AND r.year_id = f.year_id""",
      lambda x: _rolled(x).join(x.lineitem.join(x.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy((100 + F.col("s_nationkey")).alias("location_id"), F.year("l_shipdate").alias("year_id"))
                                .agg(F.sum("l_quantity").alias("reference")), ["location_id", "year_id"]).withColumn("difference", F.col("population") - F.col("reference")))
query("subnational_population", "year_id:i r10:d r11:d r12:d r13:d r14:d", "hierarchy leaf_facts",
      "SELECT year_id, " + ", ".join(f"SUM(population) FILTER (location_id = {i}) AS r{i}" for i in range(10, 15)) + f" FROM ({_ROLLED}) r GROUP BY 1",
      lambda x: hierarchy.subset(_rolled(x), x.hierarchy.where("level = 1")).withColumn("r", F.concat(F.lit("r"), F.col("location_id").cast("string")))
                         .groupBy("year_id").pivot("r", [f"r{i}" for i in range(10, 15)]).agg(F.sum("population")))
query("hierarchy_dfs_order", "location_id:i position:i", "hierarchy",
      """SELECT location_id, ROW_NUMBER() OVER (ORDER BY path) AS position FROM (
           SELECT location_id, [location_name || chr(1) || lpad(location_id::VARCHAR, 8, '0')] AS path FROM hierarchy WHERE level = 0
           UNION ALL SELECT a.location_id, ['World' || chr(1) || '00000001', a.location_name || chr(1) || lpad(a.location_id::VARCHAR, 8, '0')] FROM hierarchy a WHERE a.level = 1
           UNION ALL SELECT a.location_id, ['World' || chr(1) || '00000001', b.location_name || chr(1) || lpad(b.location_id::VARCHAR, 8, '0'), a.location_name || chr(1) || lpad(a.location_id::VARCHAR, 8, '0')]
                     FROM hierarchy a JOIN hierarchy b ON a.parent_id = b.location_id WHERE a.level = 2
           UNION ALL SELECT a.location_id, ['World' || chr(1) || '00000001', c.location_name || chr(1) || lpad(c.location_id::VARCHAR, 8, '0'), b.location_name || chr(1) || lpad(b.location_id::VARCHAR, 8, '0'), a.location_name || chr(1) || lpad(a.location_id::VARCHAR, 8, '0')]
                     FROM hierarchy a JOIN hierarchy b ON a.parent_id = b.location_id JOIN hierarchy c ON b.parent_id = c.location_id WHERE a.level = 3) p""",
      lambda x: hierarchy.depth_first(x.hierarchy))
query("filtered_result_scan", "l_orderkey:i l_suppkey:i l_quantity:d", "hierarchy", "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey = 7",
      lambda x: tables.read(x.spark, f"{x.sf_dir}/lineitem.parquet", l_returnflag="R", l_suppkey=7, l_linestatus=None, columns=["l_orderkey", "l_suppkey", "l_quantity"]))


def _written(x):
    path = scratch.path(x.spark, "results")
    tables.write(x.leaf_facts, path, ["year_id"], ["location_id"])
    return tables.read(x.spark, path, columns=["location_id", "year_id", *SUMS])


query("write_results", "location_id:i year_id:i weighted_climate:d population:d", "leaf_facts", "SELECT * FROM leaf_facts", _written)

# --- members ---
_PROFILE = """SELECT variable, scenario, source, variant, MIN(year) AS year_start, MAX(year) AS year_end, COUNT(year) > COUNT(DISTINCT year) AS year_duplicates FROM member_rows GROUP BY 1, 2, 3, 4"""
_KEPT = f"""SELECT variable, source, variant FROM (SELECT variable, source, variant, COUNT(*) FILTER (year_start <= 2020 AND year_end >= 2090) AS n FROM ({_PROFILE}) p GROUP BY 1, 2, 3) c WHERE n = 3"""
_WIDE = "SELECT source, variant, " + ", ".join(f"COALESCE(BOOL_OR(variable = '{v}'), FALSE) AS {v}" for v in ("hurs", "pr", "tas")) + f" FROM ({_KEPT}) k GROUP BY 1, 2"
VARIABLES = ["hurs", "pr", "tas"]


def _kept(x):
    return ensemble.inclusion(ensemble.profile(x.member_rows), 3, 2020, 2090)


query("member_profile", "variable scenario source variant year_start:i year_end:i year_duplicates", "member_rows", _PROFILE, lambda x: ensemble.profile(x.member_rows))
query("scenario_inclusion", "source variant hurs pr tas", "member_rows", _WIDE, lambda x: ensemble.inclusion_table(_kept(x), VARIABLES))
query("availability_table", "sources:i variants:i with_tas:i with_pr:i with_hurs:i", "member_rows",
      f"""SELECT COUNT(*) AS sources, SUM(n) AS variants, COUNT(*) FILTER (tas > 0) AS with_tas, COUNT(*) FILTER (pr > 0) AS with_pr, COUNT(*) FILTER (hurs > 0) AS with_hurs FROM (
            SELECT source, COUNT(*) AS n, SUM(tas::INT) AS tas, SUM(pr::INT) AS pr, SUM(hurs::INT) AS hurs FROM ({_WIDE}) w GROUP BY 1) s""",
      lambda x: ensemble.inclusion_table(_kept(x), VARIABLES).groupBy("source").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(v).alias(v) for v in VARIABLES])
                        .agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("variants"), *[F.count_if(F.col(v) > 0).alias(f"with_{v}") for v in VARIABLES]))
query("eligible_members", "gcm_member", "member_rows", f"SELECT source || '_' || variant AS gcm_member FROM ({_WIDE}) w WHERE tas AND pr",
      lambda x: ensemble.eligible(ensemble.inclusion_table(_kept(x), VARIABLES), ["tas", "pr"]))
query("member_keys", "gcm_member source variant draw_key", "member_annual",
      "SELECT DISTINCT gcm_member, split_part(gcm_member, '_', 1) AS source, split_part(gcm_member, '_', 2) AS variant, lpad(CAST(length(gcm_member) AS VARCHAR), 3, '0') AS draw_key FROM member_annual",
      lambda x: x.member_annual.select("gcm_member").distinct().select("gcm_member", F.split("gcm_member", "_")[0].alias("source"), F.split("gcm_member", "_")[1].alias("variant"), F.lpad(F.length("gcm_member").cast("string"), 3, "0").alias("draw_key")))
query("list_members", "scenario gcm_member", "member_rows", "SELECT DISTINCT scenario, source || '_' || variant AS gcm_member FROM member_rows WHERE variable = 'tas'",
      lambda x: x.member_rows.where("variable = 'tas'").select("scenario", ensemble.member_key().alias("gcm_member")).distinct())
_LATE = "SELECT DISTINCT scenario, source || '_' || variant || '_' || variable AS gcm_member FROM member_rows WHERE year >= 2090"
query("missing_members", "scenario gcm_member", "member_rows",
      f"SELECT s.scenario, m.gcm_member FROM (SELECT DISTINCT gcm_member FROM ({_LATE}) a) m CROSS JOIN (SELECT DISTINCT scenario FROM ({_LATE}) b) s WHERE NOT EXISTS (SELECT 1 FROM ({_LATE}) h WHERE h.scenario = s.scenario AND h.gcm_member = m.gcm_member)",
      lambda x: ensemble.missing_members(x.member_rows.where("year >= 2090").select("scenario", F.concat_ws("_", "source", "variant", "variable").alias("gcm_member"))))
query("history_flag_violations", "scenario gcm_member year:i flags:i", "member_annual",
      """SELECT * FROM (SELECT scenario, gcm_member, year, (year < 1998)::INT + (scenario = 'ssp126')::INT + (gcm_member = 'BUILDING_r1')::INT AS flags FROM member_annual) t WHERE flags NOT IN (0, 3)""",
      lambda x: quality.history_flags(x.member_annual.select("scenario", "gcm_member", "year"), 1998, "ssp126", "BUILDING_r1"))

# --- the ensemble ---
_SPLIT = "SELECT DISTINCT split_part(gcm_member, '_', 1) AS source, split_part(gcm_member, '_', 2) AS variant FROM member_annual"
#: All members of the view have five sources with five variants each, so the drawn places don't depend on the data.
_RANDOM = np.random.RandomState(42)
_PICKS = [(d, _RANDOM.randint(0, 5), _RANDOM.randint(0, 5)) for d in range(100)]
_DRAWN = f"""SELECT d.draw, s.source, v.variant FROM (VALUES {', '.join(f'({d}, {i}, {j})' for d, i, j in _PICKS)}) AS d(draw, i, j)
  JOIN (SELECT source, ROW_NUMBER() OVER (ORDER BY source) - 1 AS i FROM (SELECT DISTINCT source FROM ({_SPLIT}) a) b) s ON s.i = d.i
  JOIN (SELECT source, variant, ROW_NUMBER() OVER (PARTITION BY source ORDER BY variant) - 1 AS j FROM ({_SPLIT}) c) v ON v.source = s.source AND v.j = d.j"""
_VIEW = f"SELECT d.draw, m.scenario, m.year, m.value FROM ({_DRAWN}) d JOIN member_annual m ON m.gcm_member = d.source || '_' || d.variant"


def _draws(x):
    members = x.member_annual.select(F.split("gcm_member", "_")[0].alias("source"), F.split("gcm_member", "_")[1].alias("variant"))
    return ensemble.draw_map(x.spark, members)


def _view(x):
    return ensemble.draw_view(_draws(x), x.member_annual)


query("draw_map", "draw:i source variant", "member_annual", _DRAWN, _draws)
query("draw_balance", "source draws:i variants:i", "member_annual", f"SELECT source, COUNT(*) AS draws, COUNT(DISTINCT variant) AS variants FROM ({_DRAWN}) d GROUP BY 1",
      lambda x: _draws(x).groupBy("source").agg(F.count(F.lit(1)).alias("draws"), F.count_distinct("variant").alias("variants")))
query("draw_view", "draw:i scenario year:i value:d", "member_annual", _VIEW, _view)
query("draw_summary", "scenario year:i mean:d lower:d upper:d", "member_annual",
      f"SELECT scenario, year, AVG(value) AS mean, quantile_cont(value, 0.025) AS lower, quantile_cont(value, 0.975) AS upper FROM ({_VIEW}) v GROUP BY 1, 2",
      lambda x: ensemble.summary(_view(x), ["scenario", "year"]))
query("pivot_draws", "scenario year:i " + " ".join(f"{n:03}:d" for n in range(100)), "member_annual",
      "SELECT scenario, year, " + ", ".join(f'MAX(value) FILTER (draw = {n}) AS "{n:03}"' for n in range(100)) + f" FROM ({_VIEW}) v GROUP BY 1, 2",
      lambda x: ensemble.wide_draws(_view(x), ["scenario", "year"], range(100)))
query("compile_member_series", "scenario gcm_member year:i value:d", "member_annual", "SELECT * FROM member_annual",
      lambda x: ensemble.compile_series(x.member_annual.where("year < 1998"), x.member_annual.where("year >= 1998"), ["scenario", "gcm_member", "year"]))
query("temperature_zone", "scenario gcm_member year:i zone:d", "member_annual",
      """SELECT * FROM (SELECT scenario, gcm_member, year, CASE WHEN COUNT(value) OVER w = 3 THEN AVG(value) OVER w END AS zone FROM member_annual
         WINDOW w AS (PARTITION BY scenario, gcm_member ORDER BY year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) t WHERE year >= 1996""",
      lambda x: rolling_mean(x.member_annual, ["scenario", "gcm_member"], 3).withColumnRenamed("rolling", "zone").where("year >= 1996"))

# --- catalogue ---
query("catalogue_lookup", "source_id experiment_id variable_id member_id zstore", "catalogue",
      "SELECT * FROM catalogue QUALIFY ROW_NUMBER() OVER (PARTITION BY source_id, experiment_id, variable_id, member_id ORDER BY position DESC) = 1",
      lambda x: ensemble.catalogue(x.catalogue))
query("model_inclusion_flag", "source_id position:i included", "catalogue",
      "SELECT source_id, position, CASE WHEN experiment_id = 'en' THEN TRUE WHEN experiment_id = 'de' THEN FALSE END AS included FROM catalogue",
      lambda x: x.catalogue.withColumn("raw", F.when(F.col("experiment_id") == "en", "Yes").when(F.col("experiment_id") == "de", "No").otherwise("n/a"))
                 .select("source_id", "position", ensemble.yes_or_no("raw").alias("included")))
