"""Views that give the benchmark tables the shape of grids, stations, members, rasters and locations.

Each view is SQL that Spark and the oracle read alike. Queries take the views as DataFrames and apply the library's operators to them; the
oracle states the whole query in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

VIEWS = {
    "hourly": """
        SELECT event_id, ts, event_type AS variable, CAST(FLOOR(user_id / 15) AS INT) % 10 AS lat_i, CAST(user_id % 15 AS INT) AS lon_i,
               CAST(45 - 10 * (CAST(FLOOR(user_id / 15) AS INT) % 10) AS DOUBLE) AS latitude, CAST(24 * (user_id % 15) AS DOUBLE) AS longitude,
               250 + value / 10 AS value, CAST(1 + 4 * (event_id % 2) AS INT) AS expver
        FROM events""",
    "daily_grid": """
        SELECT CAST(FLOOR(s_nationkey / 5) AS INT) AS lat_i, CAST(s_nationkey % 5 AS INT) AS lon_i, CAST(20 - 10 * FLOOR(s_nationkey / 5) AS DOUBLE) AS latitude,
               CAST(-20 + 10 * (s_nationkey % 5) AS DOUBLE) AS longitude, CAST(l_shipdate AS DATE) AS date, AVG(l_quantity) - 10 AS value, 10 * SUM(l_discount) AS precip
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey, CAST(l_shipdate AS DATE)""",
    "daily_region": """
        SELECT n_regionkey AS cell, CAST(l_shipdate AS DATE) AS date, AVG(l_quantity) - 10 AS value
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey, CAST(l_shipdate AS DATE)""",
    "grid_region": """
        SELECT CAST(FLOOR(n_nationkey / 5) AS INT) AS lat_i, CAST(n_nationkey % 5 AS INT) AS lon_i, date, value
        FROM nation JOIN daily_region ON n_regionkey = cell""",
    "dense_grid": """
        SELECT d.date, c.latitude, c.longitude, g.value
        FROM (SELECT DISTINCT date FROM daily_grid) d CROSS JOIN (SELECT DISTINCT latitude, longitude FROM daily_grid) c
        LEFT JOIN daily_grid g ON g.date = d.date AND g.latitude = c.latitude AND g.longitude = c.longitude""",
    "hierarchy": """
        SELECT CAST(1 AS INT) AS location_id, CAST(1 AS INT) AS parent_id, 0 AS level, 0 AS most_detailed, 'World' AS location_name
        UNION ALL SELECT CAST(10 + r_regionkey AS INT), 1, 1, 0, r_name FROM region
        UNION ALL SELECT CAST(100 + n_nationkey AS INT), CAST(10 + n_regionkey AS INT), 2, 0, n_name FROM nation
        UNION ALL SELECT CAST(1000 + s_suppkey AS INT), CAST(100 + s_nationkey AS INT), 3, 1, s_name FROM supplier""",
    "prune_list": "SELECT * FROM (VALUES (120), (121), (122), (123), (124)) AS t(location_id)",
    "leaf_facts": """
        SELECT CAST(1000 + l_suppkey AS INT) AS location_id, CAST(year(l_shipdate) AS INT) AS year_id, SUM(l_quantity) AS population,
               SUM(l_quantity * l_extendedprice / 1000) AS weighted_climate
        FROM lineitem GROUP BY 1000 + l_suppkey, year(l_shipdate)""",
    "member_rows": """
        SELECT * FROM (
          SELECT CASE o_orderstatus WHEN 'F' THEN 'ssp126' WHEN 'O' THEN 'ssp245' ELSE 'ssp585' END AS scenario, c_mktsegment AS source,
                 'r' || substr(o_orderpriority, 1, 1) AS variant, CASE o_custkey % 3 WHEN 0 THEN 'tas' WHEN 1 THEN 'pr' ELSE 'hurs' END AS variable,
                 CAST(2015 + 15 * (year(o_orderdate) - 1995) AS INT) AS year, o_orderkey AS orderkey,
                 (length(c_mktsegment) + CAST(substr(o_orderpriority, 1, 1) AS INT) + o_custkey % 3) % 4 AS fate
          FROM orders JOIN customer ON o_custkey = c_custkey) m
        WHERE NOT (scenario = 'ssp585' AND fate = 0 AND year >= 2090)""",
    "member_annual": """
        SELECT CASE o_orderstatus WHEN 'F' THEN 'ssp126' WHEN 'O' THEN 'ssp245' ELSE 'ssp585' END AS scenario,
               c_mktsegment || '_r' || substr(o_orderpriority, 1, 1) AS gcm_member, CAST(year(o_orderdate) AS INT) AS year, AVG(o_totalprice) / 10000 AS value
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY o_orderstatus, c_mktsegment, substr(o_orderpriority, 1, 1), year(o_orderdate)""",
    "stations": """
        SELECT c_name AS station, CAST(-45 + c_custkey % 91 AS DOUBLE) AS lat, CAST(-180 + (7 * c_custkey) % 360 AS DOUBLE) AS lon, 32 + c_acctbal / 200 AS temp_f,
               CASE WHEN c_acctbal < 0 THEN CAST(-999.9 AS DOUBLE) ELSE CAST(c_custkey % 3000 AS DOUBLE) END AS elevation, CAST(c_custkey % 30 AS INT) AS day_no
        FROM customer""",
    "fine_raster": """
        SELECT CAST(FLOOR(p_partkey / 40) AS INT) AS row, CAST(p_partkey % 40 AS INT) AS col, CASE WHEN p_size = 50 THEN NULL ELSE p_retailprice END AS elevation,
               CASE WHEN p_size = 50 THEN NULL ELSE CAST(p_size % 7 AS INT) END AS class, CAST(p_size AS DOUBLE) AS pop
        FROM part""",
    "edges": """
        SELECT location_id, shape_order, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM (VALUES
          (1, 1, 2, 2, 18, 2), (1, 1, 18, 2, 18, 22), (1, 1, 18, 22, 2, 22), (1, 1, 2, 22, 2, 2),
          (2, 2, 20, 30, 38, 34), (2, 2, 38, 34, 24, 48), (2, 2, 24, 48, 20, 30),
          (3, 3, 22, 1, 39, 1), (3, 3, 39, 1, 39, 9), (3, 3, 39, 9, 30, 9), (3, 3, 30, 9, 30, 25), (3, 3, 30, 25, 22, 25), (3, 3, 22, 25, 22, 1),
          (4, 4, 12, 12, 26, 12), (4, 4, 26, 12, 26, 28), (4, 4, 26, 28, 12, 28), (4, 4, 12, 28, 12, 12)) AS t(location_id, shape_order, x1, y1, x2, y2)""",
    "bounds": "SELECT location_id, MIN(x1) AS xmin, MIN(y1) AS ymin, MAX(x1) AS xmax, MAX(y1) AS ymax FROM edges GROUP BY location_id",
    "population": "SELECT *, 'B-' || CAST(CAST(FLOOR(row / 10) AS INT) AS STRING) AS block_key FROM fine_raster",
    "blocks": """
        SELECT block_key, CAST(0 AS DOUBLE) AS bxmin, CAST(MIN(row) AS DOUBLE) AS bymin, CAST(40 AS DOUBLE) AS bxmax, CAST(MAX(row) + 1 AS DOUBLE) AS bymax
        FROM population GROUP BY block_key""",
    "knots": """
        SELECT CAST(t AS DOUBLE) AS temperature, CAST(s AS DOUBLE) AS suitability FROM (VALUES (15, 0.0), (20, 0.2), (25, 1.0), (29, 0.8), (34, 0.0)) AS k(t, s)""",
    "model_calendar": """
        SELECT cell, CAST(year(date) AS INT) AS year, 365 AS days_in_year,
               CAST(dayofyear(date) - CASE WHEN dayofyear(date) > 60 AND year(date) % 4 = 0 THEN 1 ELSE 0 END AS INT) AS dayofyear, value
        FROM daily_region WHERE NOT (month(date) = 2 AND day(date) = 29)""",
    "catalogue": """
        SELECT source AS source_id, lang AS experiment_id, 'v' || CAST(n_chars % 3 AS STRING) AS variable_id, 'm' || CAST(doc_id % 5 AS STRING) AS member_id,
               'store:' || CAST(doc_id AS STRING) AS zstore, doc_id AS position
        FROM documents""",
    "target_lat": "SELECT CAST(20 - 5 * i AS DOUBLE) AS coord FROM (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9)) AS t(i)",
    "target_lon": "SELECT CAST(-20 + 5 * i AS DOUBLE) AS coord FROM (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9)) AS t(i)",
}
NEEDS = {
    "grid_region": ("daily_region",), "dense_grid": ("daily_grid",), "bounds": ("edges",), "population": ("fine_raster",), "blocks": ("fine_raster", "population"),
    "model_calendar": ("daily_region",),
}


def ctes(names: str) -> str:
    """WITH clause of some views and those that they need, as SQL."""
    found: list[str] = []
    for name in names.split():
        found += [n for n in (*NEEDS.get(name, ()), name) if n not in found]
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in found)


class Views:
    """The views over the tables of a folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        sql = ctes(name) + f" SELECT * FROM {name}"
        for table in TABLES:
            if f" {table}" in sql:
                getattr(self, table).createOrReplaceTempView(table)
        return self.spark.sql(sql)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, spec: str, views: str, sql: str, build: Callable[[Views], DataFrame]) -> None:
    """Register a query and its SQL with the same columns: ``spec`` lists them, with :i for whole numbers and :d for fractions (to six digits)."""
    fields = [x.partition(":") for x in spec.split()]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        kinds = {"i": lambda c: c.cast("long"), "d": lambda c: F.round(c.cast("double"), 6) + F.lit(0.0), "": lambda c: c}
        return build(Views(spark, sf_dir)).select(*[kinds[kind](F.col(f"`{c}`")).alias(c) for c, _, kind in fields])

    forms = {"i": 'CAST("{0}" AS BIGINT) AS "{0}"', "d": 'ROUND(CAST("{0}" AS DOUBLE), 6) + 0.0 AS "{0}"', "": '"{0}"'}
    QUERIES[name] = run
    ORACLE[name] = f"{ctes(views)} SELECT {', '.join(forms[kind].format(c) for c, _, kind in fields)} FROM ({sql}) AS q"
