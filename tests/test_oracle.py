"""Every query of the library itself against its SQL over the smallest tables."""

import math
import os

import duckdb
import pytest

from meridian.plans import climate_queries, cube_queries, location_queries, product_queries, raster_queries  # noqa: F401
from meridian.plans.fixtures import ORACLE, QUERIES, TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    rel = oracle.sql(ORACLE[name])
    assert df.columns == rel.columns
    order = lambda rows: sorted((tuple(map(_plain, r)) for r in rows), key=str)
    assert order(map(tuple, df.collect())) == order(rel.fetchall())
