"""Queries against their DuckDB equivalents on the smallest tables."""

import math
import os

import duckdb
import pytest

from cartospark.oracles import ORACLES
from cartospark.registry import QUERIES

DATA = "/root/testdata/sf0.001"
#: One of each family; all are compared at a larger scale by the driver.
NAMES = ["tag_filter", "kept_ways", "way_geometry", "way_tiles", "segment_tiles", "hilbert_order", "point_in_polygon", "land_mask", "island_samples", "ancestor_intersection", "set_cover", "plan_regions", "archive_cells", "run_order", "publish_gate", "src_poly_rings"]


@pytest.fixture(autouse=True)
def compiled(spark):
    """These run the stage-wide code that production runs."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in os.listdir(DATA):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{t}'")
    mine, theirs = QUERIES[name](spark, DATA), con.sql(ORACLES[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    place = [theirs.columns.index(c) for c in mine.columns]
    plain = lambda row: tuple(round(x, 9) if isinstance(x, float) and math.isfinite(x) else x for x in row)
    assert sorted(map(repr, (plain(r) for r in mine.collect()))) == sorted(map(repr, (plain([r[k] for k in place]) for r in theirs.fetchall())))
