"""Tiles, segments and curve numbers."""

import math
import random

from pyspark.sql import functions as F

from cartospark import schemas as S
from cartospark.functions import tilemath as M


def test_tile_contains_its_point(spark):
    r = random.Random(5)
    places = [(r.uniform(-84, 84), r.uniform(-180, 180)) for _ in range(60)] + [(12.25, -45.0), (1e-9, -1e-9)]
    rows = spark.createDataFrame(places, "lat double, lon double").withColumns({"x": M.tile_x("lon"), "y": M.tile_y("lat")})
    inside = (F.col("lon") >= M.west("x")) & (F.col("lon") < M.west(F.col("x") + 1)) & (F.col("lat") <= M.north("y")) & (F.col("lat") > M.north(F.col("y") + 1))
    assert all(r[0] for r in rows.select(inside).collect())


def test_poles_and_edges_clamp(spark):
    rows = spark.createDataFrame([(90.0,), (-90.0,), (89.9,)], "lat double").select(M.tile_y("lat")).collect()
    assert [r[0] for r in rows] == [0, 8191, 0]
    assert spark.range(1).select(M.tile_x(F.lit(180.0)), M.tile_x(F.lit(-180.0))).first()[:] == (8191, 0)


def test_quantised_half_away_from_zero(spark):
    rows = spark.createDataFrame([(12.34567895,), (-12.34567895,), (180.0,), (-90.0,)], "d double")
    got = [r[0] for r in rows.select(M.quantised("d")).collect()]
    assert got == [123456790, -123456790, 1800000000, -900000000]


def walk(x0, y0, x1, y1):
    """Tiles by fine sampling, for segments that pass no corner."""
    n = 20000
    return {(math.floor(x0 + (x1 - x0) * k / n), math.floor(y0 + (y1 - y0) * k / n)) for k in range(n + 1)}


def tiles(spark, segments):
    rows = spark.createDataFrame([(k, *map(float, s)) for k, s in enumerate(segments)], "id int, x0 double, y0 double, x1 double, y1 double")
    got = rows.select("id", M.segment_tiles(*(F.col(c) for c in ("x0", "y0", "x1", "y1"))).alias("t")).collect()
    return [[(t["x"], t["y"]) for t in r["t"]] for r in sorted(got)]


def test_segments(spark):
    r = random.Random(1)
    some = [tuple(100 + 6 * r.random() for _ in range(4)) for _ in range(40)]
    for got, s in zip(tiles(spark, some), some, strict=True):
        assert walk(*s) <= set(got) and len(set(got) - walk(*s)) <= 1
    straight, corner, back, point, far = tiles(spark, [(41.25, 77.75, 45.25, 77.75), (10.5, 10.5, 12.5, 12.5), (12.5, 10.5, 10.5, 10.5), (3.2, 3.2, 3.2, 3.2), (8191.9, 5.5, 0.1, 5.5)])
    assert straight == [(x, 77) for x in range(41, 46)] and back == [(12, 10), (11, 10), (10, 10)] and point == [(3, 3)]
    assert set(corner) == {(10, 10), (11, 10), (10, 11), (11, 11), (12, 11), (11, 12), (12, 12)}
    assert far == [(8191, 5), (0, 5)]


def test_hilbert_forward_and_back(spark):
    r = random.Random(2)
    places = [(0, 0), (0, 8191), (8191, 8191), (8191, 0)] + [(r.randrange(8192), r.randrange(8192)) for _ in range(500)]
    rows = spark.createDataFrame(places, "x int, y int").withColumn("id", M.hilbert_id("x", "y")).withColumn("t", M.hilbert_xy("id")).collect()
    assert all((x["x"], x["y"]) == (x["t"]["x"], x["t"]["y"]) and S.FIRST_ID <= x["id"] < S.PAST_ID for x in rows)
    square = spark.createDataFrame([(x, y) for x in range(8) for y in range(8)], "x int, y int").orderBy(M.hilbert_id("x", "y")).collect()
    assert all(abs(a["x"] - b["x"]) + abs(a["y"] - b["y"]) == 1 for a, b in zip(square, square[1:], strict=False))
    assert S.RELATION_BASE == 366503875925 and S.FIRST_ID == 22369621 and S.PAST_ID == 89478485


def test_cells_and_stamps(spark):
    rows = spark.createDataFrame([(127, 127), (128, 0), (0, 128), (8191, 8191)], "x int, y int")
    assert [r[0] for r in rows.select(M.cell("x", "y")).collect()] == [0, 1, 64, 4095]
    at = spark.range(1).select(M.build_stamp(F.lit(951782400 + 3661)), M.build_stamp(F.lit(0), False)).first()
    assert at[:] == ("20000229-010101", "19700101")
