"""Coverage, set cover, merging and the engine."""

import itertools
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from cartospark import fixtures, registry
from cartospark.operators import coverage, manifest, merge, setcover
from cartospark.plans.bake import Bake
from cartospark.plans.engine import DeadlineError, Engine

DATA = "/root/testdata/sf0.001"


def rings(spark, shapes):
    rows = [(e, k, p, float(x), float(y)) for e, own in shapes.items() for k, ring in enumerate(own) for p, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, "ext int, ring int, pos int, lon double, lat double")


def box(w, s, e, n):
    return [(w, s), (e, s), (e, n), (w, n)]


def parity(x, y, own):
    """Is a point in an odd number of rings?  By winding along a ray, ring by ring."""
    odd = 0
    for ring in own:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            odd += (y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1)
    return odd % 2 == 1


def test_points_in_shapes_with_holes_islands_and_long_edges(spark):
    r = random.Random(3)
    star = [(40 + (9 if k % 2 else 4) * math.cos(k * math.pi / 9), 5 + (9 if k % 2 else 4) * math.sin(k * math.pi / 9)) for k in range(18)]
    shapes = {
        1: [box(-20, -15, -5, 2), box(-16, -10, -9, -4), box(-14, -8, -12, -6)],
        2: [star, box(39, 4, 41, 6)],
        3: [[(-170.0, -80.0), (170.0, -79.0), (0.0, 83.0)]],
    }
    points = [(k, r.uniform(-60, 60), r.uniform(-30, 30)) for k in range(600)] + [(600, -13.0, -7.0), (601, -10.0, -5.0), (602, 40.0, 5.0)]
    got = coverage.point_in_polygon(spark.createDataFrame(points, "id long, lon double, lat double"), rings(spark, shapes))
    expect = {(e, k) for e, own in shapes.items() for k, x, y in points if parity(x, y, own)}
    assert {tuple(x) for x in got.collect()} == expect and len({e for e, _ in expect}) == 3


def test_small_ring_gets_many_samples(spark):
    ring = [(11.0, 60.0), (11.3, 60.05), (11.2, 60.2), (11.05, 60.15)]
    got = coverage.ring_samples(rings(spark, {1: [ring]}), ["ext"]).collect()
    assert 500 < len(got) == len({(x["lon"], x["lat"]) for x in got}) and all(parity(x["lon"], x["lat"], [ring]) for x in got)


def test_land_and_islands(spark):
    land = rings(spark, {1: [box(0, 0, 10, 10), box(4, 4, 6, 6)], 2: [[(50.0, 50.0), (50.0005, 50.0), (50.0, 50.0005)]]})
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 50.0001, 50.0001), (4, 30.0, 30.0), (5, 9.0, 9.0)], "id long, lon double, lat double")
    lakes = rings(spark, {1: [box(8.5, 8.5, 9.5, 9.5)]})
    assert sorted(r["id"] for r in coverage.on_land(points, land, lakes, ["ext"]).collect()) == [1, 3]
    isles = rings(spark, {1: [box(5.0, 5.0, 5.1, 5.1)], 2: [[(0.0, 0.0), (0.05, 0.0), (0.05, 0.05)]], 3: [[(7.0, 7.0), (7.1, 7.0), (7.1, 7.0001)]], 4: [box(0, 10, 1, 11)]})
    got = {r["ext"]: r["n"] for r in coverage.island_samples(isles, ["ext"]).groupBy("ext").agg(F.count("*").alias("n")).collect()}
    assert got[1] == 25 and 2 not in got and 4 not in got and got[3] >= 1


def test_roll_up_stops_at_unknown_parents(spark):
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "gone")], "id string, parent string")
    assert {r["id"]: r["root"] for r in coverage.roll_up(nodes).collect()} == {"a": "a", "b": "a", "c": "a", "d": "gone"}


def solved(cost, forced, classes):
    cover = setcover.Cover(cost, forced, classes)
    cover.solve()
    return cover


@pytest.mark.parametrize("seed", range(25))
def test_cover_is_complete_and_irredundant(seed):
    r = random.Random(seed)
    n = r.randint(2, 9)
    cost = {k: r.randint(1, 100) for k in range(n)}
    forced = {0} if r.random() < 0.3 else set()
    classes = sorted({tuple(sorted(r.sample(range(n), r.randint(1, min(3, n))))): r.randint(1, 50) for _ in range(12)}.items())
    cover = solved(cost, forced, classes)
    whole = lambda chosen: all(set(m) & set(chosen) for m, _ in classes)
    assert whole(cover.chosen) and forced <= set(cover.chosen) and len(set(cover.chosen)) == len(cover.chosen)
    assert all(not whole([c for c in cover.chosen if c != gone]) for gone in cover.chosen if gone not in forced)
    best = min(sum(cost[c] for c in s) for k in range(n + 1) for s in itertools.combinations(range(n), k) if whole(s) and forced <= set(s))
    assert best <= sum(cost[c] for c in cover.chosen) <= 3 * best


def test_swap_trades_a_large_region_for_a_small_one():
    # 0 (2100) is picked first, then only its class (0, 2) needs it; 2 costs 3
    classes = [((0, 1), 5000), ((0, 2), 1), ((1,), 50)]
    assert sorted(solved({0: 2100, 1: 2200, 2: 3}, set(), classes).chosen) == [1, 2]


def test_equal_costs_take_the_first():
    assert solved({3: 10, 1: 10}, set(), [((1, 3), 5)]).chosen == [1]


def test_merge_keeps_the_first_region(spark):
    rows = [(2, 1, 1, "way", 7), (1, 1, 1, "way", 7), (3, 1, 1, "way", 7), (1, 1, 1, "node", 7)]
    elements = spark.createDataFrame(rows, "ext int, x int, y int, kind string, id long")
    regions = spark.createDataFrame([(1, "a", 5), (2, "a", 4), (3, "b", 1)], "ext int, continent string, seq int")
    got = {(r["continent"], r["kind"]): r["ext"] for r in merge.merged(elements, regions).collect()}
    assert got == {("a", "way"): 2, ("a", "node"): 1, ("b", "way"): 3}
    assert got == {(r["continent"], r["kind"]): r["ext"] for r in merge.merged(elements.repartition(5), regions).collect()}


def test_gate_refuses_losses(spark):
    index = lambda rows: spark.createDataFrame(rows, "name string, file string, tiles long")
    old = index([("a", "a1", 100), ("b", "b1", 100), ("overlay-x", "o", 5)])
    assert manifest.gate(old, index([("a", "a2", 100), ("b", "b2", 85)])).first()["passes"]
    assert not manifest.gate(old, index([("a", "a2", 90), ("b", "b2", 80)])).first()["passes"]
    assert manifest.gate(old, index([("a", "a2", 900)])).first()["missing"] == "b"
    assert manifest.gate(index([]), index([])).first()["passes"]


def test_patch_names_must_be_planned(spark):
    regions = lambda names: spark.createDataFrame([(n,) for n in names], "region string")
    with pytest.raises(ValueError, match="nowhere"):
        manifest.patch(regions(["a"]), regions(["nowhere"]), regions([]))


def test_engine_runs_resumes_and_looks_up(spark, tmp_path):
    v = lambda n: fixtures.view(spark, DATA, n)
    plan = v("fx_extract").filter("ext IN (0, 1)").select(F.col("ext").alias("shape_id"), "region_id", "continent", "bytes", F.lit(None).cast("array<array<double>>").alias("clip"))

    def inputs(regions):
        at = lambda n: v(n).join(regions.select("ext"), "ext", "left_semi")
        return Bake(at("fx_region_node"), at("fx_region_way"), at("fx_region_ref"), at("fx_relation").select("ext", "id", "tags"), v("fx_member"), regions)

    engine = Engine(spark, str(tmp_path / "work"), str(tmp_path / "out"), 0)
    with pytest.raises(DeadlineError):
        engine.run(plan, inputs, finish_by=0.0)
    assert engine.done().count() == 1 and engine.status().count() == 2
    files = engine.run(plan, inputs) + engine.finalize(plan)
    assert len(files) == 2 and engine.done().count() == 2
    index = json.loads((tmp_path / "out" / "archives.json").read_text())
    assert [e["name"] for e in index["archives"]] == sorted(e["name"] for e in index["archives"]) and index["format"] == "AOT2+zstd"
    assert [e["cells"] for e in engine.cells()] == [e["cells"] for e in index["archives"]]
    assert engine.stored("chunk").count() == 0


def test_flagship_counts_what_the_bake_holds(spark):
    got = registry.QUERIES["tile_counts"](spark, DATA).agg(F.sum("nodes"), F.sum("ways")).first()
    assert got[0] > 0 and got[1] > 0
