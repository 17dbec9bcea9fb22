"""From extract files to archives, and from indexes and outlines to a plan."""

import json

import pytest
from pyspark.sql import functions as F

from cartospark import schemas as S
from cartospark.operators import merge
from cartospark.plans.engine import Engine
from cartospark.plans.files import Files
from cartospark.plans.inputs import bake_files, measured, read_plan
from cartospark.sources import osm_pbf, outlines
from cartospark.streaming.incremental import bake_arrivals

PLAN = "shape_id int, region_id string, continent string, bytes long, clip array<array<double>>"


def extract(path, shift=0.0):
    """A house, a road over several tiles with a relation, a bench; ids are the same in every extract."""
    at = lambda dx, dy: (52.0 + dy, 13.0 + shift + dx)
    nodes = [(1, *at(0, 0), [("amenity", "bench")]), *((k, *at(0.001 * (k % 2), 0.001 * (k // 4)), []) for k in range(2, 6)), (6, *at(0.3, 0.1), []), (7, *at(0.31, 0.1), [("smoothness", "x")])]
    ways = [(10, [2, 3, 5, 4, 2], [("building", "yes")]), (11, [1, 6, 7, 99], [("highway", "path")]), (12, [6, 7], [])]
    relations = [(20, [("node", 1, ""), ("way", 11, "outer"), ("way", 12, "inner")], [("type", "multipolygon")]), (21, [("way", 12, "")], [("type", "route")])]
    osm_pbf.write(str(path), nodes, ways, relations)


def regions(spark, rows):
    return spark.createDataFrame(rows, PLAN)


def test_extracts_become_archives(spark, tmp_path):
    for name, shift in (("one", 0.0), ("two", 0.01), ("far", 40.0)):
        extract(tmp_path / f"{name}.osm.pbf", shift)
    plan = regions(spark, [(0, "one", "here", 300, None), (1, "two", "here", 200, None), (2, "far", "there", 100, None)])
    engine = Engine(spark, f"file://{tmp_path}/work", f"file://{tmp_path}/out", 0)
    inputs = bake_files(spark, lambda r: f"{tmp_path}/{r}.osm.pbf", f"{tmp_path}/decoded")
    files = engine.run(plan, inputs)
    assert len(files) == 2 and engine.run(plan, inputs) == [] and engine.stored("chunk").count() == 0
    done = {r["region"]: r for r in engine.done().collect()}
    assert done["one"]["tiles"] == done["far"]["tiles"] > 5 and done["one"]["payload_bytes"] > 100
    index = json.loads((tmp_path / "out" / "archives.json").read_text())
    assert {e["name"]: e["tiles"] for e in index["archives"]}["there"] == done["far"]["tiles"] - 1  # a record is no tile
    assert [e["cells"] for e in engine.cells()] == [e["cells"] for e in index["archives"]]
    engine.reset("there")
    assert {r["region"] for r in engine.done().collect()} == {"one", "two"}
    engine.reset()
    assert engine.done().count() == 0


def test_the_first_region_of_a_tile_wins_and_can_be_looked_up(spark, tmp_path):
    extract(tmp_path / "one.osm.pbf")
    extract(tmp_path / "two.osm.pbf", 0.0001)
    plan = regions(spark, [(0, "one", "here", 200, None), (1, "two", "here", 300, None)])
    engine = Engine(spark, f"{tmp_path}/work", f"{tmp_path}/out", 0)
    inputs = bake_files(spark, lambda r: f"{tmp_path}/{r}.osm.pbf", f"{tmp_path}/decoded")
    for r in merge.run_order(plan.withColumn("ext", F.col("shape_id"))).collect():
        engine.bake(inputs(merge.run_order(plan.withColumn("ext", F.col("shape_id"))).filter(F.col("region_id") == r["region_id"])), r)
    tiles = engine.tiles(plan, "here").collect()
    bench = [n for t in tiles for n in t["nodes"] if n["id"] == 1]
    assert len(bench) == 1 and bench[0]["lon_q"] == 130001000  # of region two, which is larger
    place = next((t["x"], t["y"]) for t in tiles if t["nodes"])
    seen = {r["region"]: (r["nodes"], r["ways"]) for r in engine.inspect(*place).collect()}
    assert seen.keys() == {"one", "two"} and seen["one"] == (1, 2)
    whole = engine.whole_relations(plan, "here").collect()
    assert len(whole) == 1 and [w["id"] for w in whole[0]["ways"]] == [11, 12]


def test_clips_and_patches(spark, tmp_path):
    extract(tmp_path / "one.osm.pbf")
    clip = [[12.9, 51.9, 13.1, 52.05]]
    plan = regions(spark, [(0, "one", "here", 300, clip), (1, "none", "here", 200, [])])
    inputs = bake_files(spark, lambda r: f"{tmp_path}/one.osm.pbf", f"{tmp_path}/decoded")
    engine = Engine(spark, f"{tmp_path}/work", f"{tmp_path}/out", 0)
    # names arrive one by one; what has been baked is not baked again
    for names in (["one"], ["one", "none"]):
        spark.createDataFrame([(n,) for n in names], "region_id string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/names")
        bake_arrivals(engine, plan, inputs, f"{tmp_path}/names", f"{tmp_path}/checkpoint").awaitTermination()
        assert {r["region"] for r in engine.done().collect()} == set(names)
    assert engine.stored("chunk").count() == 0 and engine.files.exists(f"{tmp_path}/out/archives.json")
    done = {r["region"]: r["tiles"] for r in engine.done().collect()}
    whole = regions(spark, [(0, "one", "here", 300, None)])
    other = Engine(spark, f"{tmp_path}/work2", f"{tmp_path}/out2", 0)
    other.run(whole, inputs)
    assert done["none"] == 0 and 0 < done["one"] < other.done().first()["tiles"]
    # a patch is an archive of its own beside the continents
    file = other.patch(whole, inputs, ["one"])
    index = json.loads((tmp_path / "out2" / "archives.json").read_text())
    assert [e["name"] for e in index["archives"]] == ["here", "overlay"] and index["archives"][1]["file"] == file
    with pytest.raises(ValueError, match="nowhere"):
        other.patch(whole, inputs, ["nowhere"])


def test_extracts_in_place_are_measured(spark, tmp_path):
    osm_pbf.write(f"{tmp_path}/a.pbf", [(1, 0.0, 0.0, [])], box=(-2.0, 3.0, 4.5, 6.0))
    osm_pbf.write(f"{tmp_path}/b.pbf", [(1, 0.0, 0.0, [])])
    sizes, boxes = measured(spark, ["a", "b", "c"], lambda i: f"{tmp_path}/{i}.pbf")
    assert sizes == {i: (tmp_path / f"{i}.pbf").stat().st_size for i in "ab"} and boxes == {"a": [-2.0, 3.0, 4.5, 6.0]}


def ring(w, s, e, n):
    return [[w, s], [e, s], [e, n], [w, n], [w, s]]


def test_a_plan_from_files(spark, tmp_path):
    feature = lambda i, up, rings, url=True: {
        "properties": {"id": i, "parent": up, "name": i.upper(), "urls": {"pbf": f"u/{i}"} if url else {}},
        "geometry": None if rings is None else {"type": "MultiPolygon", "coordinates": [rings]},
    }
    index = {"features": [feature("root", None, None, False), feature("left", "root", [ring(0, 0, 6, 6)]), feature("right", "left", [ring(5, 0, 9, 6)]), feature("boxed", "root", None), feature("lost", "root", None), feature("huge", "root", [ring(-10, -10, 20, 20)])]}
    config = {"supplements": [{"id": "isle", "name": "Isle", "path": "sea/east/isle", "continent": "root"}], "anchors": [{"name": "x", "at": [12.01, 3.01]}]}
    poly = lambda w, s, e, n: "p\n1\n" + "".join(f" {x} {y}\n" for x, y in ring(w, s, e, n)) + "END\nEND\n"
    texts = {"index": index, "sizes": {"left": 400, "right": 300, "boxed": 50, "huge": S.EXTRACT_CAP + 1}, "boxes": {"boxed": [-3.0, -3.0, -2.0, -2.0]}, "coverage": config, "more": {"isle": 7}}
    for name, value in texts.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
    for path, box in (("sea", (8, -5, 30, 30)), ("sea/east", (11, 1, 20, 20)), ("sea/east/isle", (10, 2, 14, 4))):
        (tmp_path / f"{path.replace('/', '_')}.poly").write_text(poly(*box))
    land = [[(0.0, 0.0), (9.0, 0.0), (9.0, 6.0), (0.0, 6.0)], [(11.9, 2.9), (12.1, 2.9), (12.1, 3.1), (11.9, 3.1)], [(-3.0, -3.0), (-2.0, -3.0), (-2.0, -2.0)]]
    (tmp_path / "land.shp").write_bytes(outlines.shapefile_bytes([[r] for r in land]))
    (tmp_path / "lakes.shp").write_bytes(outlines.shapefile_bytes([[[(2.0, 2.0), (3.0, 2.0), (3.0, 3.0), (2.0, 3.0)]]]))
    at = lambda name: f"{tmp_path}/{name}"
    given = (at("tables"), at("index.json"), at("sizes.json"), at("boxes.json"), at("coverage.json"), at("more.json"), lambda p: at(f"{p.replace('/', '_')}.poly"), lambda p: F.concat(F.lit("s/"), p), at("land.shp"), at("lakes.shp"))
    found = read_plan(spark, *given)
    shapes = {r["region_id"]: r for r in found.shapes.collect()}
    assert sorted(shapes, key=lambda k: shapes[k]["shape_id"]) == ["left", "right", "boxed", "huge", "above:sea/east", "above:sea", "isle"]
    assert [shapes[k]["kind"] for k in ("left", "boxed", "above:sea", "isle")] == ["Polygon", "HeaderBox", "Ancestor", "Supplement"]
    assert shapes["right"]["continent"] == "root" and shapes["isle"]["url"] == "s/sea/east/isle" and shapes["isle"]["bytes"] == 7
    assert shapes["isle"]["parent"] == shapes["above:sea/east"]["shape_id"] and shapes["above:sea/east"]["parent"] == shapes["above:sea"]["shape_id"]
    points = [tuple(r) for r in found.points.select("lon", "lat", "id").collect()]
    assert len({p[2] for p in points}) == len(points) and any(p[:2] == (12.01, 3.01) for p in points)
    assert not any(2.05 < x < 2.95 and 2.05 < y < 2.95 for x, y, _ in points) and sum(1 for x, y, _ in points if -0.1 < x < 9.1 and -0.1 < y < 6.1) > 600
    engine = Engine(spark, at("work"), at("out"), 0)
    plan = engine.plan(found.points, found.rings, found.shapes)
    assert [r["region_id"] for r in plan.collect()] == ["left", "right", "boxed", "isle"]
    clips = {r["region_id"]: r["clip"] for r in engine.load_plan().collect()}
    assert clips["left"] is None and [[round(x, 6) for x in b] for b in clips["isle"]] == [[10.7, 1.7, 12.3, 3.3], [10.7, 2.7, 12.3, 4.3], [11.7, 1.7, 13.3, 3.3], [11.7, 2.7, 13.3, 4.3]]
    saved = Files(spark).read_json(at("work/plan.json"))
    boxes = [(0, 0, 6, 6), (5, 0, 9, 6), (-3, -3, -2, -2), (11, 2, 14, 4)]  # the upper sides of a box are not in it
    bare = [p for p in points if not any(w <= p[0] < e and s <= p[1] < n for w, s, e, n in boxes)]
    assert saved["total_bytes"] == 757 and saved["uncovered_points"] == len(bare) < 80 and saved["land_points"] == len(points)
    # a kept region stays though nothing needs it, and what is added is clipped
    kept = engine.plan(found.points, found.rings, found.shapes, keep=["left", "boxed", "isle"], path=at("kept.json"))
    assert {r["region_id"]: r["clip"] is None for r in kept.collect()} == {"left": True, "boxed": True, "isle": False, "right": False}
    (tmp_path / "more.json").write_text("{}")
    with pytest.raises(ValueError, match="isle: its size"):
        read_plan(spark, *given)
