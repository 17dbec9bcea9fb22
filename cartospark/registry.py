"""Every query by name: (spark, sf_dir) -> DataFrame, over the fixture views of all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import fixtures
from . import schemas as S
from .functions import codec, packed
from .functions import tags as T
from .functions import tilemath as M
from .operators import coverage as C
from .operators import geometry as G
from .operators import manifest, merge, setcover
from .plans.bake import Bake
from .plans.stored import Stored
from .sources import outlines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name, **given: fixtures.view(spark, sf_dir, name, given))
    QUERIES[f.__name__].__doc__ = f.__doc__
    return f


def _bake(v, clipped: bool = False) -> Bake:
    return Bake(
        v("fx_region_node"), v("fx_region_way"), v("fx_region_ref"), v("fx_relation").select("ext", "id", "tags"), v("fx_member"), merge.run_order(v("fx_extract")), v("fx_clip") if clipped else None
    )


@query
def tag_filter(v):
    """Kept tags of all nodes, ways and relations, in order."""
    every = [v(f"fx_{kind}").select(F.lit(kind).alias("kind"), "id", "tags") for kind in ("node", "way", "relation")]
    rows = every[0].union(every[1]).union(every[2])
    return rows.select("kind", "id", F.posexplode(T.filtered(F.col("tags"))).alias("pos", "t")).select("kind", "id", "pos", F.col("t.k").alias("k"), F.col("t.v").alias("v"))


@query
def ocean_exclusion(v):
    every = [v(f"fx_{kind}").select(F.lit(kind).alias("kind"), "id", "tags") for kind in ("node", "way", "relation")]
    return every[0].union(every[1]).union(every[2]).select("kind", "id", T.excluded(T.filtered(F.col("tags"))).alias("excluded"))


@query
def poi_nodes(v):
    return _bake(v).pois.select("ext", "id", "lat_q", "lon_q", "x", "y")


@query
def kept_relations(v):
    return _bake(v).kept_relations.select("id", "ext", F.posexplode("members").alias("pos", "m")).select("id", "ext", "pos", F.col("m.way_id").alias("way_id"), F.col("m.role").alias("role"))


@query
def kept_ways(v):
    return _bake(v).kept_ways.select("ext", "id", "is_member", F.size("tags").alias("n_tags"))


@query
def quantize_coords(v):
    return v("fx_node").select("id", M.quantised("lat").alias("lat_q"), M.quantised("lon").alias("lon_q"), M.degrees(M.quantised("lat")).alias("lat_back"), M.degrees(M.quantised("lon")).alias("lon_back"))


@query
def tile_assign(v):
    """Tiles of given and of quantised degrees."""
    q = lambda c: M.degrees(M.quantised(c))
    return v("fx_node").select("id", M.tile_x("lon").alias("x"), M.tile_y("lat").alias("y"), M.tile_x(q("lon")).alias("qx"), M.tile_y(q("lat")).alias("qy"))


@query
def tile_extent(v):
    """Degrees that each tile with a node covers."""
    t = v("fx_node").select(M.tile_x("lon").alias("x"), M.tile_y("lat").alias("y")).distinct()
    at = lambda c: F.round(c, 9)
    return t.select("x", "y", at(M.west("x")).alias("w"), at(M.north(F.col("y") + 1)).alias("s"), at(M.west(F.col("x") + 1)).alias("e"), at(M.north("y")).alias("n"))


@query
def tiles_for_bbox(v):
    """Tiles of every clip box."""
    xs = F.explode(F.sequence(M.tile_x("w"), M.tile_x("e")))
    return v("fx_clip").withColumn("x", xs).withColumn("y", F.explode(F.sequence(M.tile_y("n"), M.tile_y("s")))).select("ext", "x", "y")


@query
def hilbert_order(v):
    """Archive order of the tiles of all nodes of all regions."""
    t = v("fx_node").select(F.lit("one").alias("continent"), M.tile_x("lon").alias("x"), M.tile_y("lat").alias("y")).distinct()
    return merge.in_hilbert_order(t).select("x", "y", "tile_id")


@query
def hilbert_inverse(v):
    """Tile numbers spread over zoom 13, from order keys."""
    ids = v("orders").select((F.lit(S.FIRST_ID) + F.col("o_orderkey") * 7919 % F.lit(4**13)).alias("tile_id")).distinct()
    return ids.withColumn("t", M.hilbert_xy("tile_id")).select("tile_id", "t.x", "t.y")


@query
def segment_tiles(v):
    """Tiles that segments between far points touch: consecutive points of the sample set, scaled to 3 degrees."""
    p = v("fx_point").select("id", (8.0 + F.col("lon") / 40).alias("lon"), (47.0 + F.col("lat") / 40).alias("lat"))
    q = p.select((F.col("id") - 1).alias("id"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    near = p.join(q, "id").withColumns({"lon2": F.col("lon") + (F.col("lon2") - F.col("lon")) / 10, "lat2": F.col("lat") + (F.col("lat2") - F.col("lat")) / 10})
    walk = M.segment_tiles(M.fraction_x("lon"), M.fraction_y("lat"), M.fraction_x("lon2"), M.fraction_y("lat2"))
    return near.select("id", F.explode(F.array_distinct(walk)).alias("t")).select("id", "t.x", "t.y")


@query
def way_geometry(v):
    """Vertices of all ways of all regions."""
    g = G.way_geometry(v("fx_region_ref"), v("fx_region_node"))
    return g.select("ext", "way_id", "closed", F.posexplode("points").alias("pos", "p")).select("ext", "way_id", "closed", "pos", F.col("p.lat_q").alias("lat_q"), F.col("p.lon_q").alias("lon_q"))


@query
def way_tiles(v):
    return _bake(v).way_tiles


@query
def relation_tiles(v):
    return _bake(v).relation_tiles


@query
def whole_relations(v):
    return _bake(v).whole_relations.select("ext", "relation_id", F.explode("ways").alias("way_id"))


@query
def clip_tiles(v):
    return _bake(v, clipped=True).elements.groupBy("ext", "kind").agg(F.count("*").alias("n"), F.sum("x").alias("sum_x"))


@query
def bake_stats(v):
    return _bake(v).stats()


@query
def tile_counts(v):
    """Elements per merged tile of each continent."""
    return merge.tile_counts(_bake(v).merged)


@query
def merge_dedup(v):
    """The region that each element of a tile is taken from."""
    return _bake(v).merged.select("continent", "x", "y", "kind", "id", "ext")


@query
def archive_index(v):
    found = merge.archive_index(_bake(v).merged.select("continent", "x", "y").distinct())
    return found.select("name", "tiles", F.array_join(F.transform("cells", lambda c: c.cast("string")), " ").alias("cells"), *(F.round(c, 9).alias(c) for c in ("min_lat", "min_lon", "max_lat", "max_lon")))


@query
def coverage_cells(v):
    t = v("fx_point").select(M.tile_x("lon").alias("x"), M.tile_y("lat").alias("y")).distinct()
    return t.groupBy(M.cell("x", "y").alias("cell")).agg(F.count("*").alias("tiles"))


@query
def encode_roundtrip(v):
    """Merged tiles through payload and frame and back."""
    keys = ["continent", "x", "y"]
    store = Stored(v("region").sparkSession)
    # views that others take several times, each time with a shuffle of its own
    given = {name: store.kept(v(name), name) for name in ("fx_line", "fx_presence")}
    elements = _bake(lambda name: v(name, **given)).packed(store)
    for name in given:
        store.drop(name)
    back = codec.elements_of(packed.payloads_of(elements, S.SCRATCH_LEVEL))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return back.groupBy(*keys).agg(
        *(F.count(kind).cast("int").alias(f"{kind}s") for kind in ("node", "way", "relation")),
        *(total(f"{kind}.id").alias(f"{kind}_ids") for kind in ("node", "way", "relation")),
        total(F.array_size("way.points").cast("long")).alias("points"),
        total(F.array_size("relation.members").cast("long")).alias("members"),
    )


@query
def string_dictionary(v):
    """How often each distinct string is used in the merged tiles' payloads."""
    used = _bake(v).tile_strings().groupBy("continent", "x", "y", "s").agg(F.count("*").alias("n"))
    return used.groupBy("continent", "x", "y").agg(F.sum("n").alias("used"), F.count("s").alias("strings"))


@query
def build_stamp(v):
    seconds = F.col("event_id") * 86_413 + 951_782_400
    return v("events").select("event_id", M.build_stamp(seconds).alias("stamp"), M.build_stamp(seconds, False).alias("day"))


@query
def url_local_name(v):
    return v("pages").select("page_id", outlines.local_name("url").alias("local_name"))


@query
def continent_rollup(v):
    """Roots of a forest in which the parent of every part is a fifth of its key."""
    nodes = v("part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") >= 5, F.floor(F.col("p_partkey") / 5)).alias("parent"))
    return C.roll_up(nodes)


@query
def point_in_polygon(v):
    return C.point_in_polygon(v("fx_point"), v("fx_ring")).select("ext", "id")


@query
def coverage_multiplicity(v):
    found = C.point_in_polygon(v("fx_point"), v("fx_ring").filter("ext < 100"))
    return found.groupBy("id").agg(F.count("*").alias("shapes")).groupBy("shapes").agg(F.count("*").alias("points"))


def _inside(v) -> DataFrame:
    raw = C.point_in_polygon(v("fx_point"), v("fx_ring")).withColumnRenamed("ext", "shape_id")
    return C.effective(raw, v("fx_shape"))


@query
def ancestor_intersection(v):
    return _inside(v)


@query
def orphan_points(v):
    return C.orphans(v("fx_point"), _inside(v), v("fx_shape")).select("id")


@query
def cover_candidates(v):
    found = C.cover_candidates(v("fx_point"), _inside(v), v("fx_shape"))
    return found.groupBy("shape_id", "forced").agg(F.count("id").alias("points"))


@query
def sample_grid(v):
    return C.sample_grid(v("region").sparkSession)


@query
def ring_samples(v):
    """Samples of all rings, counted and averaged."""
    s = C.ring_samples(v("fx_ring"), ["ext"])
    return s.groupBy("ext", "ring").agg(F.count("*").alias("n"), F.round(F.min("lon"), 9).alias("lon0"), F.round(F.max("lat"), 9).alias("lat1"))


def _land(v, kind: str) -> DataFrame:
    box = v("fx_land").filter(F.col("kind") == kind)
    corner = F.array(*(F.struct(F.col(a).alias("lon"), F.col(b).alias("lat")) for a, b in (("w", "s"), ("e", "s"), ("e", "n"), ("w", "n"))))
    return box.select("rec", F.lit(0).alias("ring"), F.posexplode(corner).alias("pos", "p")).select("rec", "ring", "pos", F.col("p.lon").cast("double").alias("lon"), F.col("p.lat").cast("double").alias("lat"))


@query
def land_mask(v):
    return C.on_land(v("fx_point"), _land(v, "land"), _land(v, "lake"), ["rec"]).select("id")


def _islands(v) -> DataFrame:
    """A tiny diamond or triangle around every point."""
    size = (F.col("id") % 7 + 1) / 50.0
    lon, lat = F.col("lon"), F.col("lat")
    at = lambda dx, dy: F.struct((lon + size * dx).alias("lon"), (lat + size * dy).alias("lat"))
    ring = F.when(F.col("id") % 2 == 0, F.array(at(-1.0, 0.0), at(0.0, -1.0), at(1.0, 0.0), at(0.0, 1.0))).otherwise(F.array(at(0.0, 0.0), at(1.0, 0.0), at(1.0, 0.001)))
    return v("fx_point").select(F.col("id").alias("rec"), F.lit(0).alias("ring"), F.posexplode(ring).alias("pos", "p")).select("rec", "ring", "pos", "p.lon", "p.lat")


@query
def island_samples(v):
    return C.island_samples(_islands(v), ["rec"]).groupBy("rec").agg(F.count("*").alias("n"), F.round(F.avg("lon"), 6).alias("lon"), F.round(F.avg("lat"), 6).alias("lat"))


@query
def clip_boxes(v):
    """Boxes around the points that one shape alone covers."""
    inside = C.point_in_polygon(v("fx_point"), v("fx_ring").filter("ext < 100"))
    alone = inside.groupBy("id").agg(F.count("*").alias("n"), F.min("ext").alias("ext")).filter("n = 1")
    boxes = C.clip_boxes(alone.join(v("fx_point"), "id").select("ext", "lon", "lat"), ["ext"])
    return boxes.select("ext", *(F.round(c, 6).alias(c) for c in ("w", "s", "e", "n")))


@query
def uncovered_land(v):
    """Points in no shape by one-degree cell, with the smallest as the cell's."""
    inside = C.point_in_polygon(v("fx_point"), v("fx_ring")).select("id").distinct()
    return manifest.uncovered_land(v("fx_point").join(inside, "id", "left_anti"))


@query
def most_uncovered(v):
    """The 25 one-degree cells with the most points in no shape."""
    inside = C.point_in_polygon(v("fx_point"), v("fx_ring")).select("id").distinct()
    return manifest.uncovered_land(v("fx_point").join(inside, "id", "left_anti"), 25)


@query
def plan_summary(v):
    inside = C.point_in_polygon(v("fx_point"), v("fx_ring").filter("ext < 100")).select("id").distinct().withColumn("in", F.lit(1))
    both = v("fx_point").join(inside, "id", "left").agg(F.count("*").alias("points"), F.count("in").alias("covered"))
    total = v("fx_extract").agg(F.sum("bytes").alias("total_bytes"), F.count("*").alias("extracts"))
    return both.crossJoin(F.broadcast(total)).select("points", "covered", (F.col("points") - F.col("covered")).alias("uncovered"), "total_bytes", "extracts")


def _cover(v):
    candidates = C.cover_candidates(v("fx_point"), _inside(v), v("fx_shape"))
    return candidates, setcover.solve(candidates, v("fx_shape"))


@query
def set_cover(v):
    """Chosen extracts; the order of choice is kept."""
    _, cover = _cover(v)
    spark = v("region").sparkSession
    rows = [(int(c), k, c in cover.forced) for k, c in enumerate(cover.chosen)]
    return spark.createDataFrame(rows, "shape_id int, place int, forced boolean").join(v("fx_shape").select("shape_id", "region_id", "bytes"), "shape_id")


@query
def plan_regions(v):
    """The plan: chosen regions, a row for each of their clip boxes."""
    plan = manifest.plan_regions(*_cover(v), v("fx_point"), v("fx_shape"))
    each = plan.select("shape_id", "region_id", "continent", "bytes", F.col("clip").isNull().alias("whole"), F.posexplode_outer("clip").alias("box", "b"))
    corners = [F.round(F.get("b", F.lit(k)), 6).alias(c) for k, c in enumerate("wsen")]
    return each.select("shape_id", "region_id", "continent", "bytes", "whole", F.coalesce("box", F.lit(0)).alias("box"), *corners)


@query
def run_order(v):
    return merge.run_order(v("fx_extract")).select("region_id", "continent", "bytes", "seq")


@query
def largest_extracts(v):
    return v("fx_extract").orderBy(F.desc("bytes"), "region_id").limit(5).select("region_id", "bytes")


@query
def status(v):
    return manifest.status(v("fx_done"))


@query
def resume_todo(v):
    """Regions neither done nor of a finalized continent, in run order."""
    finalized = v("fx_extract").filter("ext = 2").select("continent")
    return manifest.todo(merge.run_order(v("fx_extract")).withColumnRenamed("region_id", "region"), v("fx_done"), finalized).select("region", "continent", "seq")


@query
def patch_regions(v):
    plan = v("fx_extract").withColumnRenamed("region_id", "region")
    listed = v("fx_extract").filter("ext % 6 = 0").select(F.col("region_id").alias("region"))
    return manifest.patch(plan, listed, v("fx_done")).select("region", "action")


@query
def store_regions(v):
    chunk = v("fx_presence").join(v("fx_extract"), "ext").filter("ext % 2 = 0").select(F.col("region_id").alias("region"))
    return v("fx_done").select("region").union(chunk).distinct()


@query
def publish_gate(v):
    return manifest.gate(v("fx_index_prev"), v("fx_index_new"))


@query
def gc_archives(v):
    """Published files that neither index names."""
    old = v("fx_extract").select(F.concat("region_id", F.lit("-20250101.pmtiles")).alias("file"))
    published = v("fx_index_prev").select("file").union(v("fx_index_new").select("file")).union(old)
    return manifest.garbage(published, v("fx_index_prev"), v("fx_index_new"))


@query
def deadline_projection(v):
    """Would the rest be baked in time, after each region of the run?"""
    run = merge.run_order(v("fx_extract"))
    up = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return manifest.projection(run.withColumn("baked", F.sum("bytes").over(up)), 40_000.0)


@query
def src_geojson_rings(v):
    """Rings of an index of features made of all shapes."""
    point = F.concat(F.lit("["), F.col("lon"), F.lit(","), F.col("lat"), F.lit("]"))
    ring = v("fx_ring").groupBy("ext", "ring").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", point.alias("p")))), lambda x: x["p"]), ",").alias("r"))
    part = ring.withColumn("r", F.concat(F.lit("[["), "r", F.lit("]]")))
    each = part.groupBy("ext").agg(F.array_join(F.array_sort(F.collect_list(F.struct("ring", "r")))["r"], ",").alias("c"))
    text = F.concat(F.lit('{"type":"Feature","properties":{"id":"'), "ext", F.lit('","name":"n","urls":{"pbf":"u"}},"geometry":{"type":"MultiPolygon","coordinates":['), "c", F.lit("]}}"))
    index = each.agg(F.concat(F.lit('{"features":['), F.array_join(F.collect_list(text), ","), F.lit("]}")).alias("value"))
    found = outlines.geojson_rings(outlines.geojson_index(index))
    own = v("fx_ring").select("ext", "ring").distinct().withColumn("k", F.row_number().over(Window.partitionBy("ext").orderBy("ring")) - 1)
    found = found.select(F.col("id").cast("int").alias("ext"), F.col("ring").alias("k"), "pos", "lon", "lat")
    return found.join(own, ["ext", "k"]).select("ext", "ring", "pos", "lon", "lat")


@query
def src_poly_rings(v):
    """Rings of .poly texts made of all shapes."""
    line = F.format_string("   %.6f %.6f", "lon", "lat")
    ring = v("fx_ring").groupBy("ext", "ring").agg(F.array_join(F.array_sort(F.collect_list(F.struct("pos", line.alias("l"))))["l"], "\n").alias("r"))
    text = F.concat(F.when(F.col("ring") == 1, "!").otherwise(""), F.col("ring").cast("string"), F.lit("\n"), "r", F.lit("\nEND\n"))
    each = ring.groupBy("ext").agg(F.concat(F.lit("name\n"), F.array_join(F.array_sort(F.collect_list(F.struct("ring", text.alias("t"))))["t"], ""), F.lit("END\n")).alias("value"))
    found = outlines.poly_rings(each, "ext")
    return found.groupBy("ext", "ring").agg(F.count("*").alias("points"), F.sum("lon").alias("lon"), F.sum("lat").alias("lat"))


@query
def src_shapefile(v):
    """Rings of a shapefile made of all shapes."""
    rings: dict[int, dict[int, list]] = {}
    for r in v("fx_ring").orderBy("ext", "ring", "pos").collect():  # the rings of some thirty shapes
        rings.setdefault(r["ext"], {}).setdefault(r["ring"], []).append((r["lon"], r["lat"]))
    raw = outlines.shapefile_bytes([list(rings[e].values()) for e in sorted(rings)])
    files = v("region").sparkSession.createDataFrame([("shapes.shp", bytearray(raw))], "path string, content binary")
    return outlines.shapefile_rings(files).select("rec", "ring", "pos", "lon", "lat")


@query
def src_osm_elements(v):
    """All elements of an extract made of the nodes, ways and relations."""
    from .sources import osm_pbf

    refs = v("fx_ref").groupBy(F.col("way_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("pos", "node_id")))["node_id"].alias("refs"))
    member = F.struct("pos", F.lit("way").alias("type"), F.col("way_id").alias("ref"), "role")
    members = v("fx_member").groupBy(F.col("relation_id").alias("id")).agg(F.array_sort(F.collect_list(member)).alias("m"))
    members = members.select("id", F.transform("m", lambda m: F.struct(m["type"].alias("type"), m["ref"].alias("ref"), m["role"].alias("role"))).alias("members"))
    none = F.lit(None)
    every = v("fx_node").select(F.lit("node").alias("kind"), "id", "lat", "lon", "tags", none.alias("refs"), none.alias("members"))
    every = every.union(v("fx_way").join(refs.hint("merge"), "id").select(F.lit("way"), "id", none, none, "tags", "refs", none))
    every = every.union(v("fx_relation").join(members.hint("merge"), "id").select(F.lit("relation"), "id", none, none, "tags", none, "members"))
    files = osm_pbf.blobs_of(every, "all.osm.pbf")
    found = osm_pbf.elements_of(files)
    return found.select("kind", "id", F.size("tags").alias("tags"), F.coalesce(F.size("refs"), F.lit(0)).alias("refs"), F.coalesce(F.size("members"), F.lit(0)).alias("members"), M.quantised("lat").alias("lat_q"))


def _archive(v) -> DataFrame:
    """An archive of all points' tiles, whose content is their coverage cell, as a file in a row."""
    from .sources import pmtiles

    tiles = v("fx_point").select(M.tile_x("lon").alias("x"), M.tile_y("lat").alias("y")).distinct()
    rows = tiles.select(M.hilbert_id("x", "y").alias("id"), M.cell("x", "y").cast("string").alias("c")).orderBy("id").collect()
    raw = pmtiles.archive((r["id"], r["c"].encode()) for r in rows)
    files = v("region").sparkSession.createDataFrame([("a.pmtiles", bytearray(raw))], "path string, content binary")
    return files


@query
def pmtiles_directory(v):
    """Directory entries of an archive of all points' tiles, whose content is their coverage cell."""
    from .sources import pmtiles

    return pmtiles.directory_of(_archive(v)).select(F.explode(F.sequence(F.col("tile_id"), F.col("tile_id") + F.col("run") - 1)).alias("tile_id"), "length")


@query
def archive_cells(v):
    """Coverage cells of that archive, from its directory alone."""
    from .sources import pmtiles

    return pmtiles.covered_cells(pmtiles.directory_of(_archive(v))).select("cell")
