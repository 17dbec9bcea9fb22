"""From references to geometry and tiles: the relational core of a bake.

Tables of elements are always shuffled to a join (hint ``merge``): estimates before a run miss what lists and
tags unfold to, and several broadcasts at once would fill the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tags as T
from ..functions import tilemath as M
from ..schemas import TILES


def kept_nodes(nodes: DataFrame) -> DataFrame:
    """Points of interest of nodes (region.., id, lat, lon, tags): filtered tags, quantised place, tile.

    The tile is that of the given degrees, not of the quantised ones.
    """
    kept = nodes.withColumn("tags", T.filtered(F.col("tags"))).filter(T.node_wanted(F.col("tags")))
    return kept.withColumns({"lat_q": M.quantised("lat"), "lon_q": M.quantised("lon"), "x": M.tile_x("lon"), "y": M.tile_y("lat")})


def kept_relations(relations: DataFrame, members: DataFrame) -> DataFrame:
    """Relations with wanted tags and at least one way member; members (relation_id, pos, way_id, role) in order.

    With a column ext, members are those of each region's copy.
    """
    kept = relations.withColumn("tags", T.filtered(F.col("tags"))).filter(T.relation_wanted(F.col("tags")))
    keys = [c for c in members.columns if c == "ext"] + ["id"]
    own = members.withColumnRenamed("relation_id", "id").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "way_id", F.coalesce("role", F.lit("")).alias("role")))).alias("members"))
    own = own.withColumn("members", F.transform("members", lambda m: F.struct(m["way_id"].alias("way_id"), m["role"].alias("role"))))
    return kept.join(own.hint("merge"), keys)


def kept_ways(ways: DataFrame, relations: DataFrame) -> DataFrame:
    """Ways with a surviving tag that are no sea, and all members of kept relations of their region."""
    member = relations.select("ext", F.explode("members.way_id").alias("id")).distinct().withColumn("is_member", F.lit(True))
    tagged = ways.withColumn("tags", T.filtered(F.col("tags")))
    flagged = tagged.join(member.hint("merge"), ["ext", "id"], "left").withColumn("is_member", F.coalesce("is_member", F.lit(False)))
    return flagged.filter(F.col("is_member") | T.way_wanted(F.col("tags")))


def _without_repeats(points: Column) -> Column:
    return F.filter(points, lambda p, i: (i == 0) | (p != F.get(points, i - 1)))


def way_geometry(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(ext, way_id, closed, points) of refs (ext, way_id, pos, node_id) resolved against nodes (ext, id, lat, lon).

    Unresolved references vanish; a way is closed if its ids are, even when the shared end is
    missing; vertices equal after quantisation merge; ways with fewer than two vertices vanish.
    One shuffle by node, one by way; tags stay out of both.
    """
    places = nodes.select("ext", F.col("id").alias("node_id"), M.quantised("lat").alias("lat_q"), M.quantised("lon").alias("lon_q"))
    found = refs.join(places.hint("merge"), ["ext", "node_id"], "left")
    place = F.struct("pos", "lat_q", "lon_q")
    ways = found.groupBy("ext", "way_id").agg(
        ((F.count("*") > 2) & (F.min_by("node_id", "pos") == F.max_by("node_id", "pos"))).alias("closed"),
        F.array_sort(F.collect_list(F.when(F.col("lat_q").isNotNull(), place))).alias("raw"),
    )
    ways = ways.filter(F.size("raw") >= 2).withColumn("raw", F.transform("raw", lambda p: F.struct(p["lat_q"].alias("lat_q"), p["lon_q"].alias("lon_q"))))
    ways = ways.withColumn("points", _without_repeats(F.col("raw")))
    open_end = F.col("closed") & (F.try_element_at("points", F.lit(1)) != F.try_element_at("points", F.lit(-1)))
    ways = ways.withColumn("points", F.when(open_end, F.concat("points", F.slice("points", 1, 1))).otherwise(F.col("points")))
    return ways.filter(F.size("points") >= 2).select("ext", "way_id", "closed", "points")


def segments(geometry: DataFrame) -> DataFrame:
    """One row per segment of geometry, with tile fractions of its ends: (ext, way_id, x0, y0, x1, y1)."""
    n = F.size("points")
    pair = F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.struct(F.get("points", i).alias("a"), F.get("points", i + 1).alias("b")))
    each = geometry.select("ext", "way_id", F.explode(pair).alias("s"))
    frac = lambda end: (M.fraction_x(M.degrees(F.col(f"s.{end}.lon_q"))), M.fraction_y(M.degrees(F.col(f"s.{end}.lat_q"))))
    (x0, y0), (x1, y1) = frac("a"), frac("b")
    return each.select("ext", "way_id", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def way_tiles(geometry: DataFrame) -> DataFrame:
    """(ext, way_id, x, y): each tile that a vertex or a segment of a way touches.

    Every vertex ends some segment, and a segment's walk starts in its first end's tile; its last end's
    tile is added for the walks that a rounded corner stops short of it.
    """
    each = segments(geometry)
    clamp = lambda c: F.least(F.greatest(F.floor(c), F.lit(0)), F.lit(TILES - 1)).cast("int")
    end = F.array(F.struct(clamp(F.col("x1")).alias("x"), clamp(F.col("y1")).alias("y")))
    touched = F.array_union(M.segment_tiles(*(F.col(c) for c in ("x0", "y0", "x1", "y1"))), end)
    return each.select("ext", "way_id", F.explode(touched).alias("t")).select("ext", "way_id", "t.x", "t.y").distinct()


def tiles_of(points: str) -> Column:
    """ARRAY<STRUCT<x, y>>: each tile of :func:`way_tiles` of a way with these points, once, without a row for each segment."""
    at = F.transform(points, lambda p: F.struct(M.fraction_x(M.degrees(p["lon_q"])).alias("x"), M.fraction_y(M.degrees(p["lat_q"])).alias("y")))
    clamp = lambda c: F.least(F.greatest(F.floor(c), F.lit(0)), F.lit(TILES - 1)).cast("int")
    end = lambda p: F.array(F.struct(clamp(p["x"]).alias("x"), clamp(p["y"]).alias("y")))
    walk = lambda a, b: F.concat(M.segment_tiles(a["x"], a["y"], b["x"], b["y"]), end(b))
    start = F.struct(F.lit(None).cast("struct<x: double, y: double>").alias("last"), F.array().cast("array<struct<x: int, y: int>>").alias("out"))
    step = lambda s, p: F.struct(p.alias("last"), F.when(s["last"].isNull(), s["out"]).otherwise(F.array_union(s["out"], walk(s["last"], p))).alias("out"))
    return F.aggregate(at, start, step, lambda s: s["out"])


def relation_tiles(relations: DataFrame, tiles: DataFrame) -> DataFrame:
    """(ext, relation_id, x, y): a relation goes wherever one of its members goes."""
    member = relations.select("ext", F.col("id").alias("relation_id"), F.explode("members.way_id").alias("way_id"))
    return member.join(tiles.hint("merge"), ["ext", "way_id"]).select("ext", "relation_id", "x", "y").distinct()


def touching(relations: DataFrame, tiles: DataFrame) -> DataFrame:
    """(ext, x, y, kind, id) of ways and of relations from one pass over the tiles of ways.

    A relation comes once for each member in a tile: for what takes equal rows once anyway.
    """
    member = relations.select("ext", F.col("id").alias("relation_id"), F.explode("members.way_id").alias("way_id"))
    own = member.groupBy("ext", "way_id").agg(F.collect_set("relation_id").alias("_relations"))
    each = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("id"))
    of = F.transform(F.coalesce("_relations", F.array().cast("array<long>")), lambda r: each("relation", r))
    rows = tiles.join(own.hint("merge"), ["ext", "way_id"], "left").select("ext", "x", "y", F.explode(F.concat(F.array(each("way", F.col("way_id"))), of)).alias("e"))
    return rows.select("ext", "x", "y", "e.kind", "e.id")


def clipped(tiles: DataFrame, clips: DataFrame | None) -> DataFrame:
    """Rows of tiles (ext, x, y, ..) inside some clip box of their region; regions without boxes are whole.

    clips: (ext, w, s, e, n) in degrees, a few rows per region.
    """
    return tiles if clips is None else flag_clipped(tiles, clips).filter("kept").drop("kept")


def flag_clipped(tiles: DataFrame, clips: DataFrame) -> DataFrame:
    """tiles with ``kept``: see :func:`clipped`."""
    corner = F.struct(M.tile_x("w").alias("x0"), M.tile_y("n").alias("y0"), M.tile_x("e").alias("x1"), M.tile_y("s").alias("y1"))
    boxes = clips.groupBy("ext").agg(F.collect_set(corner).alias("_boxes"))
    inside = F.exists("_boxes", lambda b: F.col("x").between(b["x0"], b["x1"]) & F.col("y").between(b["y0"], b["y1"]))
    return tiles.join(boxes, "ext", "left").withColumn("kept", F.col("_boxes").isNull() | inside).drop("_boxes")


def whole_relations(relations: DataFrame, tiles: DataFrame, ways: DataFrame, clips: DataFrame | None = None) -> DataFrame:
    """(ext, relation_id, ways): relations over several tiles, at least one kept, with each resolved member way once.

    ways: (ext, way_id, ..), the stored copies.  Ids beyond 32 bits have no record.
    """
    flagged = tiles.withColumn("kept", F.lit(True)) if clips is None else flag_clipped(tiles, clips)
    spans = flagged.groupBy("ext", "relation_id").agg(F.count("*").alias("n"), F.bool_or("kept").alias("any")).filter("n > 1 AND any AND relation_id < 4294967296")
    member = relations.select("ext", F.col("id").alias("relation_id"), F.explode("members.way_id").alias("way_id")).distinct()
    found = spans.join(member.hint("merge"), ["ext", "relation_id"]).join(ways.hint("merge"), ["ext", "way_id"])
    return found.groupBy("ext", "relation_id").agg(F.array_sort(F.collect_list("way_id")).alias("ways"))
