"""Sample points, polygon membership and the land mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S


#: Degrees of latitude by which edges and points meet.
BAND = 0.25


def edges(rings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., ring, x1, y1, x2, y2) of rings (keys.., ring, pos, lon, lat): each vertex with the next, the last with the first."""
    keys = [*(k for k in keys if k != "ring"), "ring"]
    order = Window.partitionBy(*keys).orderBy("pos")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(order), F.first(c).over(whole))
    return rings.select(*keys, F.col("lon").alias("x1"), F.col("lat").alias("y1"), nxt("lon").alias("x2"), nxt("lat").alias("y2"))


def crosses(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Does a ray from (x, y) towards larger x cross the edge?  Half-open in y, so no vertex counts twice."""
    meets = F.try_divide((x1 - x2) * (y - y2), y1 - y2) + x2
    return ((y1 > y) != (y2 > y)) & F.coalesce(x < meets, F.lit(False))


def point_in_polygon(points: DataFrame, rings: DataFrame, key: str = "ext") -> DataFrame:
    """(key, id) of points (id, lon, lat) inside an odd number of the rings of a shape.

    Points and boxes of shapes meet on one-degree cells, an equi-join; the parity of crossings
    over all rings then decides, which is that of the rings the point is in.
    """
    box = rings.groupBy(key).agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"))
    down = lambda c: F.floor(c).cast("int")
    cells = box.withColumn("cx", F.explode(F.sequence(down("w"), down("e")))).withColumn("cy", F.explode(F.sequence(down("s"), down("n"))))
    near = points.withColumns({"cx": down("lon"), "cy": down("lat")}).join(cells, ["cx", "cy"])
    near = near.filter(F.col("lon").between(F.col("w"), F.col("e")) & F.col("lat").between(F.col("s"), F.col("n")))
    return enclosed(near.select(key, "id", "lon", "lat"), rings, [key], ["id"]).select(key, "id")


def enclosed(points: DataFrame, rings: DataFrame, keys: list[str], ident: list[str]) -> DataFrame:
    """points (keys.., ident.., lon, lat) inside an odd number of the rings with their keys; ident tells points of the same keys apart.

    Edges and points meet on keys and a band of latitude, so an outline of any length spreads over bands
    and no row holds more than an edge; crossings are counted before they meet again by point.
    """
    band = lambda c: F.floor(F.col(c) / BAND).cast("int")
    at = edges(rings, keys).filter("y1 <> y2").withColumn("band", F.explode(F.sequence(F.floor(F.least("y1", "y2") / BAND).cast("int"), F.floor(F.greatest("y1", "y2") / BAND).cast("int"))))
    hits = points.withColumn("band", band("lat")).join(at, [*keys, "band"]).filter(crosses(*(F.col(c) for c in ("lon", "lat", "x1", "y1", "x2", "y2"))))
    once = [c for c in ("lon", "lat") if c not in ident]
    odd = hits.groupBy(*keys, *ident).agg((F.count("*") % 2).alias("odd"), *(F.first(c).alias(c) for c in once)).filter("odd = 1")
    return odd.select(*keys, *ident, *once)


def sample_grid(spark: SparkSession, step: float = S.GRID_STEP) -> DataFrame:
    """The global grid: longitudes from -180, latitudes from -85 to 85, every step."""
    lat = spark.range(int(170 / step) + 1).select((F.col("id") * step - 85.0).alias("lat"))
    return lat.select("lat", F.explode(F.sequence(F.lit(0), F.lit(int(360 / step) - 1))).alias("i")).select((F.col("i") * step - 180.0).alias("lon"), "lat")


def ring_samples(rings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., ring, lon, lat): a grid inside each ring, about RING_SIDE points to a side."""
    box = rings.groupBy(*keys, "ring").agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"))
    step = F.sqrt(F.greatest((F.col("e") - F.col("w")) * (F.col("n") - F.col("s")), F.lit(1e-12))) / S.RING_SIDE
    box = box.withColumn("step", F.least(F.greatest(step, F.lit(S.LEAST_STEP)), F.lit(S.GRID_STEP)))
    # the cell centres from half a step on that lie before the far side
    centres = lambda a, b: F.filter(
        F.transform(F.sequence(F.lit(0), F.ceil((F.col(b) - F.col(a)) / F.col("step")).cast("int")), lambda i: F.col(a) + F.col("step") * (i + 0.5)), lambda c: c < F.col(b)
    )
    grid = box.withColumn("lat", F.explode(centres("s", "n"))).withColumn("lon", F.explode(centres("w", "e"))).select(*keys, "ring", "lon", "lat")
    return enclosed(grid, rings, [*keys, "ring"], ["lon", "lat"]).select(*keys, "ring", "lon", "lat")


def island_samples(rings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., ring, lon, lat): for rings below SMALL_ISLAND, those of 5 x 5 cell centres inside, else the first vertex.

    A record that lies within a tenth of a degree of (0, 0) is no land and is left out.
    """
    real = rings.groupBy(*keys).agg(F.max(F.greatest(F.abs("lon"), F.abs("lat"))).alias("far")).filter("far >= 0.1").select(*keys)
    rings = rings.join(real, keys, "left_semi")
    box = rings.groupBy(*keys, "ring").agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"), F.min_by(F.struct("lon", "lat"), "pos").alias("first"))
    small = box.filter((F.col("e") - F.col("w") < S.SMALL_ISLAND) & (F.col("n") - F.col("s") < S.SMALL_ISLAND))
    outline = edges(rings, keys).groupBy(*keys, "ring").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    mid = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * (k + 0.5) / 5.0
    five = F.sequence(F.lit(0), F.lit(4))
    grid = F.flatten(F.transform(five, lambda i: F.transform(five, lambda j: F.struct(mid("w", "e", i).alias("lon"), mid("s", "n", j).alias("lat")))))
    inside = F.filter(grid, lambda p: F.size(F.filter("edges", lambda g: crosses(p["lon"], p["lat"], g["x1"], g["y1"], g["x2"], g["y2"]))) % 2 == 1)
    found = small.join(outline, [*keys, "ring"]).withColumn("in", inside)
    return found.select(*keys, "ring", F.explode(F.when(F.size("in") > 0, F.col("in")).otherwise(F.array("first"))).alias("p")).select(*keys, "ring", "p.lon", "p.lat")


def clip_boxes(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., w, s, e, n): the one-degree cells of points (keys.., lon, lat), widened, within the globe."""
    cells = points.select(*keys, F.floor("lon").alias("x"), F.floor("lat").alias("y")).distinct()
    edge = lambda c, add, f, lim: f(F.col(c) + F.lit(add), F.lit(lim))
    return cells.select(
        *keys,
        edge("x", -S.CLIP_MARGIN, F.greatest, -180.0).alias("w"),
        edge("y", -S.CLIP_MARGIN, F.greatest, -90.0).alias("s"),
        F.least(F.col("x") + 1.0 + S.CLIP_MARGIN, F.lit(180.0)).alias("e"),
        F.least(F.col("y") + 1.0 + S.CLIP_MARGIN, F.lit(90.0)).alias("n"),
    )


COLUMNS, ROWS = 18_000, 9_000


def spans(rings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., row, c_lo, c_hi): raster cells whose centres the rings of a record enclose, by even-odd scan lines."""
    e = edges(rings, keys).filter("y1 <> y2")
    r = lambda y: F.floor((90.0 - y) / S.LAND_CELL - 0.5)
    lo = F.greatest(r(F.greatest("y1", "y2")) + 1, F.lit(0))
    hi = F.least(r(F.least("y1", "y2")), F.lit(ROWS - 1))
    hits = e.withColumns({"lo": lo, "hi": hi}).filter("hi >= lo").withColumn("row", F.explode(F.sequence("lo", "hi")))
    centre = 90.0 - (F.col("row") + 0.5) * S.LAND_CELL
    hits = hits.withColumn("x", F.col("x1") + (centre - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    line = Window.partitionBy(*keys, "row").orderBy("x")
    pairs = hits.withColumns({"k": F.row_number().over(line), "to": F.lead("x").over(line)}).filter("k % 2 = 1 AND to IS NOT NULL")
    cell = lambda x: F.ceil((x + 180.0) / S.LAND_CELL - 0.5)
    found = pairs.select(*keys, F.col("row").cast("int").alias("row"), F.greatest(cell(F.col("x")), F.lit(0)).cast("int").alias("c_lo"), F.least(cell(F.col("to")) - 1, F.lit(COLUMNS - 1)).cast("int").alias("c_hi"))
    return found.filter("c_hi >= c_lo")


def edge_cells(rings: DataFrame, keys: list[str]) -> DataFrame:
    """(row, c): raster cells that edges pass through, at half-cell spacing."""
    e = edges(rings, keys)
    n = F.greatest(F.ceil(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) / (S.LAND_CELL / 2.0)), F.lit(1)).cast("int")
    e = e.withColumn("n", n).withColumn("t", F.explode(F.sequence(F.lit(0), "n")))
    at = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * (F.col("t") / F.col("n"))
    cells = e.select(F.floor((90.0 - at("y1", "y2")) / S.LAND_CELL).cast("int").alias("row"), F.floor((at("x1", "x2") + 180.0) / S.LAND_CELL).cast("int").alias("c"))
    return cells.filter(F.col("c").between(0, COLUMNS - 1) & F.col("row").between(0, ROWS - 1)).distinct()


def on_land(points: DataFrame, land: DataFrame, lakes: DataFrame, keys: list[str]) -> DataFrame:
    """points (id, lon, lat) on land: a cell of a land edge, or inside land and not inside a lake.

    A band join: spans are keyed by raster row, points find theirs by row and column.
    """
    at = points.withColumns({"row": F.floor((90.0 - F.col("lat")) / S.LAND_CELL).cast("int"), "c": F.floor((F.col("lon") + 180.0) / S.LAND_CELL).cast("int")})
    at = at.filter(F.col("c").between(0, COLUMNS - 1) & F.col("row").between(0, ROWS - 1))
    within = lambda spanned: (F.col("p.row") == F.col(f"{spanned}.row")) & F.col("p.c").between(F.col(f"{spanned}.c_lo"), F.col(f"{spanned}.c_hi"))
    inside = at.alias("p").join(spans(land, keys).alias("l"), within("l"), "left_semi")
    inside = inside.alias("p").join(spans(lakes, keys).alias("k"), within("k"), "left_anti")
    coast = at.join(edge_cells(land, keys), ["row", "c"], "left_semi")
    return inside.select("id", "lon", "lat").union(coast.select("id", "lon", "lat")).distinct()


def roll_up(nodes: DataFrame, steps: int = 16) -> DataFrame:
    """(id, root, depth) of nodes (id, parent): parents followed up to ``steps`` times, by doubling the jump.

    Jumps of 1, 2, 4.. hops need log2(steps) joins; an unknown parent is a root too.
    """
    known = nodes.select("id", "parent")
    state = known.select("id", F.coalesce("parent", "id").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth"))
    hops = 1
    while hops < steps:
        upper = state.select(F.col("id").alias("up"), F.col("up").alias("upper"), F.col("depth").alias("more"))
        state = state.join(upper, "up", "left").select("id", F.coalesce("upper", "up").alias("up"), (F.col("depth") + F.when(F.col("up") == F.col("id"), 0).otherwise(F.coalesce("more", F.lit(0)))).alias("depth"))
        hops *= 2
    return state.select("id", F.col("up").alias("root"), "depth")


def ancestors(shapes: DataFrame, depth: int = 16) -> list[tuple[int, int]]:
    """(shape, ancestor) of shapes (shape_id, parent): known ancestors only, up to so many steps; there is a row for each extract."""
    up = {r["shape_id"]: r["parent"] for r in shapes.select("shape_id", "parent").collect()}
    found = []
    for shape in up:
        at = up[shape]
        for _ in range(depth):
            if at not in up:
                break
            found.append((shape, at))
            at = up[at]
    return sorted(set(found))


def effective(inside: DataFrame, shapes: DataFrame) -> DataFrame:
    """(shape_id, id): points inside a shape and inside all its ancestors that are known."""
    pairs = ancestors(shapes)
    if not pairs:
        return inside.select("shape_id", "id")
    spark = inside.sparkSession
    above = F.broadcast(spark.createDataFrame(pairs, "shape_id int, above int"))
    needs = F.broadcast(spark.createDataFrame([(s, sum(s == t for t, _ in pairs)) for s in sorted({s for s, _ in pairs})], "shape_id int, needs int"))
    # a point of a shape with ancestors stays if as many of them have it as there are
    held = inside.select(F.col("shape_id").alias("above"), "id").join(above, "above").select("shape_id", "id", F.lit(1).alias("up"))
    each = inside.select("shape_id", "id", F.lit(0).alias("up")).union(held).groupBy("shape_id", "id").agg(F.sum("up").alias("ups"), F.count_if(F.col("up") == 0).alias("own"))
    return each.join(needs, "shape_id", "left").filter((F.col("own") > 0) & (F.col("ups") == F.coalesce("needs", F.lit(0)))).select("shape_id", "id")


def orphans(points: DataFrame, inside: DataFrame, shapes: DataFrame) -> DataFrame:
    """points that no polygon extract under the size cap contains."""
    real = shapes.filter((F.col("kind") == "Polygon") & (F.col("bytes") <= S.EXTRACT_CAP)).select("shape_id")
    return points.join(inside.join(real, "shape_id", "left_semi").select("id").distinct(), "id", "left_anti")


def cover_candidates(points: DataFrame, inside: DataFrame, shapes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(shape_id, forced, id): candidates and their points; a forced one without points has a null id.

    Polygons claim all their points; boxes and supplements only those that no polygon reaches.
    """
    able = shapes.filter((F.col("bytes") <= S.EXTRACT_CAP) & (F.col("kind") != "Ancestor"))
    able = able.withColumn("forced", (F.col("kind") == "HeaderBox") | F.col("region_id").isin(keep or []))
    lone = orphans(points, inside, shapes).select("id").withColumn("orphan", F.lit(True))
    mask = inside.join(able.select("shape_id", "kind"), "shape_id").join(lone, "id", "left").filter("kind = 'Polygon' OR orphan").select("shape_id", "id")
    return able.select("shape_id", "forced").join(mask, "shape_id", "left").filter("id IS NOT NULL OR forced")
