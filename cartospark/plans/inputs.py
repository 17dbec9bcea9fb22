"""From files to what the engine plans and bakes: extracts to Bake inputs; indexes, outlines and land to shapes and points."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import coverage
from ..sources import osm_pbf, outlines
from .bake import Bake
from .files import Files

COVERAGE = "struct<supplements: array<struct<id: string, name: string, path: string, continent: string>>, anchors: array<struct<name: string, at: array<double>>>>"
#: The size of an extract that nobody told: no plan takes it.
UNKNOWN = (1 << 63) - 1


# -- bake ------------------------------------------------------------------------------------------


def bake_of(elements: DataFrame, regions: DataFrame) -> Bake:
    """A bake of elements (ext, and the columns of osm_pbf.SCHEMA) for regions (ext, continent, seq, clip).

    Only way members count.  A null clip is the whole extract, an empty one takes nothing.
    """
    kind = lambda k: elements.filter(F.col("kind") == k)
    ways = kind("way")
    refs = ways.select("ext", F.col("id").alias("way_id"), F.posexplode("refs").alias("pos", "node_id"))
    relations = kind("relation")
    members = relations.select("ext", F.col("id").alias("relation_id"), F.posexplode("members").alias("pos", "m")).filter("m.type = 'way'")
    members = members.select("ext", "relation_id", "pos", F.col("m.ref").alias("way_id"), F.col("m.role").alias("role"))
    # an empty clip becomes one box without sides, which no tile is in
    boxes = regions.filter("clip IS NOT NULL").select("ext", F.explode_outer("clip").alias("b"))
    clips = boxes.select("ext", *(F.get("b", F.lit(k)).alias(c) for k, c in enumerate("wsen")))
    return Bake(kind("node").select("ext", "id", "lat", "lon", "tags"), ways.select("ext", "id", "tags"), refs, relations.select("ext", "id", "tags"), members, regions, clips)


def bake_files(spark: SparkSession, path_of: Callable[[str], str], store: str) -> Callable[[DataFrame], Bake]:
    """What Engine.run takes as inputs: regions to the bake of their extracts, path_of(region_id) being a region's file.

    A file is read by blobs, many tasks to an extract, from any store that Arrow reads, and decoded once: into a table in the folder
    ``store``, parted by kind, of which each step of the bake reads its kind and columns.
    """
    spark.dataSource.register(osm_pbf.OsmPbfSource)

    def inputs(regions: DataFrame) -> Bake:
        listed = regions.select("ext", "region_id").collect()  # a row for each region
        where = f"{store}/elements"
        for k, r in enumerate(listed):
            rows = spark.read.format("osmpbf").load(path_of(r["region_id"])).withColumn("ext", F.lit(r["ext"]))
            rows.write.mode("append" if k else "overwrite").option("compression", "zstd").partitionBy("kind").parquet(where)
        schema = f"ext int, {osm_pbf.SCHEMA}"
        return bake_of(spark.read.schema(schema).parquet(where), regions)

    return inputs


# -- plan ------------------------------------------------------------------------------------------


def measured(spark: SparkSession, ids: list[str], path_of: Callable[[str], str]) -> tuple[dict[str, int], dict[str, list[float]]]:
    """(sizes, header boxes) by id of extracts that are in place, path_of(id) being an extract's file; only headers are read.

    They are what ``read_plan`` takes as JSON files.  An extract that is missing has no size, and one without a box in its header no box.
    """
    files, sizes, boxes = Files(spark), {}, {}
    for i in ids:
        if files.exists(path_of(i)):
            sizes[i] = files.size(path_of(i))
            if (box := osm_pbf.read_box(path_of(i))) is not None:
                west, south, east, north = box
                boxes[i] = [west, south, east, north]
    return sizes, boxes


@dataclass
class PlanInputs:
    """What Engine.plan takes: sample points (id, lon, lat), rings (ext, ring, pos, lon, lat) and shapes
    (shape_id, region_id, name, url, bytes, continent, kind, parent)."""

    points: DataFrame
    rings: DataFrame
    shapes: DataFrame


def _numbered(shapes: DataFrame) -> DataFrame:
    """shapes with shape_id in the order of ``at``, and parents by number; there is a row for each extract."""
    numbered = shapes.withColumn("shape_id", (F.row_number().over(Window.orderBy("at", "region_id")) - 1).cast("int"))
    parents = numbered.select(F.col("region_id").alias("above"), F.col("shape_id").alias("parent"))
    return numbered.join(parents, "above", "left").select("shape_id", "region_id", "name", "url", "bytes", "continent", "kind", "parent")


_SHAPE = ["at", "region_id", "name", "url", "bytes", "continent", "kind", "above"]


def _index_shapes(index: DataFrame, sizes: DataFrame, boxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shapes and rings (region_id, ring, pos, lon, lat) of an index's features; without an outline, by the box of its header."""
    each = index.filter("url IS NOT NULL")
    outline = outlines.geojson_rings(each)
    real = outline.select("id").distinct().withColumn("real", F.lit(True))
    roots = coverage.roll_up(index.select("id", "parent")).select("id", F.col("root").alias("continent"))
    joined = each.join(real, "id", "left").join(boxes, "id", "left").join(sizes, "id", "left").join(roots, "id", "left").filter("real OR w IS NOT NULL")
    joined = joined.withColumns({"at": F.format_string("0 %08d", "place"), "bytes": F.coalesce("bytes", F.lit(UNKNOWN)), "above": F.lit(None).cast("string")})
    shapes = joined.withColumnRenamed("id", "region_id").withColumn("kind", F.when(F.col("real"), "Polygon").otherwise("HeaderBox")).select(*_SHAPE)
    corners = F.array(*(F.struct(F.col(x).alias("lon"), F.col(y).alias("lat")) for x, y in (("w", "s"), ("e", "s"), ("e", "n"), ("w", "n"))))
    boxed = joined.filter("real IS NULL").select("id", F.lit(0).alias("ring"), F.posexplode(corners).alias("pos", "p")).select("id", "ring", "pos", "p.lon", "p.lat")
    return shapes, outline.union(boxed).withColumnRenamed("id", "region_id")


def _config_shapes(config: DataFrame, sizes: DataFrame, polygons: DataFrame, url_of: Callable) -> tuple[DataFrame, DataFrame]:
    """Shapes and rings of supplements and of the outlines above them in the tree of paths, which are never baked."""
    each = config.select(F.posexplode("supplements").alias("place", "s")).select("place", "s.*")
    part = F.split("path", "/")
    first = lambda n: F.array_join(F.slice(part, 1, n), "/")
    label = lambda c: F.concat(F.lit("above:"), c)
    above = F.when(F.size(part) > 1, label(first(F.size(part) - 1)))
    ups = each.select("place", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(part)), first)).alias("up")).filter("up <> path")
    ups = ups.groupBy(F.col("up").alias("path")).agg(F.min("place").alias("place"))
    ups = ups.select("place", label(F.col("path")).alias("id"), F.col("path").alias("name"), "path", F.lit("").alias("continent"), F.lit("").alias("url"), F.lit(UNKNOWN).alias("bytes"), F.lit("Ancestor").alias("kind"))
    own = each.join(sizes, "id", "left").withColumns({"url": url_of(F.col("path")), "kind": F.lit("Supplement")}).select(*ups.columns)
    group = F.when(F.col("kind") == "Ancestor", 1).otherwise(2)
    both = ups.union(own).withColumns({"at": F.format_string("%d %08d %08d", group, F.col("place"), 1_000_000 - F.length("path")), "above": above}).withColumnRenamed("id", "region_id")
    rings = outlines.poly_rings(polygons, "path")
    known = rings.select("path").distinct().withColumn("known", F.lit(True))
    bad = both.join(known, "path", "left").filter("known IS NULL OR bytes IS NULL").select("region_id", "known").limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{r['region_id']}: " + ("its size is not known" if r["known"] else "its outline has no usable ring") for r in bad))
    return both.select(*_SHAPE), both.select("region_id", "path").join(rings, "path").drop("path")


def shapes_and_rings(index: DataFrame, sizes: DataFrame, boxes: DataFrame, config: DataFrame | None = None, config_sizes: DataFrame | None = None, polygons: DataFrame | None = None, url_of: Callable | None = None):
    """shapes, and rings (region_id, ring, pos, lon, lat), of an index (id, name, parent, url, type, coordinates, place), with sizes (id, bytes) and header boxes (id, w, s, e, n).

    config (supplements, anchors) adds supplements by their .poly texts, polygons (path, value); url_of(path) is where such an
    extract is.  The order of shapes is that of the index, then outlines above supplements, then supplements.
    """
    shapes, rings = _index_shapes(index, sizes, boxes)
    if config is not None:
        more, outline = _config_shapes(config, config_sizes, polygons, url_of or (lambda path: path))
        shapes, rings = shapes.union(more), rings.union(outline.select(*rings.columns))
    return _numbered(shapes), rings


def sample_points(spark: SparkSession, shapes: DataFrame, rings: DataFrame, land: DataFrame | None = None, lakes: DataFrame | None = None, anchors: DataFrame | None = None) -> DataFrame:
    """(id, lon, lat): the global grid and a grid in each ring of extracts under the size cap, both on land; small islands and anchors.

    land, lakes: rings (rec, ring, pos, lon, lat).  Ids are hashes of where a point comes from, so equal places of several rings all count.
    """
    able = shapes.filter(F.col("bytes") <= S.EXTRACT_CAP).select(F.col("shape_id").alias("ext"))
    own = coverage.ring_samples(rings.join(able, "ext", "left_semi"), ["ext"])
    named = lambda df, kind, *keys: df.select(F.xxhash64(F.lit(kind), *keys, "lon", "lat").alias("id"), "lon", "lat")
    points = named(coverage.sample_grid(spark), "grid").union(named(own, "ring", "ext", "ring"))
    if land is not None:
        none = land.limit(0)
        points = coverage.on_land(points, land, none if lakes is None else lakes, ["rec"])
        points = points.union(named(coverage.island_samples(land, ["rec"]), "island", "rec", "ring"))
    return points if anchors is None else points.union(named(anchors, "anchor", "place"))


def read_plan(
    spark: SparkSession, store: str, index: str, sizes: str, boxes: str | None = None, config: str | None = None, config_sizes: str | None = None,
    polygons: Callable[[str], str] | None = None, url_of: Callable | None = None, land: str | None = None, lakes: str | None = None,
) -> PlanInputs:
    """Inputs of a plan from files: a GeoJSON index, JSON objects of sizes (and header boxes) by id, the coverage config with its sizes,
    polygons(path) for the .poly file of a path, and shapefiles of land and lakes.  The results are tables in the folder ``store``."""
    files = Files(spark)
    whole = lambda path: spark.read.text(path, wholetext=True)
    by_id = lambda path, kind: whole(path).select(F.explode(F.from_json("value", f"map<string, {kind}>")).alias("id", "x"))
    size_of = lambda path: by_id(path, "bigint").withColumnRenamed("x", "bytes")
    box_of = by_id(boxes, "array<double>") if boxes else spark.createDataFrame([], "id string, x array<double>")
    box_of = box_of.select("id", *(F.get("x", F.lit(k)).alias(c) for k, c in enumerate("wsen")))
    features = outlines.geojson_index(whole(index))
    more, anchors = {}, None
    if config:
        found = whole(config).select(F.from_json("value", COVERAGE).alias("c")).select("c.*")
        paths = sorted({"/".join(p[:n]) for r in found.select(F.explode("supplements.path")).collect() for p in [r[0].split("/")] for n in range(1, len(p) + 1)})
        texts = spark.createDataFrame([(p, files.read(polygons(p)).decode("utf-8", "replace")) for p in paths], "path string, value string")
        more = {"config": found, "config_sizes": size_of(config_sizes), "polygons": texts, "url_of": url_of}
        anchors = found.select(F.posexplode("anchors").alias("place", "a")).select("place", F.get("a.at", F.lit(0)).alias("lon"), F.get("a.at", F.lit(1)).alias("lat"))

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{store}/{name}")
        return spark.read.schema(df.schema).parquet(f"{store}/{name}")

    shapes, rings = shapes_and_rings(features, size_of(sizes), box_of, **more)
    shapes = kept("shapes", shapes)
    numbered = rings.join(F.broadcast(shapes.select("region_id", F.col("shape_id").alias("ext"))), "region_id").select("ext", "ring", "pos", "lon", "lat")
    rings = kept("rings", numbered)
    outline = lambda name, path: kept(name, outlines.shapefile_rings(spark.read.format("binaryFile").load(path)).drop("path")) if path else None
    return PlanInputs(kept("points", sample_points(spark, shapes, rings, outline("land", land), outline("lakes", lakes), anchors)), rings, shapes)
