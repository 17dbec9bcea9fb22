"""Plans, indexes and what is done: the small tables around a bake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import coverage
from .setcover import Cover


def status(done: DataFrame) -> DataFrame:
    """(continent, regions, bytes) per continent, and in total where continent is null."""
    return done.rollup("continent").agg(F.count("*").alias("regions"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def todo(plan: DataFrame, done: DataFrame, finalized: DataFrame) -> DataFrame:
    """Regions of the plan that are not done and whose continent is not finalized."""
    return plan.join(done.select("region"), "region", "left_anti").join(finalized.select("continent"), "continent", "left_anti")


def patch(plan: DataFrame, listed: DataFrame, stored: DataFrame) -> DataFrame:
    """(region, action): bake what is listed, drop what the store has beside it; ValueError for unplanned names."""
    missing = listed.join(plan.select("region"), "region", "left_anti").limit(5).collect()
    if missing:
        raise ValueError(f"not in the plan: {', '.join(r['region'] for r in missing)}")
    bake = plan.join(listed, "region", "left_semi").select("region", F.lit("bake").alias("action"))
    return bake.union(stored.select("region").distinct().join(listed, "region", "left_anti").select("region", F.lit("drop").alias("action")))


def gate(previous: DataFrame, new: DataFrame) -> DataFrame:
    """(missing, before, after, pass): archives the new index lacks, overlays aside, and tiles of both."""
    names = previous.filter(~F.col("name").startswith("overlay")).select("name").join(new.select("name"), "name", "left_anti")
    missing = names.agg(F.array_join(F.array_sort(F.collect_set("name")), " ").alias("missing"))
    tiles = lambda df, c: df.agg(F.coalesce(F.sum("tiles"), F.lit(0)).alias(c))
    both = missing.crossJoin(tiles(previous, "before")).crossJoin(tiles(new, "after"))
    return both.withColumn("passes", (F.col("missing") == "") & (F.col("after") * 10 >= F.col("before") * 9))


def garbage(published: DataFrame, previous: DataFrame, new: DataFrame) -> DataFrame:
    """Published files that neither index names."""
    keep = previous.select("file").union(new.select("file")).distinct()
    return published.select("file").distinct().join(keep, "file", "left_anti")


def projection(run: DataFrame, spent_total: float) -> DataFrame:
    """(seq, baked, left, need, checked) for a run whose time follows the bytes: the time the rest still needs.

    Nothing is said before a tenth is baked or when nothing is left.
    """
    total = run.agg(F.sum("bytes").alias("all"))
    each = run.crossJoin(F.broadcast(total)).withColumn("left", F.col("all") - F.col("baked"))
    spent = spent_total * F.col("baked") / F.col("all")
    checked = (F.col("left") > 0) & (F.col("baked") * 10 >= F.col("all"))
    return each.select("seq", "baked", "left", F.round(F.when(checked, spent * F.col("left") / F.col("baked")), 6).alias("need"), checked.alias("checked"))


def uncovered_land(points: DataFrame, most: int | None = None) -> DataFrame:
    """(cx, cy, n, lon, lat): points by one-degree cell, the smallest standing for its cell; all cells, or the most populous."""
    at = points.withColumns({"cx": F.floor("lon").cast("int"), "cy": F.floor("lat").cast("int")})
    first = F.min(F.struct("lon", "lat"))
    cells = at.groupBy("cx", "cy").agg(F.count("*").alias("n"), first.alias("p")).select("cx", "cy", "n", "p.lon", "p.lat").orderBy(F.desc("n"), "lon", "lat")
    return cells if most is None else cells.limit(most)


def plan_regions(candidates: DataFrame, cover: Cover, points: DataFrame, shapes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(region_id, continent, bytes, clip): chosen regions, largest first.

    A supplement, or what is added to a kept plan, is clipped to boxes around the points that it alone
    covers: no boxes at all mean that nothing is taken; null means the whole extract.
    """
    spark = shapes.sparkSession
    chosen = spark.createDataFrame([(int(c),) for c in cover.chosen], "shape_id int")
    own = candidates.filter("id IS NOT NULL").join(chosen, "shape_id", "left_semi")
    alone = own.groupBy("id").agg(F.count("*").alias("n"), F.min("shape_id").alias("shape_id")).filter("n = 1")
    boxes = coverage.clip_boxes(alone.join(points, "id").select("shape_id", "lon", "lat"), ["shape_id"])
    boxes = boxes.groupBy("shape_id").agg(F.array_sort(F.collect_list(F.array("w", "s", "e", "n"))).alias("boxes"))
    cut = F.col("kind") == "Supplement"
    if keep:
        cut = cut | ~F.col("region_id").isin(keep)
    clip = F.when(cut, F.coalesce("boxes", F.array().cast("array<array<double>>")))
    out = shapes.join(chosen, "shape_id", "left_semi").join(boxes, "shape_id", "left")
    return out.select("shape_id", "region_id", "continent", "bytes", clip.alias("clip")).orderBy(F.desc("bytes"), "shape_id")
