"""Merging overlapping extracts: first-wins dedup, counts, order and archive statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tilemath as M


def run_order(regions: DataFrame) -> DataFrame:
    """regions (continent, bytes, ..) with seq: continents by bytes, largest first, then regions by bytes."""
    total = regions.groupBy("continent").agg(F.sum("bytes").alias("_total"))
    order = Window.orderBy(F.desc("_total"), "continent", F.desc("bytes"), "region_id")
    return regions.join(F.broadcast(total), "continent").withColumn("seq", F.row_number().over(order)).drop("_total")


def first_wins(rows: DataFrame, keys: list[str], seq: str, ties: list[Column | str] | None = None) -> DataFrame:
    """One row per keys: that of the smallest seq, then by ties.  Partial minima meet in the shuffle; nothing is sorted."""
    rest = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(F.col(seq).alias("a"), *(t if isinstance(t, Column) else F.col(t) for t in ties or [])))
    return rows.groupBy(*keys).agg(first.alias("_first")).select(*keys, *(F.col("_first")[c].alias(c) for c in rest))


def merged(elements: DataFrame, regions: DataFrame) -> DataFrame:
    """elements (ext, x, y, kind, id) of overlapping extracts, once per continent: the first extract in run order.

    Continents never share elements; equal rows count once.  Place in the order and region (32 bits each) are one
    number, so its minimum is kept in hash maps, without a sort.
    """
    own = regions.select("ext", "continent", (F.shiftleft(F.col("seq").cast("long"), 32) + F.col("ext")).alias("_first"))
    first = elements.join(F.broadcast(own), "ext").groupBy("continent", "x", "y", "kind", "id").agg(F.min("_first").alias("_first"))
    kind = {c: regions.schema[c].dataType for c in ("ext", "seq")}
    return first.select("continent", "x", "y", "kind", "id", F.col("_first").bitwiseAND(F.lit((1 << 32) - 1)).cast(kind["ext"]).alias("ext"), F.shiftright("_first", 32).cast(kind["seq"]).alias("seq"))


def tile_counts(elements: DataFrame) -> DataFrame:
    """(x, y, nodes, ways, relations) per tile and what else keys the elements."""
    keys = [c for c in elements.columns if c in ("continent", "x", "y")]
    count = lambda kind: F.count_if(F.col("kind") == kind)
    return elements.groupBy(*keys).agg(count("node").alias("nodes"), count("way").alias("ways"), count("relation").alias("relations"))


def in_hilbert_order(tiles: DataFrame, parts: int | None = None) -> DataFrame:
    """tiles (continent, x, y, ..) with tile_id, in archive order: range-partitioned and sorted."""
    by = ["continent", "tile_id"]
    rows = tiles.withColumn("tile_id", M.hilbert_id("x", "y"))
    return (rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)).sortWithinPartitions(*by)


def archive_index(tiles: DataFrame) -> DataFrame:
    """Per continent: tiles, extent in degrees, distinct coverage cells, from distinct tiles (continent, x, y)."""
    return (
        tiles.groupBy("continent")
        .agg(F.count("*").alias("tiles"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.array_sort(F.collect_set(M.cell("x", "y"))).alias("cells"))
        .select(
            F.col("continent").alias("name"), "tiles", "cells", M.north(F.col("y1") + 1).alias("min_lat"), M.west("x0").alias("min_lon"), M.north("y0").alias("max_lat"), M.west(F.col("x1") + 1).alias("max_lon")
        )
    )
