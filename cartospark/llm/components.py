"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id that each vertex of the edges reaches.

    Every step keeps at most one row per edge, and every group is only reduced to its minimum before
    it is joined back, so a vertex of very high degree needs no task of its own.
    Loops and repeated edges are allowed; edges with a null end are ignored.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    now = written(edges, "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: neighbours above u move to the smallest of u and its neighbours
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        # small star: neighbours below u, and u, move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        new = written(small, "edges")
        after = _state(new)
        dropped(now)
        done, now, state = after == state, new, after
        if done:
            break
    found = now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return found.union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)
