"""Plan, bake, finalize and look into archives: the operations a user calls.

The store is a set of Parquet tables partitioned by continent and region.  A region is baked by one
dynamic partition overwrite and then marked done, so a run that breaks off leaves no half region: what
it wrote is overwritten when the region is baked again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import codec
from ..functions import tilemath as M
from ..operators import coverage, manifest, merge, setcover
from ..sources import pmtiles
from .bake import Bake, assembled
from .files import Files

ATTRIBUTION = "© OpenStreetMap contributors"
LEAST_FREE = 15_000_000_000


class DeadlineError(RuntimeError):
    """The rest of a run would not be done in time."""


@dataclass
class Engine:
    """work: the store and what is done; out: archives and their index.  Both may be any folder Spark reads and writes."""

    spark: SparkSession
    work: str
    out: str
    least_free: int = LEAST_FREE
    clock: Callable[[], float] = time.time

    @cached_property
    def files(self) -> Files:
        return Files(self.spark)

    # -- plan ------------------------------------------------------------------------------------

    def plan(self, points: DataFrame, rings: DataFrame, shapes: DataFrame, keep: list[str] | None = None, path: str | None = None) -> DataFrame:
        """The cheapest regions that cover all points: (shape_id, region_id, continent, bytes, clip), written as JSON.

        keep: regions of a published plan, chosen in any case; what is added then is clipped.
        """
        raw = coverage.point_in_polygon(points, rings).withColumnRenamed("ext", "shape_id")
        inside = self._kept("inside", coverage.effective(raw, shapes))
        candidates = self._kept("candidates", coverage.cover_candidates(points, inside, shapes, keep))
        cover = setcover.solve(candidates, shapes)
        regions = manifest.plan_regions(candidates, cover, points, shapes, keep)
        covered = candidates.filter(F.col("id").isNotNull() & F.col("shape_id").isin(cover.chosen)).select("id").distinct()
        bare = manifest.uncovered_land(points.join(covered, "id", "left_anti"))
        rows = [r.asDict() for r in regions.collect()]
        cells = [[r["lon"], r["lat"], r["n"]] for r in bare.collect()]
        total = points.count()
        found = {
            "zoom": S.ZOOM, "regions": rows, "total_bytes": sum(r["bytes"] for r in rows), "land_points": total,
            "uncovered_points": sum(c[2] for c in cells), "covered_points": total, "uncovered_land": cells,
        }
        self.files.write_json(path or f"{self.work}/plan.json", found)
        self.files.delete(f"{self.work}/planning")
        return self.spark.createDataFrame([tuple(r.values()) for r in rows], "shape_id int, region_id string, continent string, bytes long, clip array<array<double>>")

    def _kept(self, name: str, df: DataFrame) -> DataFrame:
        """df as a table of the plan under way: lineage ends here, and a lost executor costs a read."""
        path = f"{self.work}/planning/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def load_plan(self, path: str | None = None) -> DataFrame:
        rows = self.files.read_json(path or f"{self.work}/plan.json")["regions"]
        return self.spark.createDataFrame([tuple(r[k] for k in ("shape_id", "region_id", "continent", "bytes", "clip")) for r in rows], "shape_id int, region_id string, continent string, bytes long, clip array<array<double>>")

    # -- run -------------------------------------------------------------------------------------

    def run(self, plan: DataFrame, inputs: Callable[[DataFrame], Bake], only: list[str] | None = None, finish_by: float | None = None) -> list[str]:
        """Bake what is to do, of all regions or only some, in run order; publish a continent once all its regions are baked.

        inputs(regions) gives the dataflow of some regions (ext, region_id, continent, bytes, clip, seq).
        """
        ordered = merge.run_order(plan.withColumn("ext", F.col("shape_id")))
        chosen = ordered if only is None else ordered.filter(F.col("region_id").isin(only))
        todo = manifest.todo(chosen.withColumn("region", F.col("region_id")), self.done(), self.finalized(ordered)).orderBy("seq").collect()
        started, baked, left = self.clock(), 0, sum(r["bytes"] for r in todo)
        published = []
        finished = {r["region"] for r in self.done().select("region").collect()}
        regions: dict[str, set] = {}
        for r in ordered.select("region_id", "continent").collect():
            regions.setdefault(r["continent"], set()).add(r["region_id"])
        for r in todo:
            self._check_space()
            self.bake(inputs(ordered.filter(F.col("region_id") == r["region_id"])), r)
            baked, left = baked + r["bytes"], left - r["bytes"]
            if finish_by is not None and left > 0 and baked * 10 >= baked + left:
                need = (self.clock() - started) * left / baked
                if self.clock() + need > finish_by:
                    raise DeadlineError(f"{left} bytes are left and need {need:.0f} s; the deadline is {finish_by - self.clock():.0f} s away")
            finished.add(r["region_id"])
            if regions[r["continent"]] <= finished:
                published.append(self.publish(plan, r["continent"], sorted(regions[r["continent"]])))
        return [p for p in published if p]

    def bake(self, flow: Bake, region) -> None:
        """Bake one region into the store and mark it done; its rows replace earlier ones."""
        where = {"continent": F.lit(region["continent"]), "region": F.lit(region["region_id"])}
        flow.hold()
        for name, df in (("chunk", flow.chunks().drop("ext")), ("record", flow.records().drop("ext"))):
            df.withColumns(where).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("continent", "region").parquet(f"{self.work}/store/{name}")
        flow.release()
        counts = self._stored_sizes(region["continent"], region["region_id"])
        mark = [(region["region_id"], region["continent"], int(region["bytes"]), *counts, stamp_of(self.clock()))]
        done = self.spark.createDataFrame(mark, "region string, continent string, bytes long, slices long, tiles long, payload_bytes long, finished_at string")
        done.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region").parquet(f"{self.work}/done")

    def _stored_sizes(self, continent: str, region: str) -> tuple[int, int, int]:
        """Of what a region has in the store: elements in tiles; tiles and records; and bytes of their payloads."""
        own = lambda name: self.stored(name).filter((F.col("continent") == continent) & (F.col("region") == region))
        elements = own("chunk").count()
        tiles = assembled(own("chunk"), ["x", "y"]).select("nodes", "ways", "relations")
        records = codec.with_payload(tiles.union(self._records(own("record").withColumn("seq", F.lit(0))).drop("relation_id")), S.SCRATCH_LEVEL)
        sizes = records.agg(F.count("*"), F.coalesce(F.sum("raw_bytes"), F.lit(0))).first()
        return elements, sizes[0], sizes[1]

    def stored(self, name: str) -> DataFrame:
        if name == "record":
            schema = "relation_id long, relation " + S.RELATION.simpleString() + ", way " + S.WAY.simpleString() + ", continent string, region string"
        else:
            schema = "kind string, id long, x int, y int, node " + S.NODE.simpleString() + ", way " + S.WAY.simpleString() + ", relation " + S.RELATION.simpleString() + ", continent string, region string"
        return self._table(f"{self.work}/store/{name}", schema)

    def done(self) -> DataFrame:
        return self._table(f"{self.work}/done", "continent string, bytes long, slices long, tiles long, payload_bytes long, finished_at string, region string")

    def finalized(self, plan: DataFrame) -> DataFrame:
        """Continents published with every region the plan has for them; a larger plan opens them again."""
        marks = {c: set(r) for c, r in self.files.read_json(f"{self.work}/finalized.json", {}).items()}
        want: dict[str, set] = {}
        for r in plan.select("continent", "region_id").collect():
            want.setdefault(r["continent"], set()).add(r["region_id"])
        return self.spark.createDataFrame([(c,) for c, regions in want.items() if c in marks and regions <= marks[c]], "continent string")

    # -- finalize --------------------------------------------------------------------------------

    def tiles(self, plan: DataFrame, continent: str) -> DataFrame:
        """(x, y, nodes, ways, relations): a continent's merged tiles; the first region in run order wins."""
        order = merge.run_order(plan).select(F.col("region_id").alias("region"), "seq")
        rows = self.stored("chunk").filter(F.col("continent") == continent).drop("continent").join(F.broadcast(order), "region")
        return assembled(merge.first_wins(rows, ["x", "y", "kind", "id"], "seq", ["region"]), ["x", "y"])

    def whole_relations(self, plan: DataFrame, continent: str) -> DataFrame:
        """(relation_id, nodes, ways, relations): a continent's whole relations with their member ways."""
        order = merge.run_order(plan).select(F.col("region_id").alias("region"), "seq")
        return self._records(self.stored("record").filter(F.col("continent") == continent).join(F.broadcast(order), "region"))

    @staticmethod
    def _records(rows: DataFrame) -> DataFrame:
        """(relation_id, nodes, ways, relations) of stored rows with seq; of copies the first counts."""
        rows = rows.withColumn("way_id", F.col("way.id"))
        ways = merge.first_wins(rows.select("relation_id", "way_id", "way", "seq"), ["relation_id", "way_id"], "seq").groupBy("relation_id").agg(F.array_sort(F.collect_list(F.struct("way_id", "way"))).alias("w"))
        own = merge.first_wins(rows.select("relation_id", "relation", "seq"), ["relation_id"], "seq")
        none = F.array().cast(f"array<{S.NODE.simpleString()}>")
        return own.join(ways, "relation_id").select("relation_id", none.alias("nodes"), F.col("w.way").alias("ways"), F.array("relation").alias("relations"))

    def publish(self, plan: DataFrame, continent: str, regions: list[str] | None = None, name: str | None = None) -> str | None:
        """Write a continent's archive and the index, then give the store back; the file's name, or none if there are no tiles."""
        tiles = self.tiles(plan, continent).filter(~codec.is_empty()).withColumn("tile_id", M.hilbert_id("x", "y"))
        frames = codec.with_payload(tiles).persist()
        extent = merge.archive_index(frames.withColumn("continent", F.lit(continent))).collect()
        if not extent:
            frames.unpersist()
            return None
        records = codec.with_payload(self.whole_relations(plan, continent).withColumn("tile_id", F.col("relation_id") + S.RELATION_BASE))
        stamp = stamp_of(self.clock())
        file = f"{name or continent}-{stamp}.pmtiles"
        # tiles in Hilbert order, records after them: their ids lie above all of zoom 13
        size = pmtiles.write(self.files, f"{self.out}/{file}", [frames, records], {"attribution": ATTRIBUTION})
        frames.unpersist()
        e = extent[0]
        entry = {
            "name": name or continent, "file": file, "built": stamp[:8], "tiles": e["tiles"], "bytes": size, "cells": list(e["cells"]),
            "min_lat": e["min_lat"], "min_lon": e["min_lon"], "max_lat": e["max_lat"], "max_lon": e["max_lon"],
        }
        self._index(entry)
        if name is None:
            marks = self.files.read_json(f"{self.work}/finalized.json", {})
            marks[continent] = sorted(set(marks.get(continent, [])) | set(regions or []))
            self.files.write_json(f"{self.work}/finalized.json", marks)
            for table in ("chunk", "record"):
                self.files.delete(f"{self.work}/store/{table}/continent={continent}")
        return file

    def finalize(self, plan: DataFrame) -> list[str]:
        """Publish every continent that the store still holds."""
        held = self.stored("chunk").select("continent", "region").distinct().collect()
        by = {c: sorted(r["region"] for r in held if r["continent"] == c) for c in sorted({r["continent"] for r in held})}
        return [f for f in (self.publish(plan, c, regions) for c, regions in by.items()) if f]

    def _index(self, entry: dict) -> None:
        old = self.files.read_json(f"{self.work}/manifest.json", [])
        entries = sorted([*(e for e in old if e["name"] != entry["name"]), entry], key=lambda e: e["name"])
        self.files.write_json(f"{self.work}/manifest.json", entries)
        self.files.write_json(f"{self.out}/archives.json", {"zoom": S.ZOOM, "format": "AOT2+zstd", "cell_zoom": S.CELL_ZOOM, "attribution": ATTRIBUTION, "archives": entries})

    # -- the rest --------------------------------------------------------------------------------

    def patch(self, plan: DataFrame, inputs: Callable[[DataFrame], Bake], regions: list[str], name: str = "overlay") -> str | None:
        """Bake listed regions on their own and publish them as an overlay; ValueError for unplanned names."""
        listed = self.spark.createDataFrame([(r,) for r in regions], "region string")
        named = plan.withColumn("region", F.col("region_id"))
        manifest.patch(named, listed, self.done()).count()
        own = Engine(self.spark, f"{self.work}/{name}", self.out, self.least_free, self.clock)
        flat = merge.run_order(plan).withColumn("ext", F.col("shape_id")).filter(F.col("region_id").isin(regions)).withColumn("continent", F.lit(name))
        self.files.delete(own.work)
        for r in flat.collect():
            own.bake(inputs(flat.filter(F.col("region_id") == r["region_id"])), r)
        file = own.publish(flat.drop("ext", "seq"), name, regions, name=name)
        for e in own.files.read_json(f"{own.work}/manifest.json", []):
            self._index(e)
        return file

    def status(self) -> DataFrame:
        return manifest.status(self.done())

    def reset(self, continent: str | None = None) -> None:
        """Forget the store, what is done and what is published of one continent, or of all."""
        marks = self.files.read_json(f"{self.work}/finalized.json", {})
        gone = [continent] if continent else sorted({*marks, *(r[0] for r in self.done().select("continent").distinct().collect())})
        for c in gone:
            marks.pop(c, None)
            for table in ("chunk", "record"):
                self.files.delete(f"{self.work}/store/{table}/continent={c}")
            for r in self.done().filter(F.col("continent") == c).select("region").collect():
                self.files.delete(f"{self.work}/done/region={r['region']}")
        self.files.write_json(f"{self.work}/finalized.json", marks)

    def inspect(self, x: int, y: int) -> DataFrame:
        """(continent, region, nodes, ways, relations) that the store holds of one tile, in every continent."""
        own = self.stored("chunk").filter((F.col("x") == x) & (F.col("y") == y))
        count = lambda k: F.count_if(F.col("kind") == k)
        return own.groupBy("continent", "region").agg(count("node").alias("nodes"), count("way").alias("ways"), count("relation").alias("relations"))

    def cells(self) -> list[dict]:
        """Coverage cells of published archives from their directories alone, put into the index."""
        entries = self.files.read_json(f"{self.work}/manifest.json", [])
        path = {e["name"]: f"{self.out}/{e['file']}" for e in entries}
        found = pmtiles.covered_cells(pmtiles.read_leaves(self.spark, self.files, sorted(path.values()))).collect() if entries else []
        for e in entries:
            e["cells"] = sorted(r["cell"] for r in found if r["path"] == path[e["name"]])
        for e in entries:
            self._index(e)
        return entries

    def _check_space(self) -> None:
        if self.files.free(self.work) < self.least_free:
            raise OSError("too little disk space is free")

    def _table(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path) if self.files.exists(path) else self.spark.createDataFrame([], schema)


def stamp_of(seconds: float) -> str:
    """UTC stamp of an archive's name."""
    return time.strftime("%Y%m%d-%H%M%S", time.gmtime(seconds))
