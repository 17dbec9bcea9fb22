"""The bake as one dataflow over all regions, keyed by region (ext)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import geometry as G
from ..operators import merge
from ..schemas import TILES
from .stored import Stored


@dataclass
class Bake:
    """Inputs, each with ext: nodes (id, lat, lon, tags), ways (id, tags), refs (way_id, pos, node_id),
    relations (id, tags); members (relation_id, pos, way_id, role); clips (w, s, e, n) or none; regions (continent, seq)."""

    nodes: DataFrame
    ways: DataFrame
    refs: DataFrame
    relations: DataFrame
    members: DataFrame
    regions: DataFrame
    clips: DataFrame | None = None

    @cached_property
    def pois(self) -> DataFrame:
        return G.kept_nodes(self.nodes)

    @cached_property
    def kept_relations(self) -> DataFrame:
        return G.kept_relations(self.relations, self.members)

    @cached_property
    def kept_ways(self) -> DataFrame:
        return G.kept_ways(self.ways, self.kept_relations)

    @cached_property
    def geometry(self) -> DataFrame:
        """Geometry of kept ways alone: the others' references never meet the nodes."""
        kept = self.kept_ways.select("ext", F.col("id").alias("way_id"))
        return G.way_geometry(self.refs.join(kept.hint("merge"), ["ext", "way_id"], "left_semi"), self.nodes)

    @cached_property
    def way_tiles(self) -> DataFrame:
        return G.way_tiles(self.geometry)

    @cached_property
    def relation_tiles(self) -> DataFrame:
        return G.relation_tiles(self.kept_relations, self.way_tiles)

    @cached_property
    def whole_relations(self) -> DataFrame:
        return G.whole_relations(self.kept_relations, self.relation_tiles, self.geometry.select("ext", "way_id"), self.clips)

    @cached_property
    def elements(self) -> DataFrame:
        """(ext, x, y, kind, id) of everything a tile holds, after clipping."""
        rows = (
            self.pois.select("ext", "x", "y", F.lit("node").alias("kind"), "id")
            .union(self.way_tiles.select("ext", "x", "y", F.lit("way"), "way_id"))
            .union(self.relation_tiles.select("ext", "x", "y", F.lit("relation"), "relation_id"))
        )
        return G.clipped(rows, self.clips)

    @cached_property
    def merged(self) -> DataFrame:
        """(continent, x, y, kind, id, ext, seq): one row per element and tile, with the region it is taken from."""
        rows = self.pois.select("ext", "x", "y", F.lit("node").alias("kind"), "id").union(G.touching(self.kept_relations, self.way_tiles))
        return merge.merged(G.clipped(rows, self.clips), self.regions)

    def hold(self) -> None:
        """Keep geometry, tiles of ways and kept relations for the several tables that are made of them, until release()."""
        for name in ("geometry", "way_tiles", "kept_relations"):
            self.__dict__[name] = getattr(self, name).persist()

    def release(self) -> None:
        for name in ("geometry", "way_tiles", "kept_relations"):
            self.__dict__[name].unpersist()

    def stats(self) -> DataFrame:
        """(ext, pois, ways, relations, records): what a region contributes, before clipping but for records."""
        count = lambda df, name: df.groupBy("ext").agg(F.count("*").alias(name))
        out = self.regions.select("ext")
        for df, name in (
            (self.pois, "pois"),
            (self.geometry, "ways"),
            (self.relation_tiles.select("ext", "relation_id").distinct(), "relations"),
            (self.whole_relations, "records"),
        ):
            out = out.join(count(df, name), "ext", "left")
        return out.na.fill(0)

    @cached_property
    def payloads(self) -> DataFrame:
        """(ext, kind, id, node, way, relation): what is stored of each element, one of the three not null."""
        tags = F.col("tags")
        none = F.lit(None)
        node = self.pois.select("ext", F.lit("node").alias("kind"), "id", F.struct("id", "lat_q", "lon_q", tags).alias("node"), none.alias("way"), none.alias("relation"))
        way = self.geometry.withColumnRenamed("way_id", "id").join(self.kept_ways.select("ext", "id", "tags").hint("merge"), ["ext", "id"])
        way = way.select("ext", F.lit("way").alias("kind"), "id", none.alias("node"), F.struct("id", "closed", tags, "points").alias("way"), none.alias("relation"))
        relation = self.kept_relations.select("ext", F.lit("relation").alias("kind"), "id", none.alias("node"), none.alias("way"), F.struct("id", tags, "members").alias("relation"))
        return node.union(way).union(relation)

    def chunks(self) -> DataFrame:
        """(ext, x, y, kind, id, node, way, relation): the clipped elements of each region with their payloads."""
        return self.elements.join(self.payloads.hint("merge"), ["ext", "kind", "id"])

    def records(self) -> DataFrame:
        """(ext, relation_id, relation, way): whole relations over several tiles, a row for each member way."""
        each = self.whole_relations.select("ext", "relation_id", F.explode("ways").alias("id"))
        ways = self.payloads.filter("kind = 'way'").select("ext", "id", "way")
        relations = self.payloads.filter("kind = 'relation'").select("ext", F.col("id").alias("relation_id"), "relation")
        return each.join(ways, ["ext", "id"]).join(relations, ["ext", "relation_id"]).select("ext", "relation_id", "relation", "way")

    def tile_rows(self) -> DataFrame:
        """(continent, x, y, kind, id, node, way, relation): the elements of merged tiles, a row for each.

        Payload columns join once, after the dedup has chosen a region for each element.
        """
        return self.merged.join(self.payloads.hint("merge"), ["ext", "kind", "id"]).select("continent", "x", "y", "kind", "id", "node", "way", "relation")

    def tile_strings(self) -> DataFrame:
        """(continent, x, y, s): every use of a string by an element of a merged tile, from tags and roles alone."""
        of_tags = F.flatten(F.transform("tags", lambda t: F.array(t["k"], t["v"])))
        node = self.pois.select("ext", F.lit("node").alias("kind"), "id", of_tags.alias("strings"))
        way = self.kept_ways.select("ext", F.lit("way"), "id", of_tags)
        relation = self.kept_relations.select("ext", F.lit("relation"), "id", F.concat(of_tags, F.col("members.role")))
        strings = node.union(way).union(relation).filter(F.size("strings") > 0)
        return self.merged.join(strings.hint("merge"), ["ext", "kind", "id"]).select("continent", "x", "y", F.explode("strings").alias("s"))

    def packed(self, store: Stored) -> DataFrame:
        """(continent, first, rank, id, closed, words, places, refs, tiles): each region's elements, once with all their tiles.

        For ``functions.packed``, which merges them by tile: what a continent's elements are made of is written a
        continent at a time, so no more than one continent's shuffles are on disk, and none has a row for each tile of a way.
        """
        runs = self.regions.select("ext", "continent", (F.shiftleft(F.col("seq").cast("long"), 32) + F.col("ext")).alias("first"))
        of: dict[str, list[int]] = {}
        for r in runs.collect():  # a row per region
            of.setdefault(r["continent"], []).append(r["ext"])
        inputs = replace(self, refs=store.kept(self.refs, "refs"), ways=store.kept(self.ways, "ways"))
        held = store.kept(self.kept_relations, "relations")
        named = lambda df: df.join(F.broadcast(runs), "ext")

        def of_region(exts: list[int]) -> Bake:
            own = lambda df: df.filter(F.col("ext").isin(exts))
            bake = replace(inputs, nodes=own(inputs.nodes), ways=own(inputs.ways), refs=own(inputs.refs))
            bake.__dict__["kept_relations"] = own(held)
            return bake

        parts = []
        with ThreadPoolExecutor(1) as beside:  # nodes need few cores and little disk
            nodes = [beside.submit(store.kept, of_region(exts)._packed_nodes(named), f"{k}/nodes") for k, exts in enumerate(of.values())]
            for k, exts in enumerate(of.values()):
                bake = of_region(exts)
                way = store.kept(named(bake._packed_ways()), f"{k}/ways")
                parts += [way.drop("ext"), store.kept(named(bake._packed_relations(way)).drop("ext"), f"{k}/relations")]
            parts += [n.result() for n in nodes]
        for name in ("refs", "ways", "relations"):
            store.drop(name)
        store.released()
        return reduce(DataFrame.unionByName, parts)

    def _packed_nodes(self, named) -> DataFrame:
        """Nodes are already one for each id and tile: they are many times in overlapping regions, and small."""
        rows = named(self.pois.select("ext", "id", "x", "y", _words("tags").alias("words"), F.array("lat_q", "lon_q").alias("places")))
        rows = merge.first_wins(rows.select("continent", "id", "x", "y", "first", "words", "places"), ["continent", "id", "x", "y"], "first")
        return rows.select("continent", "first", *_packed(0, "id", places=F.col("places"), words=F.col("words")), F.array(_code("x", "y")).alias("tiles"))

    def _packed_ways(self) -> DataFrame:
        """Ways and their tiles in one pass over the geometry; ways that are not kept fall out where the tags are met."""
        tags = self.kept_ways.select("ext", F.col("id").alias("way_id"), "tags").hint("merge")
        ways = G.way_geometry(self.refs, self.nodes).join(tags, ["ext", "way_id"])
        places = F.flatten(F.transform("points", lambda p: F.array(p["lat_q"], p["lon_q"])))
        codes = F.transform(G.tiles_of("points"), lambda t: _code(t["x"], t["y"]))
        return ways.select("ext", *_packed(1, "way_id", closed=F.col("closed"), places=places, words=_words("tags")), codes.alias("tiles"))

    def _packed_relations(self, ways: DataFrame) -> DataFrame:
        """Relations lie where their ways do."""
        relations = self.kept_relations
        member = relations.select("ext", F.col("id").alias("relation_id"), F.explode("members.way_id").alias("id")).distinct()
        tiles = member.hint("merge").join(ways.select("ext", "id", "tiles").hint("merge"), ["ext", "id"]).select("ext", F.col("relation_id").alias("id"), "tiles")
        tiles = tiles.groupBy("ext", "id").agg(F.array_distinct(F.flatten(F.collect_list("tiles"))).alias("tiles"))
        return tiles.join(relations.hint("merge"), ["ext", "id"]).select("ext", *_packed(2, "id", words=_words("tags", F.col("members.role")), refs=F.col("members.way_id")), "tiles")

    def tiles(self) -> DataFrame:
        """(continent, x, y, nodes, ways, relations): merged tiles with elements in order of id, for tiles that fit a task."""
        return assembled(self.tile_rows(), ["continent", "x", "y"])


def _words(tags: str, *more):
    return F.to_json(F.concat(F.flatten(F.transform(tags, lambda t: F.array(t["k"], t["v"]))), *more))


def _code(x, y):
    """A tile as one number."""
    return ((F.col(x) if isinstance(x, str) else x) * F.lit(TILES) + (F.col(y) if isinstance(y, str) else y)).cast("int")


def _packed(rank: int, id: str, closed=None, words=None, places=None, refs=None) -> list:
    none = lambda kind: F.array().cast(f"array<{kind}>")
    given = [F.lit(False) if closed is None else closed, words, none("int") if places is None else places, none("long") if refs is None else refs]
    return [F.lit(rank).alias("rank"), F.col(id).alias("id"), *(c.alias(n) for c, n in zip(given, ("closed", "words", "places", "refs"), strict=True))]


def by_id(column: str):
    """The elements of a group in order of id; nulls are left out."""
    order = lambda a, b: F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)
    return F.array_sort(F.collect_list(column), order)


def assembled(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(by_id("node").alias("nodes"), by_id("way").alias("ways"), by_id("relation").alias("relations"))
