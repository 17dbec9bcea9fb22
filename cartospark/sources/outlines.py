"""Outlines of extracts and land: GeoJSON indexes, .poly texts and ESRI shapefiles as rings of points."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_POSITION = "array<double>"
FEATURES = (
    "features array<struct<properties: struct<id: string, parent: string, name: string, urls: map<string, string>>, "
    "geometry: struct<type: string, coordinates: string>>>"
)


def geojson_index(texts: DataFrame, column: str = "value") -> DataFrame:
    """(id, name, parent, url, type, coordinates, place) of each feature of index texts; place: its number in the text."""
    each = texts.select(F.posexplode(F.from_json(column, FEATURES)["features"]).alias("place", "f"))
    return each.select("f.properties.id", "f.properties.name", "f.properties.parent", F.col("f.properties.urls")["pbf"].alias("url"), "f.geometry.type", "f.geometry.coordinates", "place")


def geojson_rings(index: DataFrame) -> DataFrame:
    """(id, ring, pos, lon, lat): rings of polygons, and of every part of multi-polygons; below 3 points dropped."""
    one, many = f"array<array<{_POSITION}>>", f"array<array<array<{_POSITION}>>>"
    rings = F.when(F.col("type") == "Polygon", F.from_json("coordinates", one)).otherwise(F.flatten(F.from_json("coordinates", many)))
    each = index.select("id", F.posexplode(F.filter(rings, lambda r: F.size(r) >= 3)).alias("ring", "points"))
    return each.select("id", "ring", F.posexplode("points").alias("pos", "p")).select("id", "ring", "pos", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))


def read_geojson_index(spark: SparkSession, path: str) -> DataFrame:
    return geojson_index(spark.read.text(path, wholetext=True))


def poly_rings(texts: DataFrame, key: str = "path", column: str = "value") -> DataFrame:
    """(key, ring, pos, lon, lat) of .poly texts: sections after the name line, each closed by END.

    A section is everything between its head and the next END, so sections are numbered by the ENDs
    before a line; holes are rings like others, unreadable lines are skipped, rings below 3 points dropped.
    """
    lines = F.transform(F.split(column, "\r?\n"), lambda line: F.trim(F.regexp_replace(line, r"\s+", " ")))
    body = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    # fold: (section number, inside?, rows) over the lines
    start = F.struct(F.lit(0).alias("ring"), F.lit(False).alias("open"), F.array().cast("array<struct<ring: int, lon: double, lat: double>>").alias("rows"))

    def step(s, line):
        part = F.split(line, " ")
        lon, lat = F.get(part, F.lit(0)).try_cast("double"), F.get(part, F.lit(1)).try_cast("double")
        row = F.when(lon.isNotNull() & lat.isNotNull(), F.array(F.struct(s["ring"].alias("ring"), lon.alias("lon"), lat.alias("lat")))).otherwise(F.array().cast("array<struct<ring: int, lon: double, lat: double>>"))
        head = ~s["open"] & (line != "") & (line != "END")
        ends = s["open"] & (line == "END")
        return F.struct(
            (s["ring"] + F.when(ends, 1).otherwise(0)).alias("ring"),
            F.when(head, True).when(ends, False).otherwise(s["open"]).alias("open"),
            F.when(s["open"] & ~ends, F.concat(s["rows"], row)).otherwise(s["rows"]).alias("rows"),
        )

    rows = texts.select(key, F.posexplode(F.aggregate(body, start, step, lambda s: s["rows"])).alias("at", "r")).select(key, "at", "r.ring", "r.lon", "r.lat")
    ring = Window.partitionBy(key, "ring")
    numbered = rows.withColumns({"pos": F.row_number().over(ring.orderBy("at")) - 1, "n": F.count("*").over(ring)})
    return numbered.filter("n >= 3").select(key, "ring", "pos", "lon", "lat")


def parse_shapefile(raw: bytes) -> list[list[np.ndarray]]:
    """Polygon records, each as rings of (lon, lat); ValueError if it is no shapefile or is cut."""
    if len(raw) < 100 or struct.unpack(">i", raw[:4])[0] != 9994:
        raise ValueError("not a shapefile")
    records, at = [], 100
    while at + 8 <= len(raw):
        size = 2 * struct.unpack(">i", raw[at + 4 : at + 8])[0]
        body = raw[at + 8 : at + 8 + size]
        if len(body) < size:
            raise ValueError("the shapefile is cut")
        at += 8 + size
        if size < 44 or struct.unpack("<i", body[:4])[0] not in (5, 15, 25):
            continue
        parts, points = struct.unpack("<ii", body[36:44])
        if 44 + 4 * parts + 16 * points > size:
            raise ValueError("a record names more points than it has")
        starts = np.frombuffer(body, "<i4", parts, 44)
        xy = np.frombuffer(body, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
        records.append([ring for ring in np.split(xy, starts[1:]) if len(ring) >= 3] if parts else [])
    return records


def shapefile_rings(files: DataFrame) -> DataFrame:
    """(path, rec, ring, pos, lon, lat) of shapefiles read by format("binaryFile")."""
    schema = pa.schema([("path", pa.string()), ("rec", pa.int32()), ("ring", pa.int32()), ("pos", pa.int32()), ("lon", pa.float64()), ("lat", pa.float64())])

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for rec, rings in enumerate(parse_shapefile(content)):
                    for k, ring in enumerate(rings):
                        n = len(ring)
                        yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([rec] * n, pa.int32()), pa.array([k] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(ring[:, 0]), pa.array(ring[:, 1])], schema=schema)

    return files.select("path", "content").mapInArrow(run, "path string, rec int, ring int, pos int, lon double, lat double")


def local_name(url):
    """The flat file name of a url: what follows "://", with separators replaced."""
    return F.regexp_replace(F.regexp_replace(url, r"(?s)^.*?://", ""), r"[/\\:]", "_")


def shapefile_bytes(records: list[list[list[tuple[float, float]]]]) -> bytes:
    """A polygon shapefile of records of rings, for fixtures and tests."""
    body = b""
    for k, rings in enumerate(records):
        starts = np.cumsum([0, *(len(r) for r in rings)])
        points = [p for r in rings for p in r]
        content = struct.pack("<i4dii", 5, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts[:-1].tolist())
        content += b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">ii", k + 1, len(content) // 2) + content
    return struct.pack(">i20xi", 9994, (100 + len(body)) // 2) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8) + body
