"""The binary payload of one tile, and zstandard frames around it.

A payload is a magic word, the tile's distinct strings in the order of first use, then nodes, ways and
relations as differences from the element before.  Whole numbers are little-endian groups of seven
bits; signed ones interleave positive and negative.  Elements are dicts like the rows of ``schemas.TILE``.
"""

from __future__ import annotations

from collections.abc import Iterator

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

MAGIC = b"AOT2"
#: More than this is no tile.
MOST_STRINGS, MOST_TAGS, MOST_POINTS, MOST_MEMBERS = 1 << 24, 1 << 16, 1 << 22, 1 << 20

#: Elements that are unfolded at once, and tiles and bytes of frames that are handed on together.
SOME, MOST_BYTES = 1000, 1 << 22


class PayloadError(ValueError):
    """Not a payload, or one that is cut or damaged."""


class Writer:
    """Collects the body while it numbers the strings."""

    def __init__(self) -> None:
        self.body = bytearray()
        self.strings: dict[str, int] = {}

    def unsigned(self, n: int) -> None:
        while n > 127:
            self.body.append(n & 127 | 128)
            n >>= 7
        self.body.append(n)

    def signed(self, n: int) -> None:
        self.unsigned(2 * n if n >= 0 else -2 * n - 1)

    def string(self, text: str) -> None:
        self.unsigned(self.strings.setdefault(text, len(self.strings)))

    def tags(self, tags) -> None:
        self.unsigned(len(tags))
        for tag in tags:
            self.string(tag["k"])
            self.string(tag["v"])

    def path(self, values: Iterator[tuple[int, ...]]) -> None:
        """Tuples of numbers, each as differences from the last."""
        last: tuple[int, ...] | None = None
        for value in values:
            for k, v in enumerate(value):
                self.signed(v - (last[k] if last else 0))
            last = value

    def payload(self) -> bytes:
        head = Writer()
        head.unsigned(len(self.strings))
        for text in self.strings:
            raw = text.encode()
            head.unsigned(len(raw))
            head.body += raw
        return MAGIC + bytes(head.body) + bytes(self.body)


class Encoder:
    """A tile's payload, element by element: all nodes, then ways, then relations.  Only encoded bytes and the strings are kept."""

    KINDS = ("node", "way", "relation")

    def __init__(self) -> None:
        self.out = Writer()
        self.count, self.bodies = [0, 0, 0], [bytearray(), bytearray(), bytearray()]
        self.last = [(0, 0, 0), 0, 0]

    def add(self, rank: int, e: dict) -> None:
        self.out.body = self.bodies[rank]
        self.count[rank] += 1
        (self._node, self._way, self._relation)[rank](e)

    def _node(self, node: dict) -> None:
        now = (node["id"], node["lat_q"], node["lon_q"])
        for a, b in zip(now, self.last[0], strict=True):
            self.out.signed(a - b)
        self.last[0] = now
        self.out.tags(node["tags"])

    def _way(self, way: dict) -> None:
        self.out.signed(way["id"] - self.last[1])
        self.last[1] = way["id"]
        self.out.body.append(bool(way["closed"]))
        self.out.tags(way["tags"])
        self.out.unsigned(len(way["points"]))
        self.out.path((p["lat_q"], p["lon_q"]) for p in way["points"])

    def _relation(self, relation: dict) -> None:
        self.out.signed(relation["id"] - self.last[2])
        self.last[2] = relation["id"]
        self.out.tags(relation["tags"])
        self.out.unsigned(len(relation["members"]))
        last_member = 0
        for member in relation["members"]:
            self.out.signed(member["way_id"] - last_member)
            last_member = member["way_id"]
            self.out.string(member["role"])

    def payload(self) -> bytes:
        self.out.body = bytearray()
        for count, body in zip(self.count, self.bodies, strict=True):
            self.out.unsigned(count)
            self.out.body += body
        return self.out.payload()


def encode(tile: dict) -> bytes:
    out = Encoder()
    for rank, kind in enumerate(("nodes", "ways", "relations")):
        for element in tile.get(kind) or []:
            out.add(rank, element)
    return out.payload()


class Reader:
    def __init__(self, raw: bytes) -> None:
        self.raw, self.at, self.strings = raw, 0, []

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.raw):
            raise PayloadError("cut short")
        self.at += n
        return self.raw[self.at - n : self.at]

    def unsigned(self) -> int:
        value = shift = 0
        while True:
            if shift >= 64:
                raise PayloadError("number too long")
            byte = self.take(1)[0]
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    def signed(self) -> int:
        n = self.unsigned()
        return n // 2 if n % 2 == 0 else -(n // 2) - 1

    def count(self, most: int, what: str) -> int:
        n = self.unsigned()
        if n > most:
            raise PayloadError(f"too many {what}")
        return n

    def string(self) -> str:
        n = self.unsigned()
        if n >= len(self.strings):
            raise PayloadError("no such string")
        return self.strings[n]

    def tags(self) -> list[dict]:
        return [{"k": self.string(), "v": self.string()} for _ in range(self.count(MOST_TAGS, "tags"))]

    def table(self) -> None:
        for _ in range(self.count(MOST_STRINGS, "strings")):
            try:
                self.strings.append(self.take(self.unsigned()).decode())
            except UnicodeDecodeError as e:
                raise PayloadError("not text") from e


def decoded(raw: bytes) -> Iterator[tuple[int, dict]]:
    """(rank, element) of a payload, one after the other; PayloadError if it is none."""
    if raw[: len(MAGIC)] != MAGIC:
        raise PayloadError("another format")
    src = Reader(bytes(raw))
    src.at = len(MAGIC)
    src.table()
    now = [0, 0, 0]
    for _ in range(src.unsigned()):
        now = [v + src.signed() for v in now]
        yield 0, {"id": now[0], "lat_q": now[1], "lon_q": now[2], "tags": src.tags()}
    ident = 0
    for _ in range(src.unsigned()):
        ident += src.signed()
        closed, tags = src.take(1)[0] != 0, src.tags()
        points, lat, lon = [], 0, 0
        for _ in range(src.count(MOST_POINTS, "points")):
            lat, lon = lat + src.signed(), lon + src.signed()
            points.append({"lat_q": lat, "lon_q": lon})
        yield 1, {"id": ident, "closed": closed, "tags": tags, "points": points}
    ident = 0
    for _ in range(src.unsigned()):
        ident += src.signed()
        tags, members, way = src.tags(), [], 0
        for _ in range(src.count(MOST_MEMBERS, "members")):
            way += src.signed()
            members.append({"way_id": way, "role": src.string()})
        yield 2, {"id": ident, "tags": tags, "members": members}


def decode(raw: bytes) -> dict:
    """The tile of a payload; PayloadError if it is none."""
    tile = {"nodes": [], "ways": [], "relations": []}
    lists = list(tile.values())
    for rank, element in decoded(raw):
        lists[rank].append(element)
    return tile


def string_dictionary(tile: dict) -> list[str]:
    """The strings of a tile in the order of the payload's table."""
    src = Reader(encode(tile))
    src.at = len(MAGIC)
    src.table()
    return src.strings


def with_payload(tiles: DataFrame, level: int = S.PUBLISHED_LEVEL) -> DataFrame:
    """tiles (.., nodes, ways, relations) with payload size and zstd frame instead of the elements; Arrow batches."""
    rest = [c for c in tiles.columns if c not in ("nodes", "ways", "relations")]
    import pyarrow as pa

    def run(batches):
        press = zstandard.ZstdCompressor(level=level)  # one for all batches of a task
        for batch in batches:
            tiles = batch.select(["nodes", "ways", "relations"])
            raw = [encode(row) for k in range(batch.num_rows) for row in tiles.slice(k, 1).to_pylist()]  # one tile at a time is unfolded
            columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([len(r) for r in raw], pa.int64()), pa.array([press.compress(r) for r in raw], pa.binary())], names=[*rest, "raw_bytes", "frame"])

    schema = tiles.select(*rest).schema.add("raw_bytes", "long").add("frame", "binary")
    return tiles.mapInArrow(run, schema)


def payloads_of(elements: DataFrame, keys: list[str], level: int = S.PUBLISHED_LEVEL) -> DataFrame:
    """(keys, raw_bytes, frame) of the tiles that elements (keys, kind, id, node, way, relation) make, as :func:`with_payload`.

    Elements are sorted by tile, kind and id and encoded as they come, so a task holds a tile's bytes, not its rows.
    """
    import pyarrow as pa

    rank = F.when(F.col("kind") == "node", 0).when(F.col("kind") == "way", 1).otherwise(2)
    rows = elements.select(*keys, rank.alias("rank"), "id", *Encoder.KINDS).repartition(*keys).sortWithinPartitions(*keys, "rank", "id")
    schema = elements.select(*keys).schema.add("raw_bytes", "long").add("frame", "binary")

    def run(batches):
        press = zstandard.ZstdCompressor(level=level)
        tile, out, done, size = None, Encoder(), [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in done], kinds[k]) for k in range(len(keys))), pa.array([r[-2] for r in done], pa.int64()), pa.array([r[-1] for r in done], pa.binary())], names=[*keys, "raw_bytes", "frame"])

        def closed() -> None:
            raw = out.payload()
            done.append((*tile, len(raw), press.compress(raw)))

        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys]
            for k in range(0, batch.num_rows, SOME):
                for row in batch.slice(k, SOME).to_pylist():
                    own = tuple(row[key] for key in keys)
                    if own != tile:
                        if tile is not None:
                            closed()
                            size += len(done[-1][-1])
                        if size >= MOST_BYTES or len(done) >= SOME:
                            yield made()
                            done, size = [], 0
                        tile, out = own, Encoder()
                    out.add(row["rank"], row[Encoder.KINDS[row["rank"]]])
        if tile is not None:
            closed()
            yield made()

    return rows.mapInArrow(run, schema)


def elements_of(frames: DataFrame) -> DataFrame:
    """The inverse of :func:`payloads_of`: (.., kind, node, way, relation), a row for each element, a few at a time."""
    rest = [c for c in frames.columns if c not in ("raw_bytes", "frame")]
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    types = dict(zip(Encoder.KINDS, (S.NODE, S.WAY, S.RELATION), strict=True))
    arrow = {k: to_arrow_type(t) for k, t in types.items()}

    def run(batches):
        from . import packed

        press = zstandard.ZstdDecompressor()
        for batch in batches:
            frame = batch.column(batch.schema.get_field_index("frame"))
            for k in range(batch.num_rows):
                own = [batch.column(batch.schema.get_field_index(c)).slice(k, 1) for c in rest]
                for rank, some in packed.decoded(press.decompress(frame[k].as_py()), list(arrow.values())):
                    columns = [pa.chunked_array([c]).take(pa.array([0] * len(some))).combine_chunks() for c in own]
                    parts = [some if r == rank else pa.nulls(len(some), kind) for r, kind in enumerate(arrow.values())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([Encoder.KINDS[rank]] * len(some)), *parts], names=[*rest, "kind", *arrow])

    schema = frames.select(*rest).schema.add("kind", "string")
    for name, kind in types.items():
        schema = schema.add(name, kind)
    return frames.mapInArrow(run, schema)


def from_frames(frames: DataFrame) -> DataFrame:
    """The inverse of :func:`with_payload`: (.., nodes, ways, relations)."""
    rest = [c for c in frames.columns if c not in ("raw_bytes", "frame")]
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {f.name: to_arrow_type(f.dataType) for f in S.TILE.fields}

    def run(batches):
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = [decode(press.decompress(frame)) for frame in batch.column(batch.schema.get_field_index("frame")).to_pylist()]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array([r[k] for r in rows], kind) for k, kind in kinds.items())], names=[*rest, *kinds])

    schema = frames.select(*rest).schema
    for field in S.TILE.fields:
        schema = schema.add(field)
    return frames.mapInArrow(run, schema)


def is_empty() -> Column:
    return (F.size("nodes") == 0) & (F.size("ways") == 0) & (F.size("relations") == 0)
