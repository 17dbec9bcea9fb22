"""OSM PBF extracts as a Spark data source: one partition per run of blobs, all three kinds in one scan.

The public format: blobs, each with a small header; a data blob inflates to a block with a string table and
groups of nodes (plain or dense), ways and relations.  Only the fields that the tables need are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.codec import PayloadError, Reader, Writer
from .store import opened

BLOBS_PER_TASK = 64
#: Tags, references and members that end a blob that is written, far below the format's 32 MB.
MOST_LISTED = 1 << 19
SCHEMA = (
    "kind string, id long, lat double, lon double, tags array<struct<k: string, v: string>>, refs array<long>, "
    "members array<struct<type: string, ref: long, role: string>>"
)


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message: a whole number, or bytes."""
    src = Reader(raw)
    while src.at < len(raw):
        key = src.unsigned()
        kind = key & 7
        if kind == 0:
            yield key >> 3, src.unsigned()
        elif kind == 2:
            yield key >> 3, src.take(src.unsigned())
        elif kind in (1, 5):
            yield key >> 3, src.take(8 if kind == 1 else 4)
        else:
            raise PayloadError("unknown wire type")


def packed(raw: bytes, signed: bool = False) -> list[int]:
    src, out = Reader(raw), []
    while src.at < len(raw):
        out.append(src.signed() if signed else src.unsigned())
    return out


def running(values: list[int]) -> list[int]:
    total, out = 0, []
    for v in values:
        total += v
        out.append(total)
    return out


def zigzag(n: int) -> int:
    return n // 2 if n % 2 == 0 else -(n // 2) - 1


def whole(n: int) -> int:
    """A 64-bit number that may be negative."""
    return n - (1 << 64) if n >= 1 << 63 else n


def blob_heads(f) -> Iterator[tuple[str, int, int]]:
    """(type, offset, size) of the blobs of an open file; only headers are read."""
    while head := f.read(4):
        if len(head) < 4:
            raise PayloadError("cut short")
        found = dict(fields(f.read(int.from_bytes(head, "big"))))
        yield found[1].decode(), f.tell(), found[3]
        f.seek(found[3], 1)


def inflate(blob: bytes) -> bytes:
    found = dict(fields(blob))
    if 1 in found:
        return found[1]
    if 3 in found:
        return zlib.decompress(found[3])
    raise PayloadError("blob compression")


def header_box(block: bytes) -> tuple[float, float, float, float] | None:
    """(left, bottom, right, top) of a header block, if it has one."""
    for number, value in fields(block):
        if number == 1:
            box = {n: zigzag(v) / 1e9 for n, v in fields(value)}
            return box[1], box[4], box[2], box[3]
    return None


def elements(block: bytes) -> Iterator[tuple]:
    """Rows of SCHEMA of a data block."""
    strings, groups, grain, lat0, lon0 = [], [], 100, 0, 0
    for number, value in fields(block):
        if number == 1:
            strings = [v.decode() for _, v in fields(value)]
        elif number == 2:
            groups.append(value)
        elif number == 17:
            grain = value
        elif number == 19:
            lat0 = whole(value)
        elif number == 20:
            lon0 = whole(value)
    lat, lon = (lambda v: (lat0 + grain * v) / 1e9), (lambda v: (lon0 + grain * v) / 1e9)
    pairs = lambda ks, vs: [(strings[k], strings[v]) for k, v in zip(ks, vs, strict=True)]
    for group in groups:
        for number, value in fields(group):
            own = dict(fields(value))
            tags = pairs(packed(own.get(2, b"")), packed(own.get(3, b""))) if number != 2 else []
            if number == 1:
                yield "node", zigzag(own[1]), lat(zigzag(own[8])), lon(zigzag(own[9])), tags, None, None
            elif number == 2:
                yield from _dense(own, strings, lat, lon)
            elif number == 3:
                yield "way", whole(own[1]), None, None, tags, running(packed(own.get(8, b""), True)), None
            elif number == 4:
                kinds = ("node", "way", "relation")
                refs, roles, types = running(packed(own.get(9, b""), True)), packed(own.get(8, b"")), packed(own.get(10, b""))
                yield "relation", whole(own[1]), None, None, tags, None, [(kinds[t], r, strings[s]) for t, r, s in zip(types, refs, roles, strict=True)]


def _dense(own: dict, strings: list[str], lat, lon) -> Iterator[tuple]:
    """Nodes in columns; tags are key and value numbers, 0 ends a node's."""
    mixed, at = packed(own.get(10, b"")), 0
    for ident, y, x in zip(*(running(packed(own[k], True)) for k in (1, 8, 9)), strict=True):
        tags = []
        while at < len(mixed) and mixed[at]:
            tags.append((strings[mixed[at]], strings[mixed[at + 1]]))
            at += 2
        at += 1
        yield "node", ident, lat(y), lon(x), tags, None, None


class _Blobs(InputPartition):
    def __init__(self, path: str, spans: list[tuple[int, int]]) -> None:
        self.path, self.spans = path, spans


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]

    def partitions(self):
        with opened(self.path) as f:
            spans = [(offset, size) for kind, offset, size in blob_heads(f) if kind == "OSMData"]
        return [_Blobs(self.path, spans[k : k + BLOBS_PER_TASK]) for k in range(0, len(spans), BLOBS_PER_TASK)]

    def read(self, partition):
        with opened(partition.path) as f:
            for offset, size in partition.spans:
                f.seek(offset)
                yield from elements(inflate(f.read(size)))


class OsmPbfSource(DataSource):
    """spark.dataSource.register(OsmPbfSource); spark.read.format("osmpbf").load(path)."""

    @classmethod
    def name(cls) -> str:
        return "osmpbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def read_box(path: str) -> tuple[float, float, float, float] | None:
    """The box of a file's header, or none if anything about it can't be read."""
    try:
        with opened(path) as f:
            for kind, offset, size in blob_heads(f):
                if kind == "OSMHeader":
                    f.seek(offset)
                    return header_box(inflate(f.read(size)))
    except (OSError, KeyError, ValueError, zlib.error):  # Arrow's own errors are among these
        return None
    return None


def elements_of(files):
    """Rows of SCHEMA, with path, of extracts read by format("binaryFile"), from any store Spark reads.

    A row has a file, or some whole blobs of one (:func:`blobs_of`).  For files that fit a row; larger ones go through
    the data source, which reads them by blobs.
    """
    import io

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = "path string, " + SCHEMA

    def run(batches):
        arrow = to_arrow_schema(parsed)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                f = io.BytesIO(content)
                for kind, offset, size in blob_heads(f):
                    if kind != "OSMData":
                        continue
                    columns = [[] for _ in arrow]
                    for row in elements(inflate(content[offset : offset + size])):
                        kind_, ident, lat, lon, tags, refs, members = row
                        tagged = [{"k": k, "v": v} for k, v in tags]
                        listed = None if members is None else [{"type": t, "ref": r, "role": o} for t, r, o in members]
                        for column, value in zip(columns, (path, kind_, ident, lat, lon, tagged, refs, listed), strict=True):
                            column.append(value)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    parsed = _parse_datatype_string(schema)
    return files.select("path", "content").mapInArrow(run, schema)


def _message(*parts: tuple[int, int | bytes]) -> bytes:
    out = Writer()
    for number, value in parts:
        out.unsigned(number << 3 | (0 if isinstance(value, int) else 2))
        if isinstance(value, int):
            out.unsigned(value)
        else:
            out.unsigned(len(value))
            out.body += value
    return bytes(out.body)


def _numbers(values, signed=False) -> bytes:
    out = Writer()
    for v in values:
        (out.signed if signed else out.unsigned)(v)
    return bytes(out.body)


def _steps(values) -> bytes:
    values = list(values)
    return _numbers((b - a for a, b in zip([0, *values], values, strict=False)), True)


def _twice(n: int) -> int:
    return 2 * n if n >= 0 else -2 * n - 1


def _unit(degrees: float) -> int:
    return round(degrees * 1e7)


def _blob(kind: str, raw: bytes) -> bytes:
    body = _message((2, len(raw)), (3, zlib.compress(raw)))
    head = _message((1, kind.encode()), (3, len(body)))
    return len(head).to_bytes(4, "big") + head + body


def header_blob(box=None) -> bytes:
    return _blob("OSMHeader", _message(*([(1, _message(*((k, _twice(round(v * 1e9))) for k, v in zip((1, 4, 2, 3), box, strict=True))))] if box else [])))


def data_blob(kind: str, some: list[tuple], dense: bool = True) -> bytes:
    """Elements of one kind, as for :func:`write`."""
    strings: dict[str, int] = {"": 0}
    at = lambda s: strings.setdefault(s, len(strings))
    parts = []
    if kind == "node" and dense:
        mixed = [x for r in some for x in [*(at(s) for t in r[3] for s in t), 0]]
        parts.append((2, _message((1, _steps(r[0] for r in some)), (8, _steps(_unit(r[1]) for r in some)), (9, _steps(_unit(r[2]) for r in some)), (10, _numbers(mixed)))))
    for r in some if kind != "node" or not dense else ():
        tags = [(2, _numbers(at(a) for a, _ in r[-1])), (3, _numbers(at(b) for _, b in r[-1]))]
        if kind == "node":
            parts.append((1, _message((1, _twice(r[0])), *tags, (8, _twice(_unit(r[1]))), (9, _twice(_unit(r[2]))))))
        elif kind == "way":
            parts.append((3, _message((1, r[0]), *tags, (8, _steps(r[1])))))
        else:
            order = ["node", "way", "relation"]
            parts.append((4, _message((1, r[0]), *tags, (8, _numbers(at(m[2]) for m in r[1])), (9, _steps(m[1] for m in r[1])), (10, _numbers(order.index(m[0]) for m in r[1])))))
    group = _message(*parts)
    return _blob("OSMData", _message((1, _message(*((1, s.encode()) for s in strings))), (2, group)))


def blobs_of(elements, path: str, block: int = 8000):
    """(path, rank, first, content): the extract of elements (SCHEMA), a row for each blob, made by the executors.

    The contents in order of rank and first are the file: its header, then nodes, ways and relations by id.  A blob has
    at most ``block`` elements, and is ended early when they list much; no task holds more than one.
    """
    import pyarrow as pa

    kinds = ("node", "way", "relation")
    rank = F.when(F.col("kind") == "node", 0).when(F.col("kind") == "way", 1).otherwise(2)
    rows = elements.withColumn("rank", rank).repartitionByRange("rank", "id").sortWithinPartitions("rank", "id")

    def element(row: dict) -> tuple:
        tags = [(t["k"], t["v"]) for t in row["tags"]]
        if row["rank"] == 0:
            return row["id"], row["lat"], row["lon"], tags
        return row["id"], row["refs"] if row["rank"] == 1 else [(m["type"], m["ref"], m["role"]) for m in row["members"]], tags

    def run(batches):
        some, rank, listed = [], None, 0
        made = lambda: pa.RecordBatch.from_pydict({"path": [path], "rank": pa.array([rank], pa.int32()), "first": [some[0][0]], "content": [data_blob(kinds[rank], some)]})
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                for row in batch.slice(k, 1000).to_pylist():
                    if some and (row["rank"] != rank or len(some) >= block or listed >= MOST_LISTED):
                        yield made()
                        some, listed = [], 0
                    rank = row["rank"]
                    some.append(element(row))
                    listed += len(some[-1][1]) if rank else 0
                    listed += len(some[-1][-1])
        if some:
            yield made()

    schema = "path string, rank int, first long, content binary"
    head = elements.sparkSession.createDataFrame([(path, -1, 0, bytearray(header_blob()))], schema)
    return head.union(rows.mapInArrow(run, schema))


def write(path_or_file, nodes=(), ways=(), relations=(), box=None, dense: bool = True, block: int = 8000) -> None:
    """Write a small extract: nodes (id, lat, lon, tags), ways (id, refs, tags), relations (id, members, tags); tags are pairs.

    For fixtures and tests; coordinates are kept to 1e-7 degrees.  Of tables, :func:`blobs_of` makes extracts.
    """

    def blocks(f) -> None:
        f.write(header_blob(box))
        for kind, rows in (("node", list(nodes)), ("way", list(ways)), ("relation", list(relations))):
            for k in range(0, len(rows), block):
                f.write(data_blob(kind, rows[k : k + block], dense))

    if hasattr(path_or_file, "write"):
        blocks(path_or_file)
    else:
        with open(path_or_file, "wb") as f:
            blocks(f)
