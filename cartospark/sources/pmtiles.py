"""PMTiles v3 archives: directories, a reader as a Spark data source, and a writer.

An archive is a header, a root directory, metadata, leaf directories and data.  Directories are columns of
seven-bit numbers: id differences, run lengths, lengths, and offsets, where 0 means right after the entry before
and other values are one more than the offset.  A run of 0 points to a leaf directory.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import sys
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import schemas as S
from ..functions.codec import PayloadError, Reader, Writer
from .store import opened

HEADER = 127
ROOT_ENTRIES = 16_384 - HEADER
LONGEST_RUN = 1 << 20
#: Bytes of contents in a row that the writer passes to the driver.
PACK = 4 << 20


def write_directory(entries: list[tuple[int, int, int, int]]) -> bytes:
    """entries: (id, run, length, offset), sorted by id."""
    out = Writer()
    out.unsigned(len(entries))
    for k, e in enumerate(entries):
        out.unsigned(e[0] - (entries[k - 1][0] if k else 0))
    for column in (1, 2):
        for e in entries:
            out.unsigned(e[column])
    for k, e in enumerate(entries):
        follows = k > 0 and e[3] == entries[k - 1][3] + entries[k - 1][2]
        out.unsigned(0 if follows else e[3] + 1)
    return bytes(out.body)


def read_directory(raw: bytes) -> list[tuple[int, int, int, int]]:
    src = Reader(raw)
    n = src.unsigned()
    columns = [[src.unsigned() for _ in range(n)] for _ in range(4)]
    out, ident, offset = [], 0, 0
    for step, run, length, code in zip(*columns, strict=True):
        ident += step
        if code:
            offset = code - 1
        elif out:
            offset = out[-1][3] + out[-1][2]
        else:
            raise PayloadError("the first entry has no offset")
        out.append((ident, run, length, offset))
    return out


def inflated(kind: int, raw: bytes) -> bytes:
    if kind == 1:
        return raw
    if kind == 2:
        return gzip.decompress(raw)
    raise PayloadError(f"directory compression {kind}")


def header(raw: bytes) -> dict[str, int]:
    if len(raw) < HEADER or raw[:7] != b"PMTiles" or raw[7] != 3:
        raise PayloadError("not a PMTiles v3 archive")
    at = lambda k: int.from_bytes(raw[k : k + 8], "little")
    return {"root": at(8), "root_size": at(16), "leaves": at(40), "data": at(56), "compression": raw[97]}


def entries(read, info: dict[str, int]) -> Iterator[tuple[int, int, int, int]]:
    """All entries of an archive: read(offset, size) gives bytes; leaves may nest."""

    def walk(offset: int, size: int, depth: int) -> Iterator[tuple[int, int, int, int]]:
        if depth > 4:
            raise PayloadError("directories nest too deep")
        for e in read_directory(inflated(info["compression"], read(offset, size))):
            if e[1]:
                yield e
            else:
                yield from walk(info["leaves"] + e[3], e[2], depth + 1)

    return walk(info["root"], info["root_size"], 0)


class Contents:
    """The directory of an archive under way: contents go to put() once each, runs of equal ones are one entry."""

    def __init__(self, put) -> None:
        self.put, self.places, self.found, self.n, self.size = put, {}, [], 0, 0

    def add(self, ident: int, content: bytes, digest: bytes | None = None) -> None:
        """The next tile, in increasing order of id."""
        found = self.found
        if found and found[-1][0] + found[-1][1] > ident:
            raise ValueError("tile ids must increase")
        digest = digest or hashlib.sha256(content).digest()
        if digest not in self.places:
            self.places[digest] = (len(content), self.size)
            self.put(content)
            self.size += len(content)
        length, offset = self.places[digest]
        self.n += 1
        if found and found[-1][2:] == (length, offset) and found[-1][0] + found[-1][1] == ident:
            found[-1] = (found[-1][0], found[-1][1] + 1, length, offset)
        else:
            found.append((ident, 1, length, offset))

    def head(self, metadata: dict | None = None, zoom: int = S.ZOOM) -> bytes:
        """Everything before the contents."""
        found = self.found
        root, leaves = gzip.compress(write_directory(found), mtime=0), bytearray()
        if len(root) > ROOT_ENTRIES:
            step, parts = max(4096, len(found) // 1024), []
            for k in range(0, len(found), step):
                leaf = gzip.compress(write_directory(found[k : k + step]), mtime=0)
                parts.append((found[k][0], 0, len(leaf), len(leaves)))
                leaves += leaf
            root = gzip.compress(write_directory(parts), mtime=0)
        meta = gzip.compress(json.dumps(metadata or {}).encode(), mtime=0)
        at = [HEADER]
        for part in (root, meta, leaves):
            at.append(at[-1] + len(part))
        numbers = (at[0], len(root), at[1], len(meta), at[2], len(leaves), at[3], self.size, self.n, len(found), len(self.places))
        head = b"PMTiles\x03" + b"".join(x.to_bytes(8, "little") for x in numbers)
        # clustered, gzip directories, unknown tile compression and type, both zooms, extent unset
        head += bytes([1, 2, 0, 0, zoom, zoom])
        return head + bytes(HEADER - len(head)) + root + meta + bytes(leaves)


def archive(tiles: Iterator[tuple[int, bytes]], metadata: dict | None = None) -> bytes:
    """A small archive of (id, bytes) in increasing order of id."""
    body = bytearray()
    contents = Contents(body.extend)
    for ident, content in tiles:
        contents.add(ident, content)
    return contents.head(metadata) + bytes(body)


def write(files, path: str, tiles: list[DataFrame], metadata: dict | None = None) -> int:
    """Write an archive of tables (tile_id, frame), each beginning after the last's ids, and return its size.

    Executors sort and pack tiles into a few large rows, with their digests; the driver keeps the directory and passes contents on.
    files: a ``plans.files.Files``.
    """
    with files.writing(f"{path}.data") as put:
        contents = Contents(put)
        for table in tiles:
            ordered = table.select("tile_id", "frame").repartitionByRange("tile_id").sortWithinPartitions("tile_id")
            for row in ordered.mapInArrow(_packed, "ids binary, sizes binary, digests binary, body binary").toLocalIterator(prefetchPartitions=True):
                at = 0
                for ident, size, k in zip(memoryview(row["ids"]).cast("q"), memoryview(row["sizes"]).cast("q"), range(0, len(row["digests"]), 32), strict=True):
                    contents.add(ident, row["body"][at : at + size], bytes(row["digests"][k : k + 32]))
                    at += size
    size = files.copy(f"{path}.data", path, contents.head(metadata))
    files.delete(f"{path}.data")
    return size


def _packed(batches):
    """Sorted (tile_id, frame) as rows of about PACK bytes: ids, sizes, digests and contents, end to end."""
    import pyarrow as pa

    names = ["ids", "sizes", "digests", "body"]

    def row(held):
        ids, frames = zip(*held, strict=True)
        whole = lambda values: b"".join(v.to_bytes(8, sys.byteorder, signed=True) for v in values)
        columns = (whole(ids), whole(map(len, frames)), b"".join(hashlib.sha256(f).digest() for f in frames), b"".join(frames))
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=names)

    held, size = [], 0
    for batch in batches:
        for ident, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.append((ident, frame))
            size += len(frame)
            if size >= PACK:
                yield row(held)
                held, size = [], 0
    if held:
        yield row(held)


def leaves(read) -> Iterator[bytes]:
    """The inflated directories of an archive that name tiles: read(offset, size) gives bytes."""
    info = header(read(0, HEADER))

    def walk(offset: int, size: int, depth: int) -> Iterator[bytes]:
        if depth > 4:
            raise PayloadError("directories nest too deep")
        raw = inflated(info["compression"], read(offset, size))
        found = read_directory(raw)
        if any(e[1] for e in found):
            yield raw
        for e in found:
            if not e[1]:
                yield from walk(info["leaves"] + e[3], e[2], depth + 1)

    return walk(info["root"], info["root_size"], 0)


def read_leaves(spark, files, paths: list[str]) -> DataFrame:
    """(path, tile_id, run, length, offset) of archives in any store: the driver reads the directories alone, and tasks expand them."""
    rows = [(p, bytearray(raw)) for p in paths for raw in leaves(lambda offset, size, p=p: files.read(p, offset, size))]
    schema = "path string, tile_id long, run long, length long, offset long"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [e for e in read_directory(raw) if e[1]]
                columns = [pa.array([path] * len(found), pa.string()), *(pa.array([e[k] for e in found], pa.int64()) for k in range(4))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "tile_id", "run", "length", "offset"])

    return spark.createDataFrame(rows, "path string, raw binary").repartition(max(1, len(rows) // 4)).mapInArrow(run, schema)


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths = [p for p in options["path"].split(",") if p]

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition):
        with opened(partition.path) as f:

            def read(offset: int, size: int) -> bytes:
                f.seek(offset)
                return f.read(size)

            for ident, run, length, offset in entries(read, header(read(0, HEADER))):
                yield (partition.path, ident, run, length, offset)


class PMTilesSource(DataSource):
    """spark.dataSource.register(PMTilesSource); spark.read.format("pmtiles").load(path): directory entries."""

    @classmethod
    def name(cls) -> str:
        return "pmtiles"

    def schema(self) -> str:
        return "path string, tile_id long, run long, length long, offset long"

    def reader(self, schema):
        return _Reader(self.options)


def directory_of(files: DataFrame) -> DataFrame:
    """(path, tile_id, run, length, offset) of archives read by format("binaryFile"), from any store Spark reads."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(entries(lambda offset, size, c=content: c[offset : offset + size], header(content)))
                yield pa.RecordBatch.from_pydict({"path": [path] * len(rows), **{n: [r[k] for r in rows] for k, n in enumerate(("tile_id", "run", "length", "offset"))}}, schema=pa.schema([("path", pa.string()), *((n, pa.int64()) for n in ("tile_id", "run", "length", "offset"))]))

    return files.select("path", "content").mapInArrow(run, "path string, tile_id long, run long, length long, offset long")


def covered_cells(directory: DataFrame) -> DataFrame:
    """(path, cell): coverage cells of directory entries; ids past zoom 13 are records, not places."""
    from ..functions import tilemath as M

    own = directory.filter(F.col("tile_id") < S.PAST_ID)
    each = own.select("path", F.explode(F.sequence(F.col("tile_id"), F.col("tile_id") + F.least(F.col("run"), F.lit(LONGEST_RUN)) - 1)).alias("id"))
    each = each.filter((F.col("id") < S.PAST_ID) & (F.col("id") >= S.FIRST_ID)).withColumn("t", M.hilbert_xy("id"))
    return each.select("path", M.cell("t.x", "t.y").alias("cell")).distinct()
