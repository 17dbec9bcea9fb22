"""Payloads, archives and the readers of foreign files."""

import io
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartospark.functions import codec
from cartospark.plans.files import Files
from cartospark.sources import osm_pbf, outlines, pmtiles

TAG = st.fixed_dictionaries({"k": st.text(max_size=5), "v": st.text(max_size=5)})
LAT, LON, ID = st.integers(-900000000, 900000000), st.integers(-1800000000, 1800000000), st.integers(0, 1 << 40)
POINT = st.fixed_dictionaries({"lat_q": LAT, "lon_q": LON})
TILE = st.fixed_dictionaries(
    {
        "nodes": st.lists(st.fixed_dictionaries({"id": ID, "lat_q": LAT, "lon_q": LON, "tags": st.lists(TAG, max_size=3)}), max_size=4),
        "ways": st.lists(st.fixed_dictionaries({"id": ID, "closed": st.booleans(), "tags": st.lists(TAG, max_size=2), "points": st.lists(POINT, max_size=5)}), max_size=3),
        "relations": st.lists(st.fixed_dictionaries({"id": ID, "tags": st.lists(TAG, max_size=2), "members": st.lists(st.fixed_dictionaries({"way_id": ID, "role": st.text(max_size=4)}), max_size=4)}), max_size=2),
    }
)


@given(TILE)
@settings(max_examples=150, deadline=None)
def test_payload_round_trip(tile):
    raw = codec.encode(tile)
    assert codec.decode(raw) == tile
    for n in {5, len(raw) // 2, len(raw) - 1} - {len(raw)}:
        if 0 <= n < len(raw):
            with pytest.raises(codec.PayloadError):
                codec.decode(raw[:n])


def test_payload_errors_and_strings():
    empty = {"nodes": [], "ways": [], "relations": []}
    assert codec.encode(empty) == b"AOT2\0\0\0\0"
    for raw in (b"", b"AOT1\0\0\0\0", b"AOT2" + b"\xff" * 12):
        with pytest.raises(codec.PayloadError):
            codec.decode(raw)
    tile = empty | {"relations": [{"id": 9, "tags": [{"k": "a", "v": "b"}, {"k": "b", "v": "a"}], "members": [{"way_id": 27, "role": "outer"}, {"way_id": 28, "role": "a"}]}]}
    assert codec.string_dictionary(tile) == ["a", "b", "outer"]


@given(st.lists(st.tuples(st.integers(0, 1 << 40), st.binary(max_size=3)), max_size=60, unique_by=lambda x: x[0]))
@settings(max_examples=30, deadline=None)
def test_archive_round_trip(tiles):
    tiles = sorted(tiles)
    raw = pmtiles.archive(iter(tiles))
    info = pmtiles.header(raw)
    found = [(i + k, raw[info["data"] + off : info["data"] + off + n]) for i, run, n, off in pmtiles.entries(lambda o, s: raw[o : o + s], info) for k in range(run)]
    assert found == tiles


def test_archive_with_leaves_and_source(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pmtiles, "PACK", 9_000)
    tiles = [(22369621 + 7 * k, str(k % 977).encode()) for k in range(60000)]
    path, files = str(tmp_path / "big.pmtiles"), Files(spark)
    table = lambda rows: spark.createDataFrame([(i, bytearray(c)) for i, c in rows], "tile_id long, frame binary")
    size = pmtiles.write(files, path, [table(tiles[:50000][::-1]), table(tiles[50000:])])
    raw = (tmp_path / "big.pmtiles").read_bytes()
    info = pmtiles.header(raw)
    assert [(i, raw[info["data"] + off : info["data"] + off + n]) for i, _, n, off in pmtiles.entries(lambda o, s: raw[o : o + s], info)] == tiles
    assert size == len(raw) and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["big.pmtiles"]
    spark.dataSource.register(pmtiles.PMTilesSource)
    got = spark.read.format("pmtiles").load(path)
    assert got.count() == 60000 and got.agg({"tile_id": "max"}).first()[0] == tiles[-1][0]
    assert spark.read.format("pmtiles").load(f"file://{path}").count() == 60000
    read = pmtiles.read_leaves(spark, files, [path])
    assert sorted(tuple(r)[1:] for r in read.collect()) == sorted(tuple(r)[1:] for r in got.collect())
    whole = spark.read.format("binaryFile").load(path)
    assert pmtiles.directory_of(whole).count() == 60000 and pmtiles.covered_cells(read).count() > 1
    with pytest.raises(ValueError, match="increase"):
        pmtiles.write(files, path, [table([(2, b"a")]), table([(1, b"b")])])
    with pytest.raises(codec.PayloadError):
        pmtiles.header(b"x" * 200)


def test_files_are_whole_or_not_there(spark, tmp_path):
    files = Files(spark)
    source = tmp_path / "from" / "a" / "x.bin"
    source.parent.mkdir(parents=True)
    source.write_bytes(bytes(range(256)) * 40)
    url, folder = f"file://{source}", str(tmp_path / "to")
    got = files.fetched(url, folder)
    assert files.read(got) == source.read_bytes() and files.read(got, 5, 3) == b"\x05\x06\x07" and files.size(got) == 10240
    source.write_bytes(b"later")
    assert files.read(files.fetched(url, folder))[:2] == b"\x00\x01"  # what is there is not fetched again
    files.delete(got)
    assert files.read(files.fetched(url, folder)) == b"later"
    with pytest.raises(Exception, match="(?i)no such file|not exist"):
        files.fetched(f"file://{tmp_path}/none", folder)
    with pytest.raises(RuntimeError), files.writing(f"{folder}/half") as put:
        put(b"x")
        raise RuntimeError
    assert not files.exists(f"{folder}/half") and not files.exists(f"{folder}/none") and files.free(folder) > 0
    files.write_json(f"{folder}/j", {"a": [1]})
    files.write_json(f"{folder}/j", {"a": [2]})
    assert files.read_json(f"{folder}/j") == {"a": [2]} and files.read_json(f"{folder}/k", 7) == 7


def test_pbf(spark, tmp_path):
    path = str(tmp_path / "x.osm.pbf")
    nodes = [(1, 47.0000001, 8.5, [("amenity", "bench")]), (4000000001, -33.9, -151.2, [])]
    for dense in (True, False):
        osm_pbf.write(path, nodes, [(27, [1, 4000000001, 1], [("building", "yes")])], [(9, [("way", 27, "outer"), ("node", 1, "")], [("type", "multipolygon")])], box=(8.0, 46.5, 9.0, 47.5), dense=dense)
        assert osm_pbf.read_box(path) == (8.0, 46.5, 9.0, 47.5)
        spark.dataSource.register(osm_pbf.OsmPbfSource)
        got = {(r["kind"], r["id"]): r for r in spark.read.format("osmpbf").load(path).collect()}
        assert (got["node", 1]["lat"], got["node", 1]["lon"]) == (47.0000001, 8.5) and got["node", 1]["tags"][0]["v"] == "bench"
        assert got["way", 27]["refs"] == [1, 4000000001, 1] and [tuple(m) for m in got["relation", 9]["members"]] == [("way", 27, "outer"), ("node", 1, "")]
        assert len(got) == 4
    assert osm_pbf.read_box(str(tmp_path / "none")) is None
    with pytest.raises(codec.PayloadError):
        list(osm_pbf.blob_heads(io.BytesIO(b"\0\0")))


def test_poly(spark):
    text = "name\nsquare\n 0 0\n 1 0 \n 1 1\nbad line\n 0 1\nEND\n!2\n 0.2 0.2\n 0.4 0.2\n 0.4 0.4\nEND\n3\n 5 5\n 6 6\nEND\nEND\n"
    got = outlines.poly_rings(spark.createDataFrame([("p", text)], "path string, value string")).orderBy("ring", "pos").collect()
    assert [(r["ring"], r["lon"], r["lat"]) for r in got] == [(0, 0, 0), (0, 1, 0), (0, 1, 1), (0, 0, 1), (1, 0.2, 0.2), (1, 0.4, 0.2), (1, 0.4, 0.4)]


def test_geojson(spark):
    text = """{"features":[{"properties":{"id":"a","name":"A","urls":{"pbf":"http://x/a.pbf","shp":"y"}},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1]],[[0,0],[1,1]]]}},
      {"properties":{"id":"b","parent":"a","name":"B"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[2,0],[2,2]]],[[[5,5],[6,5],[6,6],[5,6]]]]}}]}"""
    index = outlines.geojson_index(spark.createDataFrame([(text,)], "value string"))
    assert [tuple(r) for r in index.select("id", "parent", "url").collect()] == [("a", None, "http://x/a.pbf"), ("b", "a", None)]
    rings = {(r["id"], r["ring"]): r["n"] for r in outlines.geojson_rings(index).groupBy("id", "ring").count().withColumnRenamed("count", "n").collect()}
    assert rings == {("a", 0): 3, ("b", 0): 3, ("b", 1): 4}


def test_shapefile():
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0)]
    raw = outlines.shapefile_bytes([[square, square[:2]], [square]])
    assert [[len(r) for r in rec] for rec in outlines.parse_shapefile(raw)] == [[3], [3]]
    for bad in (b"", b"x" * 120, raw[:-4]):
        with pytest.raises(ValueError, match="shapefile"):
            outlines.parse_shapefile(bad)
    assert outlines.parse_shapefile(struct.pack(">i", 9994) + b"\0" * 96) == []


def test_local_names(spark):
    urls = ["https://a.org/x/georgia-latest.osm.pbf", "https://a.org/y/georgia-latest.osm.pbf", "https://b.org:80/kanto\\latest"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(outlines.local_name("url")).collect()]
    assert len(set(got)) == 3 and not any(c in n for n in got for c in "/\\:")
