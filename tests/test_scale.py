"""What must hold at any size: what drivers and tasks hold, and the results of the paths that keep it small."""

import io
import os
import re

import duckdb
import pytest

from cartospark import fixtures, registry
from cartospark.functions import codec
from cartospark.functions import tilemath as M
from cartospark.oracles import ORACLES
from cartospark.plans.bake import assembled
from cartospark.sources import osm_pbf

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def eager(spark):
    """Broadcasts whatever is not kept from it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def broadcast_files(df) -> set[str]:
    """Names of the tables below broadcasts."""
    found, inside = set(), None
    for line in executed(df).split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is not None and depth <= inside:
            inside = None
        if inside is None and "BroadcastExchange" in line:
            inside = depth
        if inside is not None:
            found |= set(re.findall(r"/(\w+)\.parquet", line))
    return found


def compared(spark, name):
    con = duckdb.connect()
    for t in os.listdir(DATA):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{t}'")
    theirs = con.sql(ORACLES[name])
    mine = registry.QUERIES[name](spark, DATA).select(*theirs.columns)
    assert sorted(map(repr, map(tuple, mine.collect()))) == sorted(map(repr, theirs.fetchall()))


@pytest.mark.parametrize("name", ["merge_dedup"])
def test_only_tables_of_regions_are_broadcast(spark, eager, name):
    assert broadcast_files(registry.QUERIES[name](spark, DATA)) <= {"region", "nation"}


def test_merge_takes_way_tiles_in_one_pass(spark):
    """Relations come from the tiles of their members without a second walk, and are what they were."""
    compared(spark, "merge_dedup")
    bake = registry._bake(lambda name: fixtures.view(spark, DATA, name))
    assert executed(bake.merged).count("Generate explode(array_union(") == 1


def test_extracts_are_written_by_blobs(spark, tmp_path, monkeypatch):
    rows = [("node", k, 47.0 + k / 1e7, -8.5, [("a", str(k))], None, None) for k in range(1, 40)]
    rows += [("way", k, None, None, [], list(range(1, 1 + k)), None) for k in (5, 3, 4000000007)[:2]] + [("way", 4000000007, None, None, [("b", "c")], [1, 2, 1], None)]
    rows += [("relation", 9, None, None, [], None, [("way", 5, "outer"), ("node", 2, "")])]
    parts = osm_pbf.blobs_of(spark.createDataFrame(rows[::-1], osm_pbf.SCHEMA).repartition(5), "x", block=10)
    found = sorted(map(repr, (tuple(r)[1:] for r in osm_pbf.elements_of(parts).collect())))
    assert found == sorted(map(repr, (tuple(r) for r in spark.createDataFrame(rows, osm_pbf.SCHEMA).collect())))
    # one blob a row; in their order they are a file that the data source reads
    blobs = parts.orderBy("rank", "first").collect()
    assert len(blobs) >= 7 and all(len(list(osm_pbf.blob_heads(io.BytesIO(r["content"])))) == 1 for r in blobs)
    (tmp_path / "x.osm.pbf").write_bytes(b"".join(r["content"] for r in blobs))
    spark.dataSource.register(osm_pbf.OsmPbfSource)
    assert sorted(map(repr, (tuple(r) for r in spark.read.format("osmpbf").load(f"{tmp_path}/x.osm.pbf").collect()))) == found


def test_no_element_of_an_extract_comes_to_the_driver(spark, monkeypatch):
    kind = type(spark.range(0))
    monkeypatch.setattr(kind, "collect", lambda self: pytest.fail("collected"))
    query = registry.QUERIES["src_osm_elements"](spark, DATA)
    monkeypatch.undo()
    assert query.count() > 1000
    compared(spark, "src_osm_elements")


def test_stamps_beyond_the_year_9999_have_no_sign(spark):
    at = [0, -1, 951786061, 253402300799, 253402300800, 519429782400, None]
    rows = spark.createDataFrame([(k, s) for k, s in enumerate(at)], "k int, s long").select("k", M.build_stamp("s").alias("t"), M.build_stamp("s", False).alias("d")).orderBy("k").collect()
    assert [r["t"] for r in rows] == ["19700101-000000", "19691231-235959", "20000229-010101", "99991231-235959", "100000101-000000", "184300127-184000", None]
    assert [r["d"] for r in rows] == [r["t"] and r["t"].partition("-")[0] for r in rows]


def test_tiles_are_encoded_as_their_elements_come(spark, monkeypatch):
    """Without a row that holds a tile, in parts, to the same bytes."""
    bake = registry._bake(lambda name: fixtures.view(spark, DATA, name))
    rows = bake.tile_rows().persist()
    keys = ["continent", "x", "y"]
    got = codec.payloads_of(rows, keys, 3)
    assert "collect_list(node" not in executed(got)
    expect = codec.with_payload(assembled(rows, keys), 3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.collect()))
    back = codec.elements_of(got).groupBy(*keys, "kind").count()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.groupBy(*keys, "kind").count().collect()))
    rows.unpersist()


def test_round_trip_holds_no_tile_in_a_row(spark):
    plan = executed(registry.QUERIES["encode_roundtrip"](spark, DATA))
    assert "collect_list(way" not in plan and plan.count("MapInArrow") == 2
    compared(spark, "encode_roundtrip")


def test_strings_are_counted_without_tiles_in_rows(spark):
    plan = executed(registry.QUERIES["string_dictionary"](spark, DATA))
    assert "collect_list(way" not in plan and "collect_list(node" not in plan
    compared(spark, "string_dictionary")
