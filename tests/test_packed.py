"""Tiles encoded from elements that are held and moved once for all their tiles."""

import random

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_type

from cartospark import fixtures, registry
from cartospark import schemas as S
from cartospark.functions import codec, packed
from cartospark.plans.stored import Stored

DATA = "/root/testdata/sf0.001"
KINDS = [to_arrow_type(t) for t in (S.NODE, S.WAY, S.RELATION)]


def test_blocks_make_the_bytes_of_single_tiles(spark):
    bake = registry._bake(lambda name: fixtures.view(spark, DATA, name))
    store = Stored(spark)
    got = packed.payloads_of(bake.packed(store), 3)
    expect = codec.payloads_of(bake.tile_rows(), ["continent", "x", "y"], 3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.collect()))
    store.drop()


def test_round_trip_has_no_row_for_each_tile_of_an_element(spark):
    """Joins are written before, by continents; what is left moves elements to blocks of tiles, and counts of tiles."""
    df = registry.QUERIES["encode_roundtrip"](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert "hashpartitioning(continent" in plan and ", block" in plan


def some_tile(r: random.Random, nodes: int, ways: int, relations: int) -> dict:
    ids = lambda n: sorted(r.sample(range(-50, 10**10), n))
    tags = lambda: [{"k": r.choice("abcdé"), "v": str(r.randrange(40))} for _ in range(r.randrange(4))]
    place = lambda: {"lat_q": r.randrange(-9 * 10**8, 9 * 10**8), "lon_q": r.randrange(-18 * 10**8, 18 * 10**8)}
    return {
        "nodes": [{"id": i, **place(), "tags": tags()} for i in ids(nodes)],
        "ways": [{"id": i, "closed": r.random() < 0.5, "tags": tags(), "points": [place() for _ in range(r.randrange(6))]} for i in ids(ways)],
        "relations": [{"id": i, "tags": tags(), "members": [{"way_id": r.randrange(-5, 10**11), "role": r.choice(["", "outer", "z"])} for _ in range(r.randrange(5))]} for i in ids(relations)],
    }


@pytest.mark.parametrize("window", [16, 1 << 18])
@pytest.mark.parametrize("sizes", [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (90, 120, 60)])
def test_arrays_decode_what_single_elements_encode(monkeypatch, window, sizes):
    monkeypatch.setattr(packed, "WINDOW", window)
    tile = some_tile(random.Random(5), *sizes)
    raw, found = codec.encode(tile), [[], [], []]
    for rank, some in packed.decoded(raw, KINDS):
        assert isinstance(some, pa.StructArray)
        found[rank] += some.to_pylist()
    assert found == list(tile.values())
    for cut in range(0, len(raw), 1 + len(raw) // 40):
        with pytest.raises(codec.PayloadError):
            list(packed.decoded(raw[:cut], KINDS))
