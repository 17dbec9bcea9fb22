"""Tag rules, each on a case of its own."""

import pytest
from pyspark.sql import functions as F

from cartospark.functions import tags as T
from cartospark.schemas import TAGS


def kept(spark, *given):
    """The tags that stay of some."""
    row = spark.createDataFrame([([*given],)], f"t {TAGS.simpleString()}").select(T.filtered(F.col("t")).alias("t")).first()
    return [tuple(x) for x in row["t"]]


def wanted(spark, kind, *given):
    rule = {"node": T.node_wanted, "way": T.way_wanted, "relation": T.relation_wanted}[kind]
    return spark.createDataFrame([([*given],)], f"t {TAGS.simpleString()}").select(rule(F.col("t")).alias("w")).first()["w"]


def test_ignored_keys_and_prefixes_go_in_place(spark):
    tags = [("colour", "red"), *((k, "1") for k in T.IGNORED), ("lanes", "2"), *((f"{p}zz", "1") for p in T.IGNORED_PREFIXES), ("colour", "blue")]
    assert kept(spark, *tags) == [("colour", "red"), ("lanes", "2"), ("colour", "blue")]


def test_a_prefix_must_be_whole(spark):
    assert kept(spark, ("sourc", "1"), ("names", "2"), ("addr", "3"), ("notes", "4")) == [("sourc", "1"), ("names", "2"), ("addr", "3"), ("notes", "4")]


@pytest.mark.parametrize("key", T.ALWAYS)
def test_keys_that_always_stay(spark, key):
    assert kept(spark, (key, "v"), ("email", "e")) == [(key, "v")]


@pytest.mark.parametrize("mark", ["building", "building:part"])
def test_sources_stay_on_buildings_alone(spark, mark):
    own = [(k, f"from {k}") for k in T.BUILDING_SOURCES]
    assert kept(spark, *own, (mark, "shed")) == [*own, (mark, "shed")]
    assert kept(spark, *own, ("barrier", "hedge")) == [("barrier", "hedge")]


def test_registers_are_emptied_on_buildings(spark):
    own = [(k, "8812") for k in T.BUILDING_REGISTERS]
    assert kept(spark, ("building", "barn"), *own) == [("building", "barn"), *((k, "") for k in T.BUILDING_REGISTERS)]
    assert kept(spark, ("man_made", "silo"), *own) == [("man_made", "silo")]


def test_survey_numbers_keep_their_code(spark):
    first, second = T.SURVEY_PREFIXES
    surveyed = lambda value: kept(spark, ("building", "hut"), ("source:geometry:ref", value))[1:]
    assert surveyed(f"{first}99") == [("source:geometry:ref", first)]
    assert surveyed(f"\t {second}x/y") == [("source:geometry:ref", second)]
    assert surveyed(f"see {first}99") == [] and surveyed("") == []


def test_encyclopedia_links_are_emptied(spark):
    assert kept(spark, ("wikipedia", "fr:Pont"), ("bridge", "yes")) == [("wikipedia", ""), ("bridge", "yes")]


@pytest.mark.parametrize("key", T.WANTED)
def test_a_wanted_key_is_enough(spark, key):
    assert wanted(spark, "node", (key, "anything")) and wanted(spark, "relation", (key, "anything"))


def test_ways_need_any_tag_and_nodes_a_wanted_one(spark):
    assert wanted(spark, "way", ("smoothness", "bad")) and not wanted(spark, "node", ("smoothness", "bad"))
    assert not wanted(spark, "way") and not wanted(spark, "node")


def test_relations_of_two_types_are_wanted_as_such(spark):
    assert [wanted(spark, "relation", ("type", t)) for t in ("multipolygon", "building", "site", "")] == [True, True, False, False]


def test_sea_is_left_out_whatever_else_it_is(spark):
    sea = [(k, v) for k, values in T.EXCLUDED.items() for v in values]
    assert not any(wanted(spark, kind, tag, ("leisure", "park")) for tag in sea for kind in ("node", "way"))
    assert wanted(spark, "way", ("natural", "scree"), ("natural", "strait"))  # the first of repeated keys counts
    assert not wanted(spark, "way", ("natural", "strait"), ("natural", "scree"))


def test_lists_have_their_sizes():
    assert (len(T.WANTED), len(T.IGNORED), len(T.IGNORED_PREFIXES)) == (27, 26, 17)


@pytest.mark.parametrize("tags", [[], [("office", "it")]])
def test_no_tags_are_no_building(spark, tags):
    row = spark.createDataFrame([(tags,)], f"t {TAGS.simpleString()}").select(T.is_building(F.col("t")).alias("b")).first()
    assert row["b"] is False
