"""Tag rules as Column expressions over ARRAY<STRUCT<k, v>>; the first of repeated keys counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The keys and values that decide what an archive carries.
WANTED = [
    "building", "building:part", "highway", "landuse", "natural", "leisure", "water", "waterway", "amenity", "tourism",
    "bridge", "railway", "roller_coaster", "aerialway", "attraction", "barrier", "entrance", "door", "power", "historic",
    "emergency", "advertising", "man_made", "aeroway", "3dmr", "shop", "office",
]
IGNORED = [
    "created_by", "note", "fixme", "FIXME", "todo", "TODO", "wikimedia_commons", "import_uuid", "import", "old_name", "loc_name",
    "official_name", "alt_name", "operator", "phone", "fax", "email", "url", "website", "opening_hours", "description", "attribution",
    "check_date", "survey:date", "ref:bag", "ref:bygningsnr",
]
IGNORED_PREFIXES = [
    "addr:", "source", "name:", "alt_name:", "contact:", "is_in:", "operator:", "tiger:", "NHD:", "lacounty:", "nysgissam:",
    "ref:ruian:", "building:ruian:", "osak:", "gnis:", "yh:", "check_date:",
]
BUILDING_SOURCES = ["source", "source:geometry", "source:outline", "ref:bag"]
BUILDING_REGISTERS = ["ref:ruian:building", "ref:bygningsnr"]
SURVEY_PREFIXES = ["Gbg/", "Gba/"]
ALWAYS = ["addr:housenumber", "start_date", "type"]
EXCLUDED = {
    "landuse": ["salt_pond"],
    "natural": ["coastline", "bay", "strait"],
    "water": ["bay", "ocean", "sea"],
    "tidal": ["yes"],
    "waterway": ["tidal_channel"],
    "place": ["ocean", "sea", "bay", "strait", "sound", "fjord"],
}

_ANY_SPACE = r"^[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def is_building(tags: Column) -> Column:
    return F.exists(tags, lambda t: t["k"].isin("building", "building:part"))


def kept_value(k: Column, v: Column, building: Column) -> Column:
    """The stored value of one tag, or null if it is dropped; the first rule that applies decides."""
    surveyed = F.regexp_replace(v, _ANY_SPACE, "")
    by_prefix = F.coalesce(*(F.when(surveyed.startswith(p), F.lit(p)) for p in SURVEY_PREFIXES))
    return (
        F.when(building & k.isin(BUILDING_SOURCES), v)
        .when(building & k.isin(BUILDING_REGISTERS), F.lit(""))
        .when(building & (k == "source:geometry:ref"), by_prefix)
        .when(k.isin(ALWAYS), v)
        .when(k == "wikipedia", F.lit(""))
        .when(k.isin(IGNORED) | _any([k.startswith(p) for p in IGNORED_PREFIXES]), F.lit(None))
        .otherwise(v)
    )


def filtered(tags: Column) -> Column:
    """The tags an archive carries, in order; whether it is a building is told by all raw tags."""
    building = is_building(tags)
    kept = F.transform(tags, lambda t: F.struct(t["k"].alias("k"), kept_value(t["k"], t["v"], building).alias("v")))
    return F.filter(kept, lambda t: t["v"].isNotNull())


def value(tags: Column, key: str) -> Column:
    return F.get(F.filter(tags, lambda t: t["k"] == key), F.lit(0))["v"]


def excluded(tags: Column) -> Column:
    """Ocean and tidal features."""
    return _any([F.coalesce(value(tags, k).isin(v), F.lit(False)) for k, v in EXCLUDED.items()])


def has_wanted_key(tags: Column) -> Column:
    return F.exists(tags, lambda t: t["k"].isin(WANTED))


def node_wanted(tags: Column) -> Column:
    return ~excluded(tags) & has_wanted_key(tags)


def way_wanted(tags: Column) -> Column:
    return ~excluded(tags) & (F.size(tags) > 0)


def relation_wanted(tags: Column) -> Column:
    return ~excluded(tags) & (has_wanted_key(tags) | F.coalesce(value(tags, "type").isin("multipolygon", "building"), F.lit(False)))
