"""Map-shaped views over the driver's tables, as SQL that Spark and DuckDB both run.

Whole-number arithmetic first and one division last, so that both engines compute the same bits.
``view(spark, sf_dir, name)`` is a DataFrame of a view, ``text(name, "duckdb")`` its SQL for an oracle.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_ORDER_TAGS = {
    "1-URGENT": [("building", "'yes'"), ("source", "'BAG'"), ("source:date", "'2014'"), ("ref:bag", "CAST(o_orderkey AS STRING)"), ("start_date", "'1931'")],
    "2-HIGH": [("highway", "'residential'"), ("source", "'Bing'"), ("name", "'S' || CAST(o_orderkey % 100 AS STRING)"), ("name:de", "'x'")],
    "3-MEDIUM": [("natural", "'coastline'")],
    "4-NOT SPECIFIED": [("note", "'x'"), ("created_by", "'y'")],
    "5-LOW": [("water", "CASE WHEN o_orderkey % 2 = 0 THEN 'lake' ELSE 'sea' END"), ("wikipedia", "'en:x'")],
}
_STATUS_TAGS = {
    "F": [("addr:housenumber", "CAST(o_orderkey % 200 AS STRING)"), ("addr:street", "'s'")],
    "O": [
        ("building:part", "'yes'"),
        ("source:geometry:ref", "CASE o_orderkey % 3 WHEN 0 THEN 'Gbg/' WHEN 1 THEN ' Gba/' ELSE 'Picc/' END || CAST(o_orderkey AS STRING)"),
        ("ref:ruian:building", "CAST(o_orderkey AS STRING)"),
        ("ref:ruian:addr", "CAST(o_orderkey AS STRING)"),
    ],
}
_PART_TAGS = {
    "STANDARD": [("shop", "p_name")],
    "PROMO": [("amenity", "'bench'")],
    "ECONOMY": [("place", "'city'")],
    "MEDIUM": [("natural", "'bay'"), ("amenity", "'bench'")],
    "SMALL": [("entrance", "'yes'"), ("operator", "p_brand")],
    "LARGE": [("note", "'x'")],
}
_SEGMENT_TAGS = {
    "MACHINERY": [("type", "'multipolygon'")],
    "BUILDING": [("building", "'yes'"), ("type", "'building'")],
    "AUTOMOBILE": [("type", "'route'")],
    "FURNITURE": [("type", "'multipolygon'"), ("tidal", "'yes'")],
    "HOUSEHOLD": [("type", "'multipolygon'"), ("landuse", "'forest'"), ("website", "'x'")],
}

#: Of some thirty rows: broadcast to joins.  All else is shuffled to them, for a file's size says little of the rows that a
#: driver would hold, and a broadcast that starts too large can't be taken back.
_FEW = {"region", "nation", "fx_extract"}

#: Written for both; %...% marks what the dialects spell differently.
_VIEWS = {
    "fx_extract": """
        SELECT n_nationkey AS ext, n_name AS region_id, r_name AS continent,
               CAST(125000000 AS BIGINT) * (1 + (n_nationkey * 7) % 25) AS bytes
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_run": """
        SELECT ext, region_id, continent, bytes, CAST(row_number() OVER (ORDER BY total DESC, continent, bytes DESC) AS INT) AS seq
        FROM (SELECT *, CAST(sum(bytes) OVER (PARTITION BY continent) AS BIGINT) AS total FROM {fx_extract}) t""",
    "fx_node": """
        SELECT p_partkey + 1 AS id,
               ((470000000 + (p_partkey * 1048583) % 2000000) * 10 + (p_partkey % 9 - 4)) / 1e8 AS lat,
               ((85000000 + (p_partkey * 2097169) % 3000000) * 10 + (p_partkey % 7 - 3)) / 1e8 AS lon,
               %part% AS tags
        FROM {part}""",
    "fx_way": "SELECT o_orderkey + 1 AS id, %order% AS tags FROM {orders}",
    "fx_line": """
        SELECT l_orderkey, l_partkey, CAST(row_number() OVER (PARTITION BY l_orderkey
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS INT) AS pos
        FROM {lineitem}""",
    "fx_ref": """
        SELECT l_orderkey + 1 AS way_id, pos, l_partkey + 1 AS node_id FROM {fx_line}
        UNION ALL
        SELECT a.l_orderkey + 1, CAST(b.n + 1 AS INT), a.l_partkey + 1
        FROM {fx_line} a JOIN (SELECT l_orderkey, max(pos) AS n FROM {fx_line} GROUP BY l_orderkey) b ON a.l_orderkey = b.l_orderkey
        WHERE a.pos = 1 AND a.l_orderkey % 3 = 0""",
    "fx_relation": "SELECT c_custkey + 1 AS id, c_nationkey AS ext, %segment% AS tags FROM {customer}",
    "fx_member": """
        SELECT o_custkey + 1 AS relation_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS pos,
               o_orderkey + 1 AS way_id, CASE WHEN o_orderkey % 2 = 0 THEN 'outer' ELSE 'inner' END AS role
        FROM {orders}""",
    "fx_presence": """
        SELECT o_orderkey + 1 AS way_id, c_nationkey AS ext FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        UNION
        SELECT o_orderkey + 1, (c_nationkey + 5) % 25 FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderkey % 5 = 0
        UNION
        SELECT o_orderkey + 1, (c_nationkey + 1) % 25 FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderkey % 11 = 0""",
    "fx_region_node": "SELECT ext, id, lat, lon, tags FROM {fx_node} CROSS JOIN {fx_extract} WHERE (id - 1 + ext) % 17 <> 0",
    "fx_region_way": "SELECT ext, id, tags FROM {fx_way} JOIN {fx_presence} ON id = way_id",
    "fx_region_ref": "SELECT p.ext, r.way_id, r.pos, r.node_id FROM {fx_ref} r JOIN {fx_presence} p ON r.way_id = p.way_id",
    "fx_point": """
        SELECT event_id AS id, -105 + ((event_id * 7919) % 75000) / 1e3 AS lon, -35 + ((event_id * 104729) % 70000) / 1e3 AS lat
        FROM {events}""",
    "fx_box": """
        SELECT e.ext, b.ring, e.w0 + b.w AS w, e.s0 + b.s AS s, e.w0 + b.e AS e, e.s0 + b.n AS n
        FROM (SELECT ext, -100 + 12 * (ext % 5) AS w0, -30 + 12 * CAST(floor(ext / 5) AS INT) AS s0 FROM {fx_extract}) e
        CROSS JOIN (SELECT 0 AS ring, 0 AS w, 0 AS s, 14 AS e, 14 AS n UNION ALL SELECT 1, 4, 4, 8, 8 UNION ALL SELECT 2, 9, 9, 11, 11 UNION ALL SELECT 3, 9, 9, 11, 11) b
        WHERE b.ring = 0 OR (b.ring = 1 AND e.ext % 4 = 0) OR (b.ring >= 2 AND e.ext % 7 = 3)""",
    "fx_ring": """
        SELECT ext, ring, CAST(0 AS INT) AS pos, CAST(w AS DOUBLE) AS lon, CAST(s AS DOUBLE) AS lat FROM {fx_box}
        UNION ALL SELECT ext, ring, 1, CAST(e AS DOUBLE), CAST(s AS DOUBLE) FROM {fx_box}
        UNION ALL SELECT ext, ring, 2, CAST(e AS DOUBLE), CAST(n AS DOUBLE) FROM {fx_box}
        UNION ALL SELECT ext, ring, 3, CAST(w AS DOUBLE), CAST(n AS DOUBLE) FROM {fx_box}
        UNION ALL SELECT 100, 0, 0, CAST(w + 4 AS DOUBLE), CAST(s AS DOUBLE) FROM {fx_box} WHERE ext = 23 AND ring = 0
        UNION ALL SELECT 100, 0, 1, CAST(e AS DOUBLE), CAST(s AS DOUBLE) FROM {fx_box} WHERE ext = 23 AND ring = 0
        UNION ALL SELECT 100, 0, 2, CAST(e AS DOUBLE), CAST(n AS DOUBLE) FROM {fx_box} WHERE ext = 23 AND ring = 0
        UNION ALL SELECT 100, 0, 3, CAST(w + 4 AS DOUBLE), CAST(n AS DOUBLE) FROM {fx_box} WHERE ext = 23 AND ring = 0
        UNION ALL SELECT 101, 0, 0, CAST(w AS DOUBLE), CAST(s + 3 AS DOUBLE) FROM {fx_box} WHERE ext = 23 AND ring = 0
        UNION ALL SELECT 101, 0, 1, CAST(e + 5 AS DOUBLE), CAST(s + 3 AS DOUBLE) FROM {fx_box} WHERE ext = 23 AND ring = 0
        UNION ALL SELECT 101, 0, 2, CAST(e + 5 AS DOUBLE), CAST(n + 9 AS DOUBLE) FROM {fx_box} WHERE ext = 23 AND ring = 0
        UNION ALL SELECT 101, 0, 3, CAST(w AS DOUBLE), CAST(n + 9 AS DOUBLE) FROM {fx_box} WHERE ext = 23 AND ring = 0""",
    "fx_shape": """
        SELECT ext AS shape_id, region_id, continent, bytes,
               CASE ext WHEN 24 THEN 'HeaderBox' WHEN 23 THEN 'Supplement' ELSE 'Polygon' END AS kind,
               CASE WHEN ext = 23 THEN 100 END AS parent
        FROM {fx_extract}
        UNION ALL SELECT 100, 'ancestor', continent, bytes, 'Ancestor', 101 FROM {fx_extract} WHERE ext = 23
        UNION ALL SELECT 101, 'above', continent, bytes, 'Ancestor', CAST(NULL AS INT) FROM {fx_extract} WHERE ext = 23""",
    "fx_land": """
        SELECT r_regionkey AS rec, 'land' AS kind, -101.0 + 12 * r_regionkey AS w, -31.0 AS s, -91.0 + 12 * r_regionkey AS e, 31.0 AS n FROM {region}
        UNION ALL
        SELECT r_regionkey, 'lake', -97.0 + 12 * r_regionkey, -1.0, -95.0 + 12 * r_regionkey, 1.0 FROM {region}""",
    "fx_clip": "SELECT 3 AS ext, 47.0 AS s, 8.5 AS w, 47.25 AS n, 8.65 AS e",
    "fx_done": "SELECT region_id AS region, continent, bytes, CAST(12 AS BIGINT) AS tiles FROM {fx_extract} WHERE ext % 3 = 0",
    "fx_index_prev": """
        SELECT r_name AS name, r_name || '-20260101.pmtiles' AS file, CAST(1000 + 10 * r_regionkey AS BIGINT) AS tiles FROM {region}
        UNION ALL SELECT 'overlay-japan', 'overlay-japan-20260102.pmtiles', 58""",
    "fx_index_new": """
        SELECT r_name AS name, r_name || '-20260201.pmtiles' AS file, CAST(990 + 11 * r_regionkey AS BIGINT) AS tiles FROM {region} WHERE r_regionkey <> 2""",
}


def _tags(rules: dict[str, list[tuple[str, str]]], column: str, dialect: str) -> str:
    one = ("named_struct('k', '{}', 'v', {})" if dialect == "spark" else "struct_pack(k := '{}', v := {})").format
    many = (lambda x: f"array({x})") if dialect == "spark" else (lambda x: f"[{x}]")
    cases = " ".join(f"WHEN '{k}' THEN {many(', '.join(one(*t) for t in tags))}" for k, tags in rules.items())
    empty = "CAST(array() AS ARRAY<STRUCT<k: STRING, v: STRING>>)" if dialect == "spark" else "CAST([] AS STRUCT(k VARCHAR, v VARCHAR)[])"
    return f"CASE {column} {cases} ELSE {empty} END"


@cache
def text(name: str, dialect: str) -> str:
    """A view's SQL with {names} of the views and tables it reads."""
    join = "concat" if dialect == "spark" else "list_concat"
    filled = {
        "%part%": _tags(_PART_TAGS, "p_type", dialect),
        "%order%": f"{join}({_tags(_ORDER_TAGS, 'o_orderpriority', dialect)}, {_tags(_STATUS_TAGS, 'o_orderstatus', dialect)})",
        "%segment%": _tags(_SEGMENT_TAGS, "c_mktsegment", dialect),
    }
    sql = _VIEWS[name]
    for mark, value in filled.items():
        sql = sql.replace(mark, value)
    return sql.strip()


def reads(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """given: views that are there already, by name."""
    if given and name in given:
        return given[name]
    if name in TABLES:
        return table(spark, sf_dir, name)
    sql = text(name, "spark")
    parts = {n: view(spark, sf_dir, n, given) for n in reads(sql)}
    if " JOIN " in sql:  # elsewhere a hint would reach joins beyond the view
        parts = {n: part.hint("broadcast" if n in _FEW else "merge") for n, part in parts.items()}
    return spark.sql(sql, **parts)
