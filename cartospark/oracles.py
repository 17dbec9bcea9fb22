"""DuckDB SQL for the queries, written apart from the operators: long tables, joins and recursion instead of arrays."""

from __future__ import annotations

import re

from . import fixtures
from .functions import tags as T

_list = lambda values: "(" + ", ".join(f"'{x}'" for x in values) + ")"
_prefixed = " OR ".join(f"starts_with(t.k, '{p}')" for p in T.IGNORED_PREFIXES)
_excluded = " OR ".join(f"(k = '{k}' AND v IN {_list(v)})" for k, v in T.EXCLUDED.items())
_Y = "(1.0 - ln(tan(radians(least(greatest({0}, -85.05112878), 85.05112878))) + 1.0 / cos(radians(least(greatest({0}, -85.05112878), 85.05112878)))) / pi()) / 2.0 * 8192.0"
_X = "(({0}) + 180.0) / 360.0 * 8192.0"
_TILE = "CAST(least(greatest(floor({0}), 0), 8191) AS INT)"
tile_x = lambda c: _TILE.format(_X.format(c))
tile_y = lambda c: _TILE.format(_Y.format(c))
_q = lambda c: f"CAST(round({c} * 1e7) AS INT)"
_north = lambda y: f"degrees(atan(sinh(pi() * (1.0 - 2.0 * ({y}) / 8192.0))))"
_west = lambda x: f"({x}) / 8192.0 * 360.0 - 180.0"


def _walk(source: str, keys: str) -> str:
    """Tiles of segments (keys, x0, y0, x1, y1), walked from grid line to grid line."""
    first = lambda c, d, o: f"CASE WHEN {d} = 0 THEN CAST('inf' AS DOUBLE) ELSE ((floor({c}) + (CASE WHEN {d} > 0 THEN 1 ELSE 0 END)) - {o}) / {d} END"
    per = lambda d: f"(CASE WHEN {d} = 0 THEN CAST('inf' AS DOUBLE) ELSE 1.0 / abs({d}) END)"
    return f"""
        walk AS (
            SELECT {keys}, x1 - x0 AS dx, y1 - y0 AS dy, CAST(floor(x1) AS BIGINT) AS ex, CAST(floor(y1) AS BIGINT) AS ey,
                   CAST(floor(x0) AS BIGINT) AS cx, CAST(floor(y0) AS BIGINT) AS cy,
                   {first('x0', '(x1 - x0)', 'x0')} AS tx, {first('y0', '(y1 - y0)', 'y0')} AS ty,
                   abs(floor(x1) - floor(x0)) + abs(floor(y1) - floor(y0)) + 2 AS budget, FALSE AS corner, CAST(0 AS BIGINT) AS px, CAST(0 AS BIGINT) AS py
            FROM {source}
            UNION ALL
            SELECT {keys}, dx, dy, ex, ey,
                   cx + CASE WHEN ty < tx THEN 0 ELSE CAST(sign(dx) AS BIGINT) END, cy + CASE WHEN tx < ty THEN 0 ELSE CAST(sign(dy) AS BIGINT) END,
                   CASE WHEN ty < tx THEN tx ELSE tx + {per('dx')} END, CASE WHEN tx < ty THEN ty ELSE ty + {per('dy')} END,
                   budget - 1, NOT (tx < ty) AND NOT (ty < tx), cx, cy
            FROM walk WHERE budget > 0 AND NOT (cx = ex AND cy = ey) AND abs(ex - cx) <= 8191),
        touched AS (
            SELECT {keys}, cx AS x, cy AS y FROM walk
            UNION ALL SELECT {keys}, cx, py FROM walk WHERE corner
            UNION ALL SELECT {keys}, px, cy FROM walk WHERE corner)"""


PARTS = {
    "raw_tag": """
        SELECT 'node' AS kind, id, generate_subscripts(tags, 1) AS pos, unnest(tags) AS t FROM fx_node
        UNION ALL SELECT 'way', id, generate_subscripts(tags, 1), unnest(tags) FROM fx_way
        UNION ALL SELECT 'relation', id, generate_subscripts(tags, 1), unnest(tags) FROM fx_relation""",
    "is_building": "SELECT kind, id, bool_or(t.k IN ('building', 'building:part')) AS b FROM raw_tag GROUP BY kind, id",
    "kept_tag": f"""
        SELECT kind, id, pos, k, v FROM (
            SELECT kind, id, pos, t.k AS k, CASE
                WHEN b AND t.k IN {_list(T.BUILDING_SOURCES)} THEN t.v
                WHEN b AND t.k IN {_list(T.BUILDING_REGISTERS)} THEN ''
                WHEN b AND t.k = 'source:geometry:ref' THEN CASE WHEN ltrim(t.v) LIKE 'Gbg/%' THEN 'Gbg/' WHEN ltrim(t.v) LIKE 'Gba/%' THEN 'Gba/' END
                WHEN t.k IN {_list(T.ALWAYS)} THEN t.v
                WHEN t.k = 'wikipedia' THEN ''
                WHEN t.k IN {_list(T.IGNORED)} OR {_prefixed} THEN NULL
                ELSE t.v END AS v
            FROM raw_tag JOIN is_building USING (kind, id)) x
        WHERE v IS NOT NULL""",
    "first_tag": "SELECT kind, id, k, arg_min(v, pos) AS v FROM kept_tag GROUP BY kind, id, k",
    "tag_facts": f"""
        SELECT kind, id, bool_or({_excluded}) AS excluded, bool_or(k IN {_list(T.WANTED)}) AS wanted,
               bool_or(k = 'type' AND v IN ('multipolygon', 'building')) AS area
        FROM first_tag GROUP BY kind, id""",
    "n_tag": "SELECT kind, id, count(*) AS n FROM kept_tag GROUP BY kind, id",
    "poi": f"""
        SELECT ext, n.id, {_q('lat')} AS lat_q, {_q('lon')} AS lon_q, {tile_x('lon')} AS x, {tile_y('lat')} AS y
        FROM fx_region_node n JOIN tag_facts f ON f.kind = 'node' AND f.id = n.id WHERE wanted AND NOT excluded""",
    "rel": """
        SELECT r.id, r.ext FROM fx_relation r JOIN tag_facts f ON f.kind = 'relation' AND f.id = r.id
        WHERE NOT excluded AND (wanted OR area) AND EXISTS (SELECT 1 FROM fx_member m WHERE m.relation_id = r.id)""",
    "way": """
        SELECT w.ext, w.id, m.way_id IS NOT NULL AS is_member, CAST(coalesce(n.n, 0) AS INT) AS n_tags
        FROM fx_region_way w
        LEFT JOIN (SELECT DISTINCT rel.ext, fx_member.way_id FROM rel JOIN fx_member ON relation_id = rel.id) m ON m.ext = w.ext AND m.way_id = w.id
        LEFT JOIN n_tag n ON n.kind = 'way' AND n.id = w.id
        LEFT JOIN tag_facts f ON f.kind = 'way' AND f.id = w.id
        WHERE m.way_id IS NOT NULL OR (coalesce(n.n, 0) > 0 AND NOT coalesce(excluded, FALSE))""",
    "vertex": f"""
        SELECT r.ext, r.way_id, r.pos, {_q('lat')} AS lat_q, {_q('lon')} AS lon_q
        FROM fx_region_ref r JOIN fx_region_node n ON n.ext = r.ext AND n.id = r.node_id""",
    "thinned": """
        SELECT ext, way_id, pos, lat_q, lon_q FROM (
            SELECT *, lag(lat_q) OVER w AS la, lag(lon_q) OVER w AS lo, count(*) OVER (PARTITION BY ext, way_id) AS resolved
            FROM vertex WINDOW w AS (PARTITION BY ext, way_id ORDER BY pos)) x
        WHERE resolved >= 2 AND (la IS NULL OR la <> lat_q OR lo <> lon_q)""",
    "closed_way": "SELECT way_id, count(*) > 2 AND arg_min(node_id, pos) = arg_max(node_id, pos) AS closed FROM fx_ref GROUP BY way_id",
    "ends": """
        SELECT ext, way_id, max(pos) AS last, arg_min(lat_q, pos) AS la, arg_min(lon_q, pos) AS lo,
               arg_max(lat_q, pos) <> arg_min(lat_q, pos) OR arg_max(lon_q, pos) <> arg_min(lon_q, pos) AS apart
        FROM thinned GROUP BY ext, way_id""",
    "line": """
        SELECT ext, way_id, closed, CAST(row_number() OVER (PARTITION BY ext, way_id ORDER BY pos) - 1 AS INT) AS pos, lat_q, lon_q,
               count(*) OVER (PARTITION BY ext, way_id) AS n
        FROM (SELECT ext, way_id, pos, lat_q, lon_q FROM thinned
              UNION ALL SELECT ext, e.way_id, last + 1, la, lo FROM ends e JOIN closed_way c USING (way_id) WHERE closed AND apart) x
        JOIN closed_way USING (way_id)""",
    "geom": "SELECT * FROM line WHERE n >= 2",
    "kept_geom": "SELECT g.* FROM geom g JOIN way w ON w.ext = g.ext AND w.id = g.way_id",
    "seg": f"""
        SELECT ext, way_id, pos, {_X.format('lon_q / 1e7')} AS x0, {_Y.format('lat_q / 1e7')} AS y0,
               lead({_X.format('lon_q / 1e7')}) OVER w AS x1, lead({_Y.format('lat_q / 1e7')}) OVER w AS y1
        FROM kept_geom WINDOW w AS (PARTITION BY ext, way_id ORDER BY pos)""",
    "real_seg": "SELECT * FROM seg WHERE x1 IS NOT NULL",
    "walk": _walk("real_seg", "ext, way_id, pos"),
    "way_tile": f"""
        SELECT DISTINCT ext, way_id, CAST(least(greatest(x, 0), 8191) AS INT) AS x, CAST(least(greatest(y, 0), 8191) AS INT) AS y FROM (
            SELECT ext, way_id, x, y FROM touched
            UNION ALL SELECT ext, way_id, {tile_x('lon_q / 1e7')}, {tile_y('lat_q / 1e7')} FROM kept_geom) t""",
    "relation_tile": """
        SELECT DISTINCT rel.ext, rel.id AS relation_id, t.x, t.y
        FROM rel JOIN fx_member m ON m.relation_id = rel.id JOIN way_tile t ON t.ext = rel.ext AND t.way_id = m.way_id""",
    "record": """
        SELECT DISTINCT s.ext, s.relation_id, m.way_id
        FROM (SELECT ext, relation_id FROM relation_tile GROUP BY ext, relation_id HAVING count(*) > 1) s
        JOIN fx_member m ON m.relation_id = s.relation_id JOIN kept_geom g ON g.ext = s.ext AND g.way_id = m.way_id""",
    "element": """
        SELECT ext, x, y, 'node' AS kind, id FROM poi
        UNION ALL SELECT ext, x, y, 'way', way_id FROM way_tile
        UNION ALL SELECT ext, x, y, 'relation', relation_id FROM relation_tile""",
    "merged": """
        SELECT continent, x, y, kind, id, ext FROM (
            SELECT e.*, r.continent, row_number() OVER (PARTITION BY r.continent, x, y, kind, id ORDER BY seq) AS k FROM element e JOIN fx_run r USING (ext)) t
        WHERE k = 1""",
    "edge": """
        SELECT ext, ring, lon AS x1, lat AS y1, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS x2, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS y2
        FROM fx_ring WINDOW w AS (PARTITION BY ext, ring ORDER BY pos)""",
    "inside": """
        SELECT ext, id FROM (
            SELECT e.ext, e.ring, p.id, count(*) FILTER (WHERE (y1 > lat) <> (y2 > lat) AND lon < (x1 - x2) * (lat - y2) / CASE WHEN y1 = y2 THEN NULL ELSE y1 - y2 END + x2) % 2 AS odd
            FROM edge e CROSS JOIN fx_point p GROUP BY e.ext, e.ring, p.id) x
        GROUP BY ext, id HAVING sum(odd) % 2 = 1""",
    "above": """
        SELECT shape_id, parent FROM fx_shape WHERE parent IS NOT NULL
        UNION SELECT a.shape_id, s.parent FROM above a JOIN fx_shape s ON s.shape_id = a.parent WHERE s.parent IS NOT NULL""",
    "within": "SELECT a.shape_id, i.id, count(*) AS n FROM above a JOIN inside i ON i.ext = a.parent GROUP BY a.shape_id, i.id",
    "effective": """
        SELECT i.ext AS shape_id, i.id FROM inside i LEFT JOIN (SELECT shape_id, count(*) AS n FROM above GROUP BY shape_id) b ON b.shape_id = i.ext
        LEFT JOIN within w ON w.shape_id = i.ext AND w.id = i.id WHERE coalesce(b.n, 0) = coalesce(w.n, 0)""",
    "orphan": """
        SELECT id FROM fx_point WHERE id NOT IN (
            SELECT id FROM effective JOIN fx_shape USING (shape_id) WHERE kind = 'Polygon' AND bytes <= 3000000000)""",
}


def sql(select: str, given: tuple[str, ...] = ()) -> str:
    """The statement with all views that it needs, in order of need; those given are defined elsewhere."""
    done: dict[str, str] = {}

    def need(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b\w+\b", re.sub(r"'[^']*'", "", text))):
            name = "walk" if name == "touched" else name
            if name in given or name in done or name not in PARTS and name not in fixtures._VIEWS:
                continue
            body = PARTS.get(name) or fixtures.text(name, "duckdb")
            if name in fixtures._VIEWS:
                body = re.sub(r"\{(\w+)\}", r"\1", body)
            done[name] = ""
            need(body.replace("walk AS (", "", 1) if name == "walk" else body)
            done.pop(name)
            # what several views read is computed once
            done[name] = body.strip() if name == "walk" else f"{name} AS {'MATERIALIZED ' * (name in ('inside', 'effective', 'orphan'))}({body})"

    need(select)
    return f"WITH RECURSIVE {', '.join(done.values())} {select}" if done else select


# The cover, a choice a row: recursion over the list of chosen extracts, with classes of points and candidates as lists of one row.
_candidate = """
        SELECT s.shape_id, s.kind = 'HeaderBox' AS forced, s.bytes, e.id FROM fx_shape s
        LEFT JOIN effective e ON e.shape_id = s.shape_id AND (s.kind = 'Polygon' OR e.id IN (SELECT id FROM orphan))
        WHERE s.bytes <= 3000000000 AND s.kind <> 'Ancestor' AND (e.id IS NOT NULL OR s.kind = 'HeaderBox')"""


def _cheapest(open_: str, barred: str) -> str:
    """The candidate with the fewest bytes for each point of the open classes, the first of equals; null if none gains."""
    gain = f"list_sum(list_transform(list_filter({open_}, lambda x: list_contains(x.m, c.c)), lambda x: x.n))"
    priced = f"list_transform(list_filter(cands, lambda c: NOT list_contains({barred}, c.c)), lambda c: struct_pack(r := CAST(c.b AS DOUBLE) / {gain}, c := c.c))"
    return f"list_sort(list_filter({priced}, lambda p: p.r IS NOT NULL))[1].c"


def _pruned(name: str, source: str) -> str:
    """Largest first, an extract goes if others cover all that it does."""
    by_size = "list_transform(list_sort(list_transform(chosen, lambda c, i: struct_pack(b := -list_filter(cands, lambda y: y.c = c)[1].b, i := i, c := c))), lambda o: o.c)"
    spare = "len(list_filter(cls, lambda x: list_contains(x.m, sized[k + 1]) AND len(list_intersect(x.m, chosen)) = 1)) = 0"
    return f"""
    {name} AS (
        SELECT 0 AS k, chosen, {by_size} AS sized FROM {source}, board
        UNION ALL
        SELECT k + 1, CASE WHEN NOT list_contains(forced, sized[k + 1]) AND {spare} THEN list_filter(chosen, lambda c: c <> sized[k + 1]) ELSE chosen END, sized
        FROM {name}, board WHERE k < len(sized))"""


def _last(name: str) -> str:
    return f"(SELECT chosen FROM {name} ORDER BY k DESC LIMIT 1)"


_uncovered = "list_filter(cls, lambda x: NOT list_has_any(x.m, chosen))"
_left = "list_filter(cls, lambda x: list_contains(x.m, sized[i]) AND len(list_intersect(x.m, chosen)) = 1 AND NOT list_has_any(x.m, picks))"
_cover = f"""
    candidate AS MATERIALIZED ({_candidate}),
    board AS MATERIALIZED (
        SELECT (SELECT coalesce(list(struct_pack(m := m, n := n) ORDER BY m), []) FROM (SELECT m, CAST(count(*) AS BIGINT) AS n FROM (SELECT id, list(shape_id ORDER BY shape_id) AS m FROM candidate WHERE id IS NOT NULL GROUP BY id) a GROUP BY m) b) AS cls,
               (SELECT list(struct_pack(c := shape_id, b := bytes) ORDER BY shape_id) FROM (SELECT DISTINCT shape_id, bytes FROM candidate) a) AS cands,
               (SELECT coalesce(list(shape_id ORDER BY shape_id), []) FROM (SELECT DISTINCT shape_id FROM candidate WHERE forced) a) AS forced),
    greedy AS (
        SELECT 0 AS k, forced AS chosen FROM board
        UNION ALL
        SELECT k + 1, list_append(chosen, best) FROM (SELECT k, chosen, {_cheapest(_uncovered, 'chosen')} AS best FROM greedy, board) x WHERE best IS NOT NULL),
    {_pruned('once', f'(SELECT {_last("greedy")} AS chosen) g')},
    swap AS (
        SELECT 0 AS k, 0 AS i, FALSE AS trying, CAST([] AS INT[]) AS picks, CAST(0 AS BIGINT) AS spent, chosen, list_transform(list_sort(list_transform(chosen, lambda c, j: struct_pack(b := -list_filter(cands, lambda y: y.c = c)[1].b, j := j, c := c))), lambda o: o.c) AS sized
        FROM (SELECT {_last('once')} AS chosen) g, board
        UNION ALL
        SELECT k + 1, CASE WHEN trying THEN i ELSE i + 1 END,
               CASE WHEN trying THEN NOT whole AND other IS NOT NULL AND spent + price < own ELSE NOT list_contains(forced, sized[i + 1]) AND list_contains(chosen, sized[i + 1]) END,
               CASE WHEN trying AND NOT whole AND other IS NOT NULL AND spent + price < own THEN list_append(picks, other) WHEN trying THEN picks ELSE CAST([] AS INT[]) END,
               CASE WHEN trying AND other IS NOT NULL AND NOT whole THEN spent + price WHEN trying THEN spent ELSE 0 END,
               CASE WHEN trying AND whole AND spent < own THEN list_concat(list_filter(chosen, lambda c: c <> sized[i]), picks) ELSE chosen END, sized
        FROM (SELECT *, list_filter(cands, lambda y: y.c = other)[1].b AS price, list_filter(cands, lambda y: y.c = sized[i])[1].b AS own FROM (
            SELECT s.*, board.*, len({_left}) = 0 AS whole, CASE WHEN trying THEN {_cheapest(_left, 'list_append(list_concat(chosen, picks), sized[i])')} END AS other FROM swap s, board) x) y
        WHERE trying OR i < len(sized)),
    {_pruned('twice', f'(SELECT {_last("swap")} AS chosen) g')},
    cover AS MATERIALIZED (SELECT unnest(chosen) AS shape_id, unnest(range(len(chosen))) AS place FROM (SELECT {_last('twice')} AS chosen) g)"""

_set_cover = """SELECT shape_id, CAST(place AS INT) AS place, kind = 'HeaderBox' AS forced, region_id, bytes FROM cover JOIN fx_shape USING (shape_id)"""
_plan_regions = """
    SELECT shape_id, region_id, continent, bytes, kind <> 'Supplement' AS whole, CAST(row_number() OVER (PARTITION BY shape_id ORDER BY w, s) - 1 AS INT) AS box, w, s, e, n
    FROM cover JOIN fx_shape USING (shape_id) LEFT JOIN (
        SELECT DISTINCT shape_id AS boxed, round(greatest(floor(lon) - 0.3, -180.0), 6) AS w, round(greatest(floor(lat) - 0.3, -90.0), 6) AS s, round(least(floor(lon) + 1.3, 180.0), 6) AS e, round(least(floor(lat) + 1.3, 90.0), 6) AS n
        FROM (SELECT id, min(shape_id) AS shape_id FROM candidate JOIN cover USING (shape_id) WHERE id IS NOT NULL GROUP BY id HAVING count(*) = 1) a JOIN fx_point USING (id)) b
    ON kind = 'Supplement' AND boxed = shape_id"""

_hilbert = """
    hil AS (
        SELECT x, y, CAST(x AS BIGINT) AS px, CAST(y AS BIGINT) AS py, CAST(4096 AS BIGINT) AS s, CAST(0 AS BIGINT) AS d FROM spot
        UNION ALL
        SELECT x, y,
            CASE WHEN (py & s) <> 0 THEN px & (s - 1) WHEN (px & s) <> 0 THEN s - 1 - (py & (s - 1)) ELSE py & (s - 1) END,
            CASE WHEN (py & s) <> 0 THEN py & (s - 1) WHEN (px & s) <> 0 THEN s - 1 - (px & (s - 1)) ELSE px & (s - 1) END,
            s // 2, d + s * s * xor(CASE WHEN (px & s) <> 0 THEN CAST(3 AS BIGINT) ELSE 0 END, CASE WHEN (py & s) <> 0 THEN CAST(1 AS BIGINT) ELSE 0 END)
        FROM hil WHERE s > 0)"""

_hilbert_back = """
    back AS (
        SELECT tile_id, tile_id - 22369621 AS t, CAST(1 AS BIGINT) AS s, CAST(0 AS BIGINT) AS x, CAST(0 AS BIGINT) AS y FROM code
        UNION ALL
        SELECT tile_id, t // 4, s * 2,
            s * ((t // 2) & 1) + CASE WHEN xor(t, (t // 2) & 1) & 1 = 1 THEN x WHEN (t // 2) & 1 = 1 THEN s - 1 - y ELSE y END,
            s * (xor(t, (t // 2) & 1) & 1) + CASE WHEN xor(t, (t // 2) & 1) & 1 = 1 THEN y WHEN (t // 2) & 1 = 1 THEN s - 1 - x ELSE x END
        FROM back WHERE s < 8192)"""


def _with(select: str, *ctes: str) -> str:
    """A statement with further views before the final select."""
    given = tuple(re.findall(r"(\w+) AS \(", " ".join(ctes)))
    tail = " ".join([*ctes, select])
    whole = sql(tail, given)
    head = whole[: len(whole) - len(tail)].strip()
    return f"{head + ', ' if head else 'WITH RECURSIVE '}{', '.join(ctes)} {select}"


_far = f"""far AS (
        SELECT p.id, {_X.format('p.lon')} AS x0, {_Y.format('p.lat')} AS y0,
               {_X.format('p.lon + (q.lon - p.lon) / 10')} AS x1, {_Y.format('p.lat + (q.lat - p.lat) / 10')} AS y1
        FROM (SELECT id, 8.0 + lon / 40 AS lon, 47.0 + lat / 40 AS lat FROM fx_point) p
        JOIN (SELECT id - 1 AS id, 8.0 + lon / 40 AS lon, 47.0 + lat / 40 AS lat FROM fx_point) q USING (id))"""

_land_cells = """
    SELECT p.id FROM fx_point p WHERE EXISTS (
        SELECT 1 FROM cell c JOIN fx_land l ON l.kind = 'land' WHERE c.id = p.id AND (
            (yc > l.s AND yc < l.n AND xc >= l.w AND xc < l.e
             AND NOT EXISTS (SELECT 1 FROM fx_land k WHERE k.kind = 'lake' AND yc > k.s AND yc < k.n AND xc >= k.w AND xc < k.e))
            OR EXISTS (SELECT 1 FROM coast o WHERE o.r = c.r AND o.c = c.c)))"""
_cell = """cell AS (
        SELECT id, floor((90.0 - lat) / 0.02) AS r, floor((lon + 180.0) / 0.02) AS c, 90.0 - (floor((90.0 - lat) / 0.02) + 0.5) * 0.02 AS yc, (floor((lon + 180.0) / 0.02) + 0.5) * 0.02 - 180.0 AS xc
        FROM fx_point)"""
_coast = """side AS (
        SELECT CAST(w AS DOUBLE) AS x1, CAST(s AS DOUBLE) AS y1, CAST(e AS DOUBLE) AS x2, CAST(s AS DOUBLE) AS y2 FROM fx_land WHERE kind = 'land'
        UNION ALL SELECT e, s, e, n FROM fx_land WHERE kind = 'land'
        UNION ALL SELECT e, n, w, n FROM fx_land WHERE kind = 'land'
        UNION ALL SELECT w, n, w, s FROM fx_land WHERE kind = 'land'),
    coast AS (
        SELECT DISTINCT floor((90.0 - (y1 + (y2 - y1) * (t / n))) / 0.02) AS r, floor((x1 + (x2 - x1) * (t / n) + 180.0) / 0.02) AS c
        FROM (SELECT *, unnest(range(CAST(n AS BIGINT) + 1)) AS t FROM (SELECT *, greatest(ceil(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) / (0.02 / 2.0)), 1) AS n FROM side) a) b)"""

_ring_samples = """
    SELECT g.ext, g.ring, count(*) AS n, round(min(g.lon), 9) AS lon0, round(max(g.lat), 9) AS lat1 FROM (
        SELECT b.*, w + step * (i + 0.5) AS lon, s + step * (j + 0.5) AS lat FROM (
            SELECT *, unnest(range(CAST(ceil((n - s) / step) AS BIGINT) + 1)) AS j FROM (
                SELECT *, unnest(range(CAST(ceil((e - w) / step) AS BIGINT) + 1)) AS i FROM (
                    SELECT *, least(greatest(sqrt(greatest((e - w) * (n - s), 1e-12)) / 40, 0.002), 0.25) AS step FROM (
                        SELECT ext, ring, min(lon) AS w, max(lon) AS e, min(lat) AS s, max(lat) AS n FROM fx_ring GROUP BY ext, ring) z) a) c) b
        WHERE w + step * (i + 0.5) < e AND s + step * (j + 0.5) < n) g
    WHERE g.lon >= g.w AND g.lon < g.e AND g.lat >= g.s AND g.lat < g.n
    GROUP BY g.ext, g.ring"""

_islands = """
    SELECT rec, count(*) AS n, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat FROM (
        SELECT id AS rec, lon, lat FROM spotted WHERE inner_
        UNION ALL SELECT id, fx, fy FROM first_ f WHERE NOT EXISTS (SELECT 1 FROM spotted s WHERE s.id = f.id AND inner_)) x
    GROUP BY rec"""
_island_parts = """isle AS (SELECT id, lon, lat, (id % 7 + 1) / 50.0 AS z, id % 2 = 0 AS diamond FROM fx_point),
    corner AS (
        SELECT id, diamond, 0 AS pos, lon + z * -1.0 AS x, lat + z * 0.0 AS y FROM isle WHERE diamond
        UNION ALL SELECT id, diamond, 1, lon + z * 0.0, lat + z * -1.0 FROM isle WHERE diamond
        UNION ALL SELECT id, diamond, 2, lon + z * 1.0, lat + z * 0.0 FROM isle WHERE diamond
        UNION ALL SELECT id, diamond, 3, lon + z * 0.0, lat + z * 1.0 FROM isle WHERE diamond
        UNION ALL SELECT id, diamond, 0, lon + z * 0.0, lat + z * 0.0 FROM isle WHERE NOT diamond
        UNION ALL SELECT id, diamond, 1, lon + z * 1.0, lat + z * 0.0 FROM isle WHERE NOT diamond
        UNION ALL SELECT id, diamond, 2, lon + z * 1.0, lat + z * 0.001 FROM isle WHERE NOT diamond),
    box AS (SELECT id, min(x) AS w, max(x) AS e, min(y) AS s, max(y) AS n, max(greatest(abs(x), abs(y))) AS far FROM corner GROUP BY id),
    small AS (SELECT * FROM box WHERE e - w < 0.25 AND n - s < 0.25 AND far >= 0.1),
    first_ AS (SELECT id, x AS fx, y AS fy FROM corner JOIN small USING (id) WHERE pos = 0),
    side AS (SELECT id, x AS x1, y AS y1, coalesce(lead(x) OVER o, first_value(x) OVER o) AS x2, coalesce(lead(y) OVER o, first_value(y) OVER o) AS y2 FROM corner WINDOW o AS (PARTITION BY id ORDER BY pos)),
    mid AS (SELECT id, w + (e - w) * (i + 0.5) / 5.0 AS lon, s + (n - s) * (j + 0.5) / 5.0 AS lat FROM small CROSS JOIN range(5) a(i) CROSS JOIN range(5) b(j)),
    spotted AS (
        SELECT m.id, m.lon, m.lat, count(*) FILTER (WHERE (y1 > lat) <> (y2 > lat) AND lon < (x1 - x2) * (lat - y2) / CASE WHEN y1 = y2 THEN NULL ELSE y1 - y2 END + x2) % 2 = 1 AS inner_
        FROM mid m JOIN side USING (id) GROUP BY m.id, m.lon, m.lat)"""

ORACLES = {
    "tag_filter": sql("SELECT kind, id, CAST(row_number() OVER (PARTITION BY kind, id ORDER BY pos) - 1 AS INT) AS pos, k, v FROM kept_tag"),
    "ocean_exclusion": sql(
        "SELECT a.kind, a.id, coalesce(excluded, FALSE) AS excluded FROM (SELECT 'node' AS kind, id FROM fx_node UNION ALL SELECT 'way', id FROM fx_way UNION ALL SELECT 'relation', id FROM fx_relation) a LEFT JOIN tag_facts f ON f.kind = a.kind AND f.id = a.id"
    ),
    "poi_nodes": sql("SELECT ext, id, lat_q, lon_q, x, y FROM poi"),
    "kept_relations": sql("SELECT rel.id, rel.ext, CAST(m.pos - 1 AS INT) AS pos, m.way_id, m.role FROM rel JOIN fx_member m ON m.relation_id = rel.id"),
    "kept_ways": sql("SELECT ext, id, is_member, n_tags FROM way"),
    "quantize_coords": sql(f"SELECT id, {_q('lat')} AS lat_q, {_q('lon')} AS lon_q, {_q('lat')} / 1e7 AS lat_back, {_q('lon')} / 1e7 AS lon_back FROM fx_node"),
    "tile_assign": sql(f"SELECT id, {tile_x('lon')} AS x, {tile_y('lat')} AS y, {tile_x(_q('lon') + ' / 1e7')} AS qx, {tile_y(_q('lat') + ' / 1e7')} AS qy FROM fx_node"),
    "tile_extent": sql(
        f"SELECT x, y, round({_west('x')}, 9) AS w, round({_north('y + 1')}, 9) AS s, round({_west('x + 1')}, 9) AS e, round({_north('y')}, 9) AS n FROM (SELECT DISTINCT {tile_x('lon')} AS x, {tile_y('lat')} AS y FROM fx_node) t"
    ),
    "tiles_for_bbox": sql(
        f"SELECT ext, CAST(x AS INT) AS x, CAST(unnest(range(y0, y1 + 1)) AS INT) AS y FROM (SELECT *, unnest(range({tile_x('w')}, {tile_x('e')} + 1)) AS x, {tile_y('n')} AS y0, {tile_y('s')} AS y1 FROM fx_clip) t"
    ),
    "hilbert_order": _with("SELECT x, y, d + 22369621 AS tile_id FROM hil WHERE s = 0", f"spot AS (SELECT DISTINCT {tile_x('lon')} AS x, {tile_y('lat')} AS y FROM fx_node)", _hilbert),
    "hilbert_inverse": _with(
        "SELECT tile_id, CAST(x AS INT) AS x, CAST(y AS INT) AS y FROM back WHERE s = 8192", "code AS (SELECT DISTINCT 22369621 + o_orderkey * 7919 % 67108864 AS tile_id FROM orders)", _hilbert_back
    ),
    "segment_tiles": _with("SELECT DISTINCT id, CAST(least(greatest(x, 0), 8191) AS INT) AS x, CAST(least(greatest(y, 0), 8191) AS INT) AS y FROM touched", _far, _walk("far", "id")),
    "way_geometry": sql("SELECT ext, way_id, closed, pos, lat_q, lon_q FROM geom"),
    "way_tiles": sql("SELECT ext, way_id, x, y FROM way_tile"),
    "relation_tiles": sql("SELECT ext, relation_id, x, y FROM relation_tile"),
    "whole_relations": sql("SELECT ext, relation_id, way_id FROM record"),
    "clip_tiles": sql(
        f"SELECT ext, kind, count(*) AS n, CAST(sum(x) AS BIGINT) AS sum_x FROM element e WHERE NOT EXISTS (SELECT 1 FROM fx_clip c WHERE c.ext = e.ext) OR EXISTS (SELECT 1 FROM fx_clip c WHERE c.ext = e.ext AND x BETWEEN {tile_x('c.w')} AND {tile_x('c.e')} AND y BETWEEN {tile_y('c.n')} AND {tile_y('c.s')}) GROUP BY ext, kind"
    ),
    "bake_stats": sql(
        """SELECT r.ext, (SELECT count(*) FROM poi p WHERE p.ext = r.ext) AS pois, (SELECT count(DISTINCT way_id) FROM kept_geom g WHERE g.ext = r.ext) AS ways,
        (SELECT count(DISTINCT relation_id) FROM relation_tile t WHERE t.ext = r.ext) AS relations, (SELECT count(DISTINCT relation_id) FROM record c WHERE c.ext = r.ext) AS records FROM fx_run r"""
    ),
    "tile_counts": sql(
        "SELECT continent, x, y, count(*) FILTER (WHERE kind = 'node') AS nodes, count(*) FILTER (WHERE kind = 'way') AS ways, count(*) FILTER (WHERE kind = 'relation') AS relations FROM merged GROUP BY continent, x, y"
    ),
    "merge_dedup": sql("SELECT continent, x, y, kind, id, ext FROM merged"),
    "archive_index": sql(
        f"""SELECT a.continent AS name, tiles, cells, round({_north('y1 + 1')}, 9) AS min_lat, round({_west('x0')}, 9) AS min_lon, round({_north('y0')}, 9) AS max_lat, round({_west('x1 + 1')}, 9) AS max_lon
        FROM (SELECT continent, count(*) AS tiles, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM (SELECT DISTINCT continent, x, y FROM merged) t GROUP BY continent) a
        JOIN (SELECT continent, string_agg(CAST(cell AS VARCHAR), ' ' ORDER BY cell) AS cells FROM (SELECT DISTINCT continent, (y // 128) * 64 + x // 128 AS cell FROM merged) t GROUP BY continent) b ON a.continent = b.continent"""
    ),
    "coverage_cells": sql(f"SELECT CAST((y // 128) * 64 + x // 128 AS INT) AS cell, count(*) AS tiles FROM (SELECT DISTINCT {tile_x('lon')} AS x, {tile_y('lat')} AS y FROM fx_point) t GROUP BY 1"),
    "encode_roundtrip": sql(
        """SELECT continent, x, y, CAST(count(*) FILTER (WHERE kind = 'node') AS INT) AS nodes, CAST(count(*) FILTER (WHERE kind = 'way') AS INT) AS ways, CAST(count(*) FILTER (WHERE kind = 'relation') AS INT) AS relations,
        CAST(coalesce(sum(m.id) FILTER (WHERE kind = 'node'), 0) AS BIGINT) AS node_ids, CAST(coalesce(sum(m.id) FILTER (WHERE kind = 'way'), 0) AS BIGINT) AS way_ids, CAST(coalesce(sum(m.id) FILTER (WHERE kind = 'relation'), 0) AS BIGINT) AS relation_ids,
        CAST(coalesce(sum(g.n), 0) AS BIGINT) AS points, CAST(coalesce(sum(r.n), 0) AS BIGINT) AS members
        FROM merged m LEFT JOIN (SELECT ext, way_id, count(*) AS n FROM kept_geom GROUP BY ext, way_id) g ON kind = 'way' AND g.ext = m.ext AND g.way_id = m.id
        LEFT JOIN (SELECT relation_id, count(*) AS n FROM fx_member GROUP BY relation_id) r ON kind = 'relation' AND r.relation_id = m.id GROUP BY continent, x, y"""
    ),
    "string_dictionary": sql(
        """SELECT continent, x, y, count(*) AS used, count(DISTINCT s) AS strings FROM (
        SELECT m.continent, m.x, m.y, t.k AS s FROM merged m JOIN kept_tag t ON t.kind = m.kind AND t.id = m.id
        UNION ALL SELECT m.continent, m.x, m.y, t.v FROM merged m JOIN kept_tag t ON t.kind = m.kind AND t.id = m.id
        UNION ALL SELECT m.continent, m.x, m.y, r.role FROM merged m JOIN fx_member r ON m.kind = 'relation' AND r.relation_id = m.id) u GROUP BY continent, x, y"""
    ),
    "build_stamp": "SELECT event_id, strftime(TIMESTAMP '1970-01-01' + to_seconds(event_id * 86413 + 951782400), '%Y%m%d-%H%M%S') AS stamp, strftime(TIMESTAMP '1970-01-01' + to_seconds(event_id * 86413 + 951782400), '%Y%m%d') AS day FROM events",
    "url_local_name": "SELECT page_id, regexp_replace(CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE url END, '[/\\\\:]', '_', 'g') AS local_name FROM pages",
    "continent_rollup": """WITH RECURSIVE up AS (
        SELECT p_partkey AS id, p_partkey AS root, 0 AS depth FROM part UNION ALL SELECT id, root // 5, depth + 1 FROM up WHERE root >= 5 AND depth < 16)
        SELECT id, arg_max(root, depth) AS root, max(depth) AS depth FROM up GROUP BY id""",
    "point_in_polygon": sql("SELECT ext, id FROM inside"),
    "coverage_multiplicity": sql("SELECT shapes, count(*) AS points FROM (SELECT id, count(*) AS shapes FROM inside WHERE ext < 100 GROUP BY id) x GROUP BY shapes"),
    "ancestor_intersection": sql("SELECT shape_id, id FROM effective"),
    "orphan_points": sql("SELECT id FROM orphan"),
    "cover_candidates": sql(
        """SELECT s.shape_id, s.kind = 'HeaderBox' AS forced, count(e.id) AS points FROM fx_shape s LEFT JOIN effective e ON e.shape_id = s.shape_id AND (s.kind = 'Polygon' OR e.id IN (SELECT id FROM orphan))
        WHERE s.bytes <= 3000000000 AND s.kind <> 'Ancestor' GROUP BY s.shape_id, s.kind HAVING count(e.id) > 0 OR s.kind = 'HeaderBox'"""
    ),
    "sample_grid": "SELECT i * 0.25 - 180.0 AS lon, j * 0.25 - 85.0 AS lat FROM (SELECT CAST(range AS DOUBLE) AS i FROM range(1440)) a CROSS JOIN (SELECT CAST(range AS DOUBLE) AS j FROM range(681)) b",
    "ring_samples": sql(_ring_samples),
    "land_mask": _with(_land_cells, _cell, _coast),
    "island_samples": _with(_islands, _island_parts),
    "clip_boxes": sql(
        """SELECT DISTINCT ext, round(greatest(floor(lon) - 0.3, -180.0), 6) AS w, round(greatest(floor(lat) - 0.3, -90.0), 6) AS s, round(least(floor(lon) + 1.3, 180.0), 6) AS e, round(least(floor(lat) + 1.3, 90.0), 6) AS n
        FROM (SELECT id, min(ext) AS ext FROM inside WHERE ext < 100 GROUP BY id HAVING count(*) = 1) a JOIN fx_point USING (id)"""
    ),
    "uncovered_land": sql(
        """SELECT CAST(floor(lon) AS INT) AS cx, CAST(floor(lat) AS INT) AS cy, count(*) AS n, min(lon) AS lon, arg_min(lat, struct_pack(a := lon, b := lat)) AS lat
        FROM fx_point WHERE id NOT IN (SELECT id FROM inside) GROUP BY 1, 2"""
    ),
    "most_uncovered": sql(
        """SELECT CAST(floor(lon) AS INT) AS cx, CAST(floor(lat) AS INT) AS cy, count(*) AS n, min(lon) AS lon, arg_min(lat, struct_pack(a := lon, b := lat)) AS lat
        FROM fx_point WHERE id NOT IN (SELECT id FROM inside) GROUP BY 1, 2 ORDER BY n DESC, lon, lat LIMIT 25"""
    ),
    "set_cover": _with(_set_cover, _cover),
    "plan_regions": _with(_plan_regions, _cover),
    "archive_cells": sql(f"SELECT DISTINCT CAST((y // 128) * 64 + x // 128 AS INT) AS cell FROM (SELECT {tile_x('lon')} AS x, {tile_y('lat')} AS y FROM fx_point) t"),
    "plan_summary": sql(
        """SELECT (SELECT count(*) FROM fx_point) AS points, (SELECT count(DISTINCT id) FROM inside WHERE ext < 100) AS covered, (SELECT count(*) FROM fx_point) - (SELECT count(DISTINCT id) FROM inside WHERE ext < 100) AS uncovered,
        CAST(sum(bytes) AS BIGINT) AS total_bytes, count(*) AS extracts FROM fx_extract"""
    ),
    "run_order": sql("SELECT region_id, continent, bytes, seq FROM fx_run"),
    "largest_extracts": sql("SELECT region_id, bytes FROM fx_extract ORDER BY bytes DESC, region_id LIMIT 5"),
    "status": sql("SELECT continent, count(*) AS regions, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM fx_done GROUP BY ROLLUP (continent)"),
    "resume_todo": sql(
        "SELECT region_id AS region, continent, seq FROM fx_run WHERE region_id NOT IN (SELECT region FROM fx_done) AND continent NOT IN (SELECT continent FROM fx_extract WHERE ext = 2)"
    ),
    "patch_regions": sql("SELECT region_id AS region, 'bake' AS action FROM fx_extract WHERE ext % 6 = 0 UNION ALL SELECT region, 'drop' FROM fx_done WHERE region NOT IN (SELECT region_id FROM fx_extract WHERE ext % 6 = 0)"),
    "store_regions": sql("SELECT region FROM fx_done UNION SELECT region_id FROM fx_presence JOIN fx_extract USING (ext) WHERE ext % 2 = 0"),
    "publish_gate": sql(
        """SELECT missing, before, after, missing = '' AND after * 10 >= before * 9 AS passes FROM (
        SELECT coalesce((SELECT string_agg(name, ' ' ORDER BY name) FROM fx_index_prev WHERE name NOT LIKE 'overlay%' AND name NOT IN (SELECT name FROM fx_index_new)), '') AS missing,
        (SELECT CAST(coalesce(sum(tiles), 0) AS BIGINT) FROM fx_index_prev) AS before, (SELECT CAST(coalesce(sum(tiles), 0) AS BIGINT) FROM fx_index_new) AS after) x"""
    ),
    "gc_archives": sql("SELECT region_id || '-20250101.pmtiles' AS file FROM fx_extract"),
    "deadline_projection": sql(
        """SELECT seq, baked, total - baked AS left, CASE WHEN total > baked AND baked * 10 >= total THEN round(40000.0 * baked / total * (total - baked) / baked, 6) END AS need, total > baked AND baked * 10 >= total AS checked
        FROM (SELECT seq, CAST(sum(bytes) OVER (ORDER BY seq) AS BIGINT) AS baked, CAST(sum(bytes) OVER () AS BIGINT) AS total FROM fx_run) x"""
    ),
    "src_geojson_rings": sql("SELECT ext, ring, CAST(pos AS INT) AS pos, lon, lat FROM fx_ring"),
    "src_poly_rings": sql("SELECT ext, CAST(row_number() OVER (PARTITION BY ext ORDER BY ring) - 1 AS INT) AS ring, points, lon, lat FROM (SELECT ext, ring, count(*) AS points, sum(lon) AS lon, sum(lat) AS lat FROM fx_ring GROUP BY ext, ring) x"),
    "src_shapefile": sql(
        "SELECT CAST(dense_rank() OVER (ORDER BY ext) - 1 AS INT) AS rec, CAST(dense_rank() OVER (PARTITION BY ext ORDER BY ring) - 1 AS INT) AS ring, CAST(pos AS INT) AS pos, lon, lat FROM fx_ring"
    ),
    "src_osm_elements": sql(
        """SELECT 'node' AS kind, id, CAST(len(tags) AS INT) AS tags, 0 AS refs, 0 AS members, CAST(round(round(lat * 1e7) / 1e7 * 1e7) AS INT) AS lat_q FROM fx_node
        UNION ALL SELECT 'way', id, CAST(len(tags) AS INT), CAST(n AS INT), 0, NULL FROM fx_way JOIN (SELECT way_id AS id, count(*) AS n FROM fx_ref GROUP BY way_id) r USING (id)
        UNION ALL SELECT 'relation', id, CAST(len(tags) AS INT), 0, CAST(n AS INT), NULL FROM fx_relation JOIN (SELECT relation_id AS id, count(*) AS n FROM fx_member GROUP BY relation_id) m USING (id)"""
    ),
    "pmtiles_directory": _with(
        "SELECT d + 22369621 AS tile_id, length(CAST((y // 128) * 64 + x // 128 AS VARCHAR)) AS length FROM hil WHERE s = 0",
        f"spot AS (SELECT DISTINCT {tile_x('lon')} AS x, {tile_y('lat')} AS y FROM fx_point)",
        _hilbert,
    ),
}
