"""Web-mercator tiles, Hilbert tile numbers and coverage cells as Column expressions; y grows southward."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CELL_ZOOM, CELLS, FIRST_ID, MERCATOR_LIMIT, SCALE, ZOOM


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quantised(degrees: Column | str) -> Column:
    """Degrees as whole 1e-7 units, half away from zero."""
    return F.round(_col(degrees) * SCALE).cast("int")


def degrees(units: Column | str) -> Column:
    return _col(units) / F.lit(SCALE)


def fraction_x(lon: Column | str, zoom: int = ZOOM) -> Column:
    return (_col(lon) + 180.0) / 360.0 * float(1 << zoom)


def fraction_y(lat: Column | str, zoom: int = ZOOM) -> Column:
    r = F.radians(F.least(F.greatest(_col(lat), F.lit(-MERCATOR_LIMIT)), F.lit(MERCATOR_LIMIT)))
    return (1.0 - F.log(F.tan(r) + 1.0 / F.cos(r)) / math.pi) / 2.0 * float(1 << zoom)


def _tile(fraction: Column, zoom: int) -> Column:
    return F.least(F.greatest(F.floor(fraction), F.lit(0)), F.lit((1 << zoom) - 1)).cast("int")


def tile_x(lon: Column | str, zoom: int = ZOOM) -> Column:
    return _tile(fraction_x(lon, zoom), zoom)


def tile_y(lat: Column | str, zoom: int = ZOOM) -> Column:
    return _tile(fraction_y(lat, zoom), zoom)


def west(x: Column | str, zoom: int = ZOOM) -> Column:
    return _col(x) / float(1 << zoom) * 360.0 - 180.0


def north(y: Column | str, zoom: int = ZOOM) -> Column:
    return F.degrees(F.atan(F.sinh(math.pi * (1.0 - 2.0 * _col(y) / float(1 << zoom)))))


def segment_tiles(x0: Column, y0: Column, x1: Column, y1: Column, zoom: int = ZOOM) -> Column:
    """ARRAY<STRUCT<x, y>>: every tile a segment touches, given the tile fractions of its ends.

    A walk from grid line to grid line as a fold: the nearer of the next vertical and horizontal line is
    crossed; through a corner both side neighbours are touched too.  A jump over half the planet is only
    its two ends.  Most segments stay in one tile and never enter the fold.
    """
    top = (1 << zoom) - 1
    at = lambda x, y: F.struct(F.least(F.greatest(x, F.lit(0)), F.lit(top)).cast("int").alias("x"), F.least(F.greatest(y, F.lit(0)), F.lit(top)).cast("int").alias("y"))
    sx, sy, ex, ey = (F.floor(c).cast("long") for c in (x0, y0, x1, y1))
    dx, dy = x1 - x0, y1 - y0
    never = F.lit(float("inf"))

    def line(cell: Column, delta: Column, origin: Column) -> Column:
        ahead = cell + F.when(delta > 0, 1).otherwise(0)
        return F.when(delta == 0, never).otherwise(F.try_divide(ahead.cast("double") - origin, delta))

    unit = lambda d: F.when(d == 0, never).otherwise(F.try_divide(F.lit(1.0), F.abs(d)))
    step_x, step_y = F.signum(dx).cast("long"), F.signum(dy).cast("long")
    start = F.struct(sx.alias("x"), sy.alias("y"), line(sx, dx, x0).alias("tx"), line(sy, dy, y0).alias("ty"), F.array(at(sx, sy)).alias("out"))

    def step(s: Column, _: Column) -> Column:
        by_x, by_y = s["tx"] < s["ty"], s["ty"] < s["tx"]
        x = s["x"] + F.when(by_y, F.lit(0)).otherwise(step_x)
        y = s["y"] + F.when(by_x, F.lit(0)).otherwise(step_y)
        corner = F.when(by_x | by_y, F.array(at(x, y))).otherwise(F.array(at(x, s["y"]), at(s["x"], y), at(x, y)))
        moved = F.struct(
            x.alias("x"),
            y.alias("y"),
            F.when(by_y, s["tx"]).otherwise(s["tx"] + unit(dx)).alias("tx"),
            F.when(by_x, s["ty"]).otherwise(s["ty"] + unit(dy)).alias("ty"),
            F.concat(s["out"], corner).alias("out"),
        )
        return F.when((s["x"] == ex) & (s["y"] == ey), s).otherwise(moved)

    walk = F.aggregate(F.sequence(F.lit(1).cast("long"), F.abs(ex - sx) + F.abs(ey - sy) + 2), start, step, lambda s: s["out"])
    return F.when((sx == ex) & (sy == ey), F.array(at(sx, sy))).when(F.abs(ex - sx) > top // 2, F.array(at(sx, sy), at(ex, ey))).otherwise(walk)


def hilbert_id(x: Column | str, y: Column | str) -> Column:
    """Archive tile number of a zoom 13 tile: numbers of lower zooms, then the place on the Hilbert curve."""
    start = F.struct(_col(x).cast("long").alias("x"), _col(y).cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(s: Column, k: Column) -> Column:
        # the curve's quadrant, then its frame turned into that of the whole
        side = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        rx = F.when(s["x"].bitwiseAND(side) != 0, 1).otherwise(0).cast("long")
        ry = F.when(s["y"].bitwiseAND(side) != 0, 1).otherwise(0).cast("long")
        low_x, low_y = s["x"].bitwiseAND(side - 1), s["y"].bitwiseAND(side - 1)
        flip = (ry == 0) & (rx == 1)
        nx = F.when(ry == 1, low_x).when(flip, side - 1 - low_y).otherwise(low_y)
        ny = F.when(ry == 1, low_y).when(flip, side - 1 - low_x).otherwise(low_x)
        return F.struct(nx.alias("x"), ny.alias("y"), (s["d"] + side * side * (3 * rx).bitwiseXOR(ry)).alias("d"))

    return F.aggregate(F.sequence(F.lit(ZOOM - 1), F.lit(0)), start, step, lambda s: s["d"] + F.lit(FIRST_ID))


def hilbert_xy(tile_id: Column | str) -> Column:
    """STRUCT<x, y> of an archive tile number of zoom 13."""
    start = F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), (_col(tile_id) - F.lit(FIRST_ID)).alias("t"))

    def step(s: Column, k: Column) -> Column:
        side = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        rx = F.shiftright(s["t"], 1).bitwiseAND(F.lit(1).cast("long"))
        ry = s["t"].bitwiseXOR(rx).bitwiseAND(F.lit(1).cast("long"))
        flip = (ry == 0) & (rx == 1)
        nx = F.when(ry == 1, s["x"]).when(flip, side - 1 - s["y"]).otherwise(s["y"])
        ny = F.when(ry == 1, s["y"]).when(flip, side - 1 - s["x"]).otherwise(s["x"])
        return F.struct((nx + side * rx).alias("x"), (ny + side * ry).alias("y"), F.shiftright(s["t"], 2).alias("t"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ZOOM - 1)), start, step, lambda s: F.struct(s["x"].cast("int").alias("x"), s["y"].cast("int").alias("y")))


def cell(x: Column | str, y: Column | str) -> Column:
    """Coverage cell of a zoom 13 tile."""
    down = ZOOM - CELL_ZOOM
    return (F.shiftright(_col(y), down) * CELLS + F.shiftright(_col(x), down)).cast("int")


def build_stamp(seconds: Column | str, with_time: bool = True) -> Column:
    """UTC stamp YYYYMMDD-HHMMSS, or the day alone, from seconds since 1970, whatever the session's zone.

    Years have four digits at least, and beyond 9999 what they need: patterns of date_format would put a sign before those.
    """
    at = F.floor(_col(seconds)).cast("long")
    time = F.pmod(at, F.lit(86_400))
    date = F.date_from_unix_date(((at - time) / 86_400).cast("int"))
    parts = [F.year(date), F.month(date), F.day(date)]
    if with_time:
        parts += [F.floor(time / 3600), F.floor(time / 60) % 60, time % 60]
    return F.when(at.isNotNull(), F.format_string("%04d%02d%02d-%02d%02d%02d" if with_time else "%04d%02d%02d", *parts))
