"""Sharding by a pseudo-random permutation of global row numbers, in DataFrame functions only.

Method: rows get numbers 0..N-1 in the order of (id, text checksum, size); a keyed Feistel network over
pairs (row // b, row % b) of numbers below a and b permutes 0..a*b-1, with a about the root of N and a * b
less than a above N; a position of N or more is permuted again until it falls below N (cycle walking).
So every position is a function of row number, N and seed alone, and so are shard (position modulo
shards) and slot (position divided by shards): shards differ by one row at most.

Walks end: a cycle has no more positions beyond N than there are, a * b - N < a, so a walk of that many
steps always ends.  Steps beyond WALK are only ever needed with a probability of b ** -WALK.

Defined cases: a null text has no bytes and the checksum of none, 0; null ids come last; rows equal in all
three are interchangeable; an empty table stays empty; other columns are ignored, and so are columns to keep that are
named like the results.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import numbered

ROUNDS = 6
WALK = 48


def _once(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network: alternately the left number moves by a function of the right and back."""
    left, right = F.floor(x / F.lit(b)).cast("long"), F.pmod(x, F.lit(b))
    state = F.struct(left.alias("l"), right.alias("r"))
    for k in range(ROUNDS):
        if k % 2 == 0:
            step = lambda s, k=k: F.struct(F.pmod(s["l"] + F.pmod(F.xxhash64(F.lit(seed), F.lit(k), s["r"]), F.lit(a)), F.lit(a)).alias("l"), s["r"].alias("r"))
        else:
            step = lambda s, k=k: F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(F.xxhash64(F.lit(seed), F.lit(k), s["l"]), F.lit(b)), F.lit(b)).alias("r"))
        state = F.element_at(F.transform(F.array(state), step), 1)
    return state["l"] * F.lit(b) + state["r"]


def permuted(row: Column, total: int, seed: int) -> Column:
    """The position of a row number among ``total``."""
    if total <= 1:
        return row
    a = isqrt(total - 1) + 1
    b = -(-total // a)
    outside = a * b - total
    first = _once(row, a, b, seed)
    if not outside:
        return first
    walk = lambda x: F.aggregate(F.sequence(F.lit(1), F.lit(min(outside, WALK))), x, lambda s, _: F.when(s < total, s).otherwise(_once(s, a, b, seed)))
    return F.element_at(F.transform(F.array(first), lambda x: F.when(x < total, x).otherwise(walk(x))), 1)


def sharded(docs: DataFrame, shards: int = 16, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, position, shard, slot) of every row, and the columns to keep."""
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    made = {"doc_id", "size", "text_crc32", "position", "shard", "slot", "_size", "_crc", "_row", "_part", "_at", "_before", "_n"}
    keep = [c for c in keep or [] if c != id_col and c not in made]
    each = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(raw).cast("long") + 1).alias("_size"), F.crc32(raw).alias("_crc"), *keep)
    rows = numbered(each, [F.col(c).asc_nulls_last() for c in ("doc_id", "_crc", "_size")], "_row")
    position = permuted(F.col("_row"), docs.count(), seed)
    placed = rows.select("doc_id", *keep, F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), position.alias("position"))
    return placed.withColumns({"shard": F.pmod("position", F.lit(shards)).cast("int"), "slot": F.floor(F.col("position") / shards).cast("long")})
