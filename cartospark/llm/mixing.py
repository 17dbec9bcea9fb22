"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Method: sources share the total of all sizes by weight; a target stops at ``repeat`` times its source's
size and the excess is shared again by weight until none is above (water-filling).  Each source's
documents are shuffled by a keyed digest and queued up to ``repeat`` times over; a copy's virtual finish
time is the cumulative size of its source up to it divided by the source's target.  All copies are
range-sorted by finish time and taken until their sizes reach the total.

The queue of a source is a distributed running sum (see ``ordered``), so a source may hold any share of
the rows.  The copies need no sort of their own text: only (source, size, digest) are moved.  Sizes by source, a row for each
source, pass the driver, where shares are exact fractions.

Defined cases: a null text has size 0; a null source is a source of its own, the last; sizes of 0 have
nothing to take; rows equal in id share their digest and are queued side by side, by size and bytes; an
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import running
from .shared import written

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = (1, 2, 3), repeat: int = 3) -> list[tuple[str | None, int, float]]:
    """(source, size, target): sources in code point order, null last; exact until the last division."""
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weight = [weights[k % len(weights)] for k in range(len(order))]
    total = sum(n for _, n in order)
    limit = [repeat * n for _, n in order]
    capped: set[int] = set()
    while True:
        rest = total - sum(limit[k] for k in capped)
        share = sum(w for k, w in enumerate(weight) if k not in capped)
        over = {k for k, w in enumerate(weight) if k not in capped and w * rest > limit[k] * share}
        if not over:
            break
        capped |= over
    return [(s, n, float(limit[k]) if k in capped else float(Fraction(weight[k] * rest, share) if share else 0)) for k, (s, n) in enumerate(order)]


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeat: int = 3, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, bytes, source_size, target, copies, taken) of every row; bytes: those of its text."""
    spark = docs.sparkSession
    each = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.octet_length(F.col(text_col).cast("string")).alias("bytes"),
    )
    # words are counted once; what follows reads these numbers
    each = written(each, "sizes")
    each = each.withColumn("digest", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")))
    queued = written(running(each, ["source"], [F.col("digest")], "size", "done", ["size", "bytes"]), "queued")
    sizes = [(r[0], r[1]) for r in queued.groupBy("source").agg(F.sum("size")).collect()]  # a row for each source
    shares = spark.createDataFrame(targets(sizes, weights, repeat), "s string, source_size long, target double")
    queued = queued.join(shares, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    finish = (F.col("done") + F.col("pass") * F.col("source_size")) / F.col("target")
    copies = queued.filter("size > 0").select("doc_id", "source", "size", "digest", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))).alias("pass"), "done", "source_size", "target")
    copies = copies.select("source", "digest", "size", "pass", finish.alias("finish"))
    line = running(copies, [], [F.col("finish")], "size", "served", ["source", "digest", "pass", "size"])
    total = sum(n for _, n in sizes)
    # the last copy that is taken: the one that reaches the total, if that is nearer than stopping before it
    last = line.filter(2 * F.col("served") - F.col("size") <= 2 * total).agg(F.max("finish")).first()[0]
    taken = sum((F.when((F.col("done") + p * F.col("source_size")) / F.col("target") <= F.lit(last if last is not None else -1.0), 1).otherwise(0) for p in range(repeat)), F.lit(0))
    return queued.select("doc_id", "source", "size", "bytes", "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(0).cast("long").alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeat: int = 3, seed: str = "mix") -> DataFrame:
    """The rows of the mix, all columns of docs: each as often as it is taken.

    Rows equal in id, source and bytes of text are taken alike, as often as the one taken most.
    """
    chosen = mixed(docs, weights, repeat, seed).filter("copies > 0")
    chosen = chosen.groupBy("doc_id", "source", "bytes").agg(F.max("copies").alias("copies"))
    mark = "_mix"
    while any(c.startswith(mark) for c in docs.columns):  # no name of theirs
        mark += "_"
    chosen = chosen.toDF(*(f"{mark}{k}" for k in range(4)))
    match = F.col("doc_id").eqNullSafe(F.col(f"{mark}0")) & F.col("source").eqNullSafe(F.col(f"{mark}1")) & F.octet_length("text").eqNullSafe(F.col(f"{mark}2"))
    joined = docs.join(chosen.hint("shuffle_hash"), match)
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(f"{mark}3"))).alias(mark)).drop(mark)
