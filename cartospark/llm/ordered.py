"""Running sums and row numbers over a whole table, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import partitions, written


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """df with ``out``: 0, 1, 2.. over all rows in the given order; rows are moved once.

    Rows are range-partitioned, sorted and written with their partition and place; the offsets of the
    partitions, a row for each, are broadcast.
    """
    parts = partitions(df.sparkSession)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_at": place}), "numbered")
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_before") + F.col("_at")).alias(out))


def running(df: DataFrame, keys: list[str], order: list[Column], value: str, out: str, ties: list[str]) -> DataFrame:
    """df with ``out``: the sum of ``value`` over the rows up to this one, per keys, in the given order.

    Rows are range-partitioned by keys and order and written once with their partition's number; each
    (partition, key) sums up on its own and a table with one row for each of these adds what came before.
    A key with any share of the rows therefore spreads over as many tasks.  Columns in ``ties`` settle equal
    orders; rows equal in these too are interchangeable.
    """
    spark = df.sparkSession
    sort = [*order, *(F.col(t).asc_nulls_last() for t in ties)]
    keyed = [F.col(k).asc_nulls_last() for k in keys]
    placed = written(df.repartitionByRange(partitions(spark), *keyed, *sort).withColumn("_part", F.spark_partition_id()), "ordered")
    same = ["_part", *keys]
    totals = placed.groupBy(*same).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*(F.col(c).alias(f"_o{c}") for c in same), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    here = Window.partitionBy(*same).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("_here", F.sum(value).over(here))
    match = [F.col(c).eqNullSafe(F.col(f"_o{c}")) for c in same]
    joined = summed.join(offsets, match, "left")
    return joined.select(*df.columns, (F.col("_here") + F.col("_before")).alias(out))
