"""Tables written to the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exprs import SPACES

_written: set[str] = set()


def folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir.  Where none is set, a folder of our own is set, on one machine alone: an error on a cluster."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        found = tempfile.mkdtemp(prefix="cartospark-")
        context.setCheckpointDir(found)
    return found


def written(df: DataFrame, what: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and return the table: lineage ends here.

    A later loss of executors re-reads the files.  The files go when :func:`dropped` is called, or
    when the driver ends.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/cartospark/{what}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_forget, spark)
    _written.add(path)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._cartospark_path = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written`, and let Spark remove shuffle files nothing refers to."""
    for table in tables:
        path = getattr(table, "_cartospark_path", None)
        if path in _written:
            _delete(table.sparkSession, path)
            _written.discard(path)
    if tables:
        released(tables[0].sparkSession)


def released(spark: SparkSession) -> None:
    """Ask the driver's JVM to notice dead shuffles now; their files would else stay for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _forget(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is None:
        return
    for path in list(_written):
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            return
        _written.discard(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, column: str, parts: int) -> DataFrame:
    """Send each row to the task numbered by its column: no two numbers share a task."""
    return df.repartitionById(parts, F.col(column).cast("int"))


def one_row_per_id(docs: DataFrame) -> DataFrame:
    """docs with a row for each doc_id: of rows that share one, that with the longest text, then the first by text, then the rest.

    No text is given up for a null or a blank one.
    Rows with a null id stay as they are.  Ids are counted first, from their column alone; rows are
    only regrouped for ids that do repeat.
    """
    twice = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if twice.isEmpty():
        return docs
    rest = ["text", *(c for c in docs.columns if c not in ("doc_id", "text"))]
    first = docs.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*rest), F.struct(-F.coalesce(F.length(F.btrim("text", F.lit(SPACES))), F.lit(-1)), *rest)).alias("row")).select("doc_id", "row.*")
    return docs.join(twice, "doc_id", "left_anti").select("doc_id", *rest).union(first).select(*docs.columns)
