"""Tables that a plan writes to the folder the cluster shares and reads again, so that shuffles before them can go."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Stored:
    """A folder of Parquet tables below spark.checkpoint.dir; it goes with drop(), or when the driver ends.

    Where no such folder is set, one of our own is set, on one machine alone: an error on a cluster.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, context = spark, spark.sparkContext
        top = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not top:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
            top = tempfile.mkdtemp(prefix="cartospark-")
            context.setCheckpointDir(top)
        self.path = f"{top}/cartospark/{uuid.uuid4().hex}"
        atexit.register(self._forget)

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """The table, written; Spark is asked to remove the shuffle files that nothing refers to then."""
        df.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        found, df = self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}"), None
        self.released()
        return found

    def released(self) -> None:
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, name: str = "") -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def _forget(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                self.drop()
        except Exception:  # noqa: BLE001  the session may be gone at exit
            return
