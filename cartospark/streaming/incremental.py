"""Baking as a stream: regions are baked as their names arrive, once each, and the stream resumes from its checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.bake import Bake
from ..plans.engine import Engine


def bake_arrivals(engine: Engine, plan: DataFrame, inputs: Callable[[DataFrame], Bake], folder: str, checkpoint: str, files_per_batch: int = 8) -> StreamingQuery:
    """Bake the regions (region_id) named by Parquet files that appear in a folder; stops when what is there is done.

    A batch that fails is repeated with the same names, and the engine leaves out those that it had finished.  Continents are
    published when their last region is in.
    """
    rows = engine.spark.readStream.schema("region_id string").option("maxFilesPerTrigger", files_per_batch).parquet(folder)

    def each(arrived: DataFrame, _: int) -> None:
        engine.run(plan, inputs, only=[r["region_id"] for r in arrived.select("region_id").distinct().collect()])  # names of a few files

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
