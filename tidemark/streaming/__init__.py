"""Scenes as they arrive.

The engine's computations are batch ones; this module only feeds new scene files, as a
stream of files, to the per-scene step, and appends its observations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def observe_new_scenes(spark: SparkSession, pixels: str, schema: str, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies step to the pixels of each batch of new files, once, and writes what it returns under the batch's number.

    A batch that is tried again overwrites its own folder, so that nothing is there twice.
    The query ends when it has handled the files there are.
    """

    def each(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return spark.readStream.schema(schema).parquet(pixels).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
