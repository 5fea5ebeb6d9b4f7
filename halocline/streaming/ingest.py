"""Batches of arriving logs through the batch pipeline.

The log stages are per deployment and need whole deployments, so there is no stateful streaming operator: each micro-batch
of complete logs is processed and appended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def process_arrivals(spark: SparkSession, folder: str, schema: str, process: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Calls process(logs, batch id) for the Parquet logs that are new in folder, then ends. Restarted, it goes on after the last finished batch."""
    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
