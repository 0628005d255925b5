"""Extension: issues that arrive as files are upserted into a table as a stream; the outcome equals the batch's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriptoria.operators import merged
from scriptoria.operators.merged import newest

__all__ = ["current", "newest", "run_available", "upsert"]


def upsert(path: str, key: list[str], version: list[str], buckets: int = 16):
    """foreachBatch function: merge a batch into the table's touched buckets; a batch that is replayed after a failure changes nothing."""

    def one(batch: DataFrame, number: int) -> None:
        merged.merge(batch, path, key, version, number, buckets)

    return one


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as the last batch left it, None before the first."""
    return merged.read(spark, path)


def run_available(source: DataFrame, path: str, checkpoint: str, key: list[str], version: list[str]) -> None:
    """Process everything that has arrived, then stop."""
    query = source.writeStream.foreachBatch(upsert(path, key, version)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
