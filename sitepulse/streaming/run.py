"""Starting streams on files and draining what is there."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, time_columns: Sequence[str] = ("ts",),
                 files_per_batch: int | None = None) -> DataFrame:
    """A growing parquet folder (or a path pattern) as a stream; zone-free times become
    TIMESTAMP, which watermarks need."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumns(
        {c: F.col(c).cast("timestamp") for c in time_columns})


def run_available(stream: DataFrame, folder: str) -> DataFrame:
    """Process everything available now into a parquet table and read that back.

    Offsets and state live next to the table, so a restarted run goes on where it stopped.
    """
    query = (stream.writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
             .start(f"{folder}/table"))
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/table")


def run_batches(stream: DataFrame, folder: str,
                handle: Callable[[DataFrame, int], None]) -> None:
    """Hand every micro-batch to ``handle``, which must give the same result when repeated."""
    query = (stream.writeStream.foreachBatch(handle)
             .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    query.awaitTermination()
