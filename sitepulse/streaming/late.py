"""Slot counts that lose nothing: late rows go to a side table and count in the stored slots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.sources.writers import current_version, finished_versions, replace_table

# Batches after which their counts are added up into one table.
FOLD = 50


def slot_handler(spark: SparkSession, path: str, at: str, keys: Sequence[str], *,
                 width: str = "4 hours", delay: str = "1 hour", fold: int = FOLD
                 ) -> Callable[[DataFrame, int], None]:
    """Batch handler that counts rows per key and slot.

    Each batch writes its own counts, a few rows per key and slot, in two tables: ``counts``, and
    ``late`` for slots that had ended before the watermark (the newest time of earlier batches minus
    ``delay``). ``slot_totals`` merges both by key, so late rows count and the newest slots are there
    as well. A batch that is handled twice writes the same files.
    """
    wait = pd.Timedelta(delay).to_pytimedelta()

    def handle(batch: DataFrame, batch_id: int) -> None:
        newest = None
        if any(v < batch_id for v in finished_versions(spark, f"{path}/newest")):
            newest = current_version(spark, f"{path}/newest", before=batch_id).first()[0]
        counted = batch.filter(F.col(at).isNotNull()).groupBy(
            *keys, F.window(F.col(at).cast("timestamp"), width).alias("w")).agg(
                F.count(F.lit(1)).alias("signals"), F.max(F.col(at).cast("timestamp")).alias("_n"))
        counted = counted.select(*keys, F.col("w.start").alias("slot_start"),
                                 F.col("w.end").alias("slot_end"), "signals", "_n").persist()
        late = F.lit(False) if newest is None else F.col("slot_end") <= F.lit(newest - wait)
        seen = counted.agg(F.max("_n")).first()[0]
        known = [t for t in (newest, seen) if t is not None]
        for name, rows in (("counts", counted.filter(~late)), ("late", counted.filter(late))):
            replace_table(rows.drop("_n"), f"{path}/{name}", version=batch_id)
        if known:
            replace_table(spark.createDataFrame([(max(known),)], "newest timestamp"),
                          f"{path}/newest", version=batch_id, keep=3)
        counted.unpersist()
        if batch_id % fold == fold - 1:
            replace_table(slot_totals(spark, path, keys), f"{path}/folded", version=batch_id, keep=2)

    return handle


def _batches(spark: SparkSession, path: str, name: str, after: int) -> DataFrame | None:
    """Counts of the finished batches behind ``after``."""
    folders = [f"{path}/{name}/v={v}" for v in finished_versions(spark, f"{path}/{name}") if v > after]
    return spark.read.parquet(*folders) if folders else None


def slot_totals(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Counts per key and slot, late rows included."""
    folded = finished_versions(spark, f"{path}/folded")
    parts = [_batches(spark, path, name, max(folded, default=-1)) for name in ("counts", "late")]
    if folded:
        parts.append(current_version(spark, f"{path}/folded"))
    found = [p for p in parts if p is not None]
    if not found:
        raise FileNotFoundError(path)
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*keys, "slot_start", "slot_end").agg(F.sum("signals").alias("signals"))


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """What came after its slot had ended: the side table, by batch (``v``)."""
    return spark.read.parquet(f"{path}/late")
