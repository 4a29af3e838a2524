"""Session settings the jobs are written for, and the shared folder they may use."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Sizes are per cluster; only the switches matter for right results.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot site is split by the skew-join rule even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Files of stored intermediate results go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Plans are built from many small expressions; do not record a stack trace for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.dataFrameQueryContext.enabled": "false",
    # Sessions of a busy site are merged on the map side first.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "sitepulse", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one beside the warehouse tables.

    Where the setting is missing it is set, so that checkpoints go to the same place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def reuse(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, now, for several later uses: written to the shared folder, read back.

    A lost executor costs nothing. Only the end-to-end runs and the stream handlers call it;
    functions in ``plans`` return lazy frames. Folders lie below one folder per application,
    which may be removed once the application has ended.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/reuse-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
