"""Stream forms of the batch jobs. Inputs are streaming DataFrames with TIMESTAMP columns.

Rows later than the watermark are dropped, and a window is written once the watermark has passed
its end, so the newest windows appear with later data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.operators import latest_per_key
from sitepulse.plans import sla
from sitepulse.plans.tickets import disk_tickets
from sitepulse.session import reuse
from sitepulse.sources import apply_ticket_changes, current_version, look_back, replace_table
from sitepulse.sources.writers import finished_versions

# Hours for which a handler leaves a replaced version of a table to its readers.
KEEP_HOURS = 24.0
# Groups per key in which repeats are dropped before a key's rows meet.
SPREAD = 8


def slot_counts(events: DataFrame, at: str, keys: Sequence[str], delay: str = "1 hour",
                width: str = "4 hours") -> DataFrame:
    """Counts per key and tumbling slot."""
    return (events.withWatermark(at, delay).groupBy(*keys, F.window(at, width).alias("w"))
            .agg(F.count(F.lit(1)).alias("signals"))
            .select(*keys, F.col("w.start").alias("slot_start"), F.col("w.end").alias("slot_end"),
                    "signals"))


def sliding_counts(events: DataFrame, at: str, keys: Sequence[str], delay: str = "15 minutes",
                   width: str = "2 hours", step: str = "15 minutes",
                   at_least: int = 1) -> DataFrame:
    """Counts per key and sliding window, kept where they reach ``at_least``."""
    return (events.withWatermark(at, delay).groupBy(*keys, F.window(at, width, step).alias("w"))
            .agg(F.count(F.lit(1)).alias("signals")).filter(F.col("signals") >= at_least)
            .select(*keys, F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "signals"))


def distinct_tickets(events: DataFrame, at: str, keys: Sequence[str], delay: str = "1 hour", *,
                     spread: int | None = SPREAD) -> DataFrame:
    """First arrival per key; repeats inside the delay are dropped, then the key is forgotten.

    Repeats per key and input partition are dropped first, in ``spread`` groups per key, so one
    key with very many repeats does not end up in one task. State grows accordingly; ``None``
    leaves that step out.
    """
    marked = events.withWatermark(at, delay)
    if spread is not None:
        part = F.pmod(F.spark_partition_id(), F.lit(spread))
        marked = (marked.withColumn("_part", part)
                  .dropDuplicatesWithinWatermark([*keys, "_part"]).drop("_part"))
    return marked.dropDuplicatesWithinWatermark(list(keys))


def acknowledged_tickets(tickets: DataFrame, acks: DataFrame, *, delay: str = "30 minutes",
                         within: str = "1 hour", distinct: bool = True,
                         spread: int | None = SPREAD) -> DataFrame:
    """Each ticket with its acknowledgement, or without one after ``within`` has passed.

    ``distinct`` keeps the first arrival per ticket on both sides, so repeats are not multiplied;
    leave it out for inputs that have no repeats.
    """
    if distinct:
        left = distinct_tickets(tickets, "opened_on", ["event_id"], delay, spread=spread)
        right = distinct_tickets(acks, "ack_on", ["event_id"], delay, spread=spread)
    else:
        left = tickets.withWatermark("opened_on", delay)
        right = acks.withWatermark("ack_on", delay)
    bound = F.expr(f"t.event_id = a.event_id and a.ack_on >= t.opened_on "
                   f"and a.ack_on <= t.opened_on + interval {within}")
    return left.alias("t").join(right.alias("a"), bound, "left_outer").select("t.*", "a.ack_on")


def offline_sessions(signals: DataFrame, at: str, key: str, *, gap: str,
                     delay: str = "1 hour") -> DataFrame:
    """Runs of offline signals that are less than ``gap`` apart."""
    return (signals.withWatermark(at, delay)
            .groupBy(key, F.session_window(at, gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("signals"), F.max(at).alias("last_signal"))
            .select(key, F.col("w.start").alias("session_start"), "last_signal", "signals"))


def silent_sites(signals: DataFrame, at: str, key: str, *, silence: str,
                 delay: str = "1 hour") -> DataFrame:
    """An alarm for every pause of at least ``silence``: a session of signals that has ended."""
    return (signals.withWatermark(at, delay)
            .groupBy(key, F.session_window(at, silence).alias("w"))
            .agg(F.max(at).alias("last_signal"))
            .select(key, "last_signal", F.col("w.end").alias("alarm_at")))


def _version(spark: SparkSession, path: str, version: int) -> bool:
    """Is there a version before this one? A table that is ahead belongs to another run."""
    found = finished_versions(spark, path)
    if found and found[-1] > version:
        raise ValueError(f"{path} already has version {found[-1]}: a stream that starts anew on "
                         f"it needs start={found[-1] + 1}")
    return any(v < version for v in found)


def near_violation_feed(spark: SparkSession, tickets_path: str, feed_path: str,
                        sites: Callable[[], DataFrame], asof: Callable[[], str], *, days: int = 1,
                        start: int = 0, keep_hours: float = KEEP_HOURS, **options
                        ) -> Callable[[DataFrame, int], None]:
    """Batch handler: merge the tickets that arrived, then replace the list of urgent ones.

    ``sites`` are read anew in every batch; the list needs no remarks. The newest row of a ticket wins, so a
    ticket that arrives closed leaves the list. Only the look-back is stored. Every batch writes
    the version ``start`` + its number from the one before it, so a batch that is handled twice
    changes nothing; with a new checkpoint folder on an existing table, ``start`` is the first
    free version and the stored tickets stay known.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        version = start + batch_id
        arrived = batch.withColumn("_seen", F.lit(version))
        if _version(spark, tickets_path, version):
            arrived = current_version(spark, tickets_path, before=version).unionByName(arrived)
        latest = latest_per_key(look_back(arrived, "at_time", asof(), days=days), ["event_id"],
                                ["_seen", "opened_on"])
        known = spark.read.parquet(replace_table(latest, tickets_path, version=version,
                                                 keep_hours=keep_hours))
        urgent = sla.near_violation(sla.open_tickets(known.drop("_seen"), None, sites(), asof(),
                                                     days=days, **options))
        replace_table(urgent, feed_path, version=version, keep_hours=keep_hours)

    return handle


def fault_lifecycle(spark: SparkSession, open_path: str, archive_path: str,
                    sites: Callable[[], DataFrame], signals: Callable[[], DataFrame],
                    asof: Callable[[], str], *, minutes: int = 10, start: int = 0,
                    keep_hours: float = KEEP_HOURS) -> Callable[[DataFrame, int], None]:
    """Batch handler: open, close and touch disk tickets from the status rows that arrived.

    ``sites`` and ``signals`` are read anew in every batch, signals of the last ``minutes`` only.
    Open tickets are a small versioned table (begin it with ``version=start - 1``); closed ones
    move to the archive, one folder per version, and the highest id ever given is a one-row table
    beside the open ones. A batch reads the version before its own, so handling it twice gives
    the same files.
    """
    ids_path = f"{open_path}_highest_id"

    def handle(batch: DataFrame, batch_id: int) -> None:
        version = start + batch_id
        _version(spark, open_path, version)
        tickets = current_version(spark, open_path, before=version)
        highest = tickets.agg(F.max("ticket_id").alias("ticket_id"))
        if _version(spark, ids_path, version):
            highest = highest.unionByName(current_version(spark, ids_path, before=version))
        highest = highest.agg(F.coalesce(F.max("ticket_id"), F.lit(0).cast("long")).alias(
            "ticket_id"))
        recent = look_back(signals(), "at_time", asof(), minutes=minutes)
        change = disk_tickets(sites(), batch, recent, tickets)
        after = reuse(apply_ticket_changes(
            tickets, asof(), closed=change.closed, touched=change.touched,
            highest=highest.scalar(),
            opened=change.opened.withColumn("closed_on", F.lit(None).cast("timestamp_ntz"))))
        done = after.filter("closed_on is not null")
        done.write.mode("overwrite").parquet(f"{archive_path}/batch={version}")
        replace_table(highest.unionByName(after.select("ticket_id")).agg(
            F.max("ticket_id").alias("ticket_id")), ids_path, version=version,
            keep_hours=keep_hours)
        replace_table(after.filter("closed_on is null"), open_path, version=version,
                      keep_hours=keep_hours)

    return handle
