"""Fault tickets: what to open, close and touch, given the latest signals and the open tickets.

Each job reduces the signals to one row per box or camera and derives all changes from that. The
frames are lazy: who needs only one of the changes computes only that one.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import as_of, minutes_between
from sitepulse.operators import (
    anti, latest_per_key, null_safe_anti, null_safe_semi, overlapping, peer_latest, semi,
    superseded, union_all,
)
from sitepulse.sources.readers import look_back

# Signal codes, disk states and lobby cameras.
RECORD, REMOTE_RECORD = "RECORD", "REMOTERECORD"
DISK_FAULT, DISK_OK = "0", "1"
LOBBY_CAMERAS = ["0702", "0702R"]
RECORDING, NOT_RECORDING = "1", "-1"

SITE = ["bank", "site_name", "site_id", "box_id", "state", "district", "street", "zone"]


class Changes(NamedTuple):
    """``opened`` lacks ids; ``closed`` and ``touched`` are keyed by ``ticket_id``."""

    opened: DataFrame
    closed: DataFrame
    touched: DataFrame | None = None


def _site_columns(sites: DataFrame) -> list[str]:
    return [c for c in SITE if c in sites.columns]


def _remote_recordings(signals: DataFrame, sites: DataFrame) -> DataFrame:
    wanted = semi(signals.filter(F.col("event_code") == REMOTE_RECORD), sites, ["box_id"])
    return wanted.groupBy("box_id").agg(F.max("at_time").alias("latest_remote_recording"))


def disk_tickets(sites: DataFrame, disk_status: DataFrame, signals: DataFrame,
                 open_tickets: DataFrame, asof=None, *, minutes: int = 10,
                 close_on: str = "box") -> Changes:
    """Disk faults. ``close_on``: ``box`` (box is healthy, or a newer ticket of the box is
    open), ``box_error`` (healthy with the same error text) or ``absence`` (box has no fault;
    boxes with an open ticket get no second one). Without ``asof`` the whole input is used.
    """
    if asof is not None:
        disk_status = look_back(disk_status, "at_time", asof, minutes=minutes)
        signals = look_back(signals, "at_time", asof, minutes=minutes)
    latest = latest_per_key(disk_status, ["box_id"], ["at_time", "error"])
    faulty = (latest.filter(F.col("hdd") == DISK_FAULT)
              .join(sites.select(*_site_columns(sites)), ["site_id", "box_id"])
              .withColumnRenamed("at_time", "opened_on"))
    healthy = latest.filter(F.col("hdd") == DISK_OK)
    if close_on == "absence":
        return Changes(anti(faulty, open_tickets, ["box_id"]),
                       anti(open_tickets, faulty, ["box_id"]).select("ticket_id"))
    fresh = null_safe_anti(faulty, open_tickets, ["box_id", "error"])
    if close_on == "box":
        older = superseded(open_tickets, ["box_id"], ["opened_on", "ticket_id"], "ticket_id")
        closing = union_all([semi(open_tickets, healthy, ["box_id"]).select("ticket_id", "box_id"),
                             older.select("ticket_id", "box_id")]).distinct()
    elif close_on == "box_error":
        closing = null_safe_semi(open_tickets, healthy, ["box_id", "error"]).select(
            "ticket_id", "box_id")
    else:
        raise ValueError(close_on)
    # Only boxes that have an open ticket bring a recording time, to old and new tickets.
    recorded = _remote_recordings(semi(signals, open_tickets, ["box_id"]), sites)
    waiting = anti(anti(open_tickets, healthy, ["box_id"]), closing, ["box_id"])
    touched = waiting.select("ticket_id", "box_id").join(recorded, "box_id").drop("box_id")
    return Changes(fresh.join(recorded, "box_id", "left"), closing.select("ticket_id"), touched)


def camera_lag_tickets(sites: DataFrame, cameras: DataFrame, signals: DataFrame,
                       open_tickets: DataFrame, *, lag_minutes: int = 60) -> Changes:
    """Cameras whose last recording is far behind the newest camera of their box."""
    last = (signals.filter(F.col("event_code") == RECORD).groupBy("box_id", "device_id")
            .agg(F.max("at_time").alias("opened_on"))
            .withColumnRenamed("device_id", "camera_id"))
    known = (semi(cameras.filter("active"), sites, ["box_id"])
             .select("box_id", "camera_id", "camera_name").join(last, ["box_id", "camera_id"]))
    behind = peer_latest(known, ["box_id"], "opened_on", "_newest").filter(
        minutes_between("opened_on", "_newest") >= lag_minutes).drop("_newest")
    faulty = behind.join(sites.select(*_site_columns(sites)), "box_id")
    key = ["box_id", "camera_id"]
    return Changes(anti(faulty, open_tickets, key),
                   anti(open_tickets, faulty, key).select("ticket_id"))


def camera_absent_tickets(sites: DataFrame, cameras: DataFrame, signals: DataFrame,
                          open_tickets: DataFrame, asof, *, minutes: int = 30) -> Changes:
    """Installed cameras that did not record while another camera of their box did."""
    recent = semi(look_back(signals, "at_time", asof, minutes=minutes)
                  .filter(F.col("event_code") == RECORD), sites, ["box_id"])
    seen = recent.select("box_id", F.col("device_id").alias("camera_id")).distinct()
    silent = anti(semi(cameras.filter("active"), seen, ["box_id"]), seen,
                  ["box_id", "camera_id"]).select("box_id", "camera_id", "camera_name")
    fresh = null_safe_anti(silent, open_tickets, ["box_id", "camera_id", "camera_name"])
    opened = (fresh.join(sites.select(*_site_columns(sites)), "box_id")
              .withColumn("opened_on", as_of(asof)))
    return Changes(opened, semi(open_tickets, seen, ["box_id", "camera_id"]).select("ticket_id"))


def lobby_stale_tickets(sites: DataFrame, signals: DataFrame, open_tickets: DataFrame, asof, *,
                        minutes: int = 5, use_status: bool = False,
                        key: Sequence[str] = ("site_name",)) -> Changes:
    """Sites whose lobby camera is silent; an age of exactly ``minutes`` decides nothing.

    With ``use_status`` a fresh signal must also say that it records to close a ticket, and one
    that says it does not opens a ticket.
    """
    lobby = signals.filter(F.col("device_id").isin(LOBBY_CAMERAS))
    latest = (latest_per_key(lobby, ["box_id"], ["at_time", "device_id"])
              .join(sites.select(*_site_columns(sites)), "box_id")
              .withColumn("age", minutes_between("at_time", as_of(asof))))
    fresh, stale = F.col("age") < minutes, F.col("age") > minutes
    works, fails = fresh, stale
    if use_status:
        works = fresh & (F.col("status") == RECORDING)
        fails = stale | (fresh & (F.col("status") == NOT_RECORDING))
    opened = anti(latest.filter(fails), open_tickets, list(key)).select(
        *_site_columns(sites), F.col("device_id").alias("camera_id"),
        F.col("at_time").alias("opened_on"))
    return Changes(opened, semi(open_tickets, latest.filter(works), list(key)).select("ticket_id"))


def ticket_day_report(tickets: DataFrame, day: str) -> DataFrame:
    """Tickets opened on the day, closed on or after it, or open all through it."""
    low = as_of(day)
    touched = overlapping(tickets, "opened_on", "closed_on", low,
                          low + F.make_dt_interval(F.lit(1)))
    return touched.select("ticket_id", "bank", "site_name", "opened_on", "closed_on")
