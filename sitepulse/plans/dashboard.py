"""Dashboard tiles and the rows behind each tile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import as_of, days_before
from sitepulse.operators import conditional_counts, group_size, union_all
from sitepulse.sources.readers import look_back, scope
from sitepulse.sources.writers import nested_document

VIOLATIONS = ["sos_ack", "sos_close", "critical_ack", "critical_close"]

# Tile labels, and the source tables that the document names.
MOTION_TITLE = "Movement in Lobby > 3 min and 1 critical sensor failure"
DOOR_TITLE = "4 Main door ops in last 15 mins No PIR and 1 critical sensor failure"
NEAR_TITLE = "Monitoring Events nearing SLA Violation"
VIOLATED_TITLE = "SLA Violated on Monitoring"
OPENS_SUBTITLE, NEAR_SUBTITLE = "Main Door Open Count", "SLA Category"
VIOLATED_SUBTITLE = "SLA Violations"
MOTION_TABLE, DOOR_TABLE = "pir_events", "do2do_events"
NEAR_TABLE, VIOLATED_TABLE = "RealTimeSlaViolatedTicket", "SlaViolationBankwise"
SITE_LINK = "Site Link"


def door_tests() -> dict[str, Column]:
    """Row tests of the door tiles."""
    opens, sensor = F.col("main_door_open"), F.col("main_door_sensor")
    return {
        ">12": opens >= 12, ">8": (opens >= 8) & (opens < 12), ">4": (opens >= 4) & (opens < 8),
        "DoorOff": (opens == 0) & (sensor == 0),
        "DoorOpened": (opens == 0) & (F.col("main_door_status") == "Opened") & (sensor != 0),
    }


def action_tests() -> dict[str, Column]:
    kind, action = F.col("event_type"), F.col("required_action")
    return {
        "SOSAck": (kind == "SOS") & (action == "TicketToAck"),
        "SOSClose": (kind == "SOS") & (action == "TicketToClose"),
        "CriticalAck": (kind == "Critical") & (action == "TicketToAck"),
        "CriticalClose": (kind == "Critical") & (action == "TicketToClose"),
    }


def violation_tests(asof) -> dict[str, Column]:
    """Date ranges of the violation tiles; the last two end before the day of ``asof``."""
    today = F.to_date(days_before(asof, 0, whole_days=True))
    day = F.col("date")
    return {
        "All": day >= F.trunc(today, "month"), "Yesterday": day == F.date_sub(today, 1),
        "Last7Days": (day >= F.date_sub(today, 7)) & (day < today),
        "Last30Days": (day >= F.date_sub(today, 30)) & (day < today),
    }


def recent_open(events: DataFrame, asof, hours: int, banks: Sequence[str] | str) -> DataFrame:
    return look_back(scope(events, banks), "opened_on", asof, hours=hours).filter(
        "closed_on is null")


def _violated() -> Column:
    cells = [F.coalesce(F.col(m), F.lit(0)) for m in VIOLATIONS]
    return sum(cells[1:], cells[0])


def dashboard_counts(motion: DataFrame, door: DataFrame, near: DataFrame, daily: DataFrame, asof,
                     *, hours: int = 2, banks: Sequence[str] | str = "ALL") -> DataFrame:
    """All tiles in one row: one pass over each of the four inputs."""
    every = F.lit(True)
    tests = door_tests()
    motion_row = conditional_counts(recent_open(motion, asof, hours, banks), {
        f"motion_{k}": v for k, v in {"all": every, **tests}.items()})
    door_row = conditional_counts(recent_open(door, asof, hours, banks), {
        "door_all": every, **{f"door_{k}": tests[k] for k in (">12", ">8", ">4")}})
    near_row = conditional_counts(scope(near, banks), {
        f"near_{k}": v for k, v in {"all": every, **action_tests()}.items()})
    sums = scope(daily, banks).agg(*[
        F.coalesce(F.sum(F.when(test, _violated())), F.lit(0)).alias(f"violated_{name}")
        for name, test in violation_tests(asof).items()])
    rows = [motion_row, door_row, near_row, sums]
    tiles = union_all([row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("tile"), F.col(c).cast("long").alias("value"))
        for c in row.columns]))) for row in rows])
    return tiles.groupBy().agg(*[
        F.max(F.when(F.col("tile") == c, F.col("value"))).alias(c)
        for row in rows for c in row.columns])


def dashboard_document(counts: DataFrame) -> DataFrame:
    """The tiles as one JSON document."""
    def parts(prefix: str, *names: str) -> dict[str, str]:
        return {name: f"{prefix}_{name}" for name in names}

    return nested_document(counts, {
        "box1": {"title": MOTION_TITLE, "table": MOTION_TABLE, "subtitle": OPENS_SUBTITLE,
                 "total": "motion_all",
                 "parts": parts("motion", ">12", ">8", ">4", "DoorOff", "DoorOpened")},
        "box2": {"title": DOOR_TITLE, "table": DOOR_TABLE, "subtitle": OPENS_SUBTITLE,
                 "total": "door_all", "parts": parts("door", ">12", ">8", ">4")},
        "box3": {"title": NEAR_TITLE, "table": NEAR_TABLE, "subtitle": NEAR_SUBTITLE,
                 "total": "near_all",
                 "parts": parts("near", "SOSAck", "SOSClose", "CriticalAck", "CriticalClose")},
        "box4": {"title": VIOLATED_TITLE, "table": VIOLATED_TABLE, "subtitle": VIOLATED_SUBTITLE,
                 "total": "violated_All",
                 "parts": parts("violated", "Yesterday", "Last7Days", "Last30Days")},
    })


def _chosen(tests: dict[str, Column], tile: str) -> Column:
    return F.lit(True) if tile == "All" and tile not in tests else tests[tile]


def door_records(events: DataFrame, asof, tile: str = "All", *, hours: int = 2,
                 banks: Sequence[str] | str = "ALL") -> DataFrame:
    """Open door tickets behind a tile, with the number of such tickets of the site."""
    rows = recent_open(events, asof, hours, banks).filter(_chosen(door_tests(), tile)).select(
        "ticket_id", "bank", "site_name", "opened_on", "main_door_open")
    return (group_size(rows, ["site_name"], "site_tickets")
            .withColumn("site_url", F.lit(SITE_LINK)).orderBy(*[
                F.desc(c) for c in ("site_tickets", "site_name", "opened_on", "main_door_open")]))


def near_violation_records(near: DataFrame, tile: str = "All", *,
                           banks: Sequence[str] | str = "ALL", counted: bool = True) -> DataFrame:
    """Urgent tickets behind a tile. Without ``counted`` it is the plain list with site ids."""
    chosen = scope(near, banks).filter(_chosen(action_tests(), tile))
    shown = ["event_id", "event_type", "msg", "opened_on", "age_minutes", "required_action"]
    if not counted:
        return chosen.select("bank", "site_name", "site_id", *shown)
    rows = chosen.select("bank", "site_name", *shown)
    return group_size(rows, ["site_name"], "site_tickets").orderBy(
        *[F.desc(c) for c in ("site_tickets", "site_name", "opened_on", "event_id")])


def violation_records(daily: DataFrame, asof, tile: str = "All", *,
                      banks: Sequence[str] | str = "ALL") -> DataFrame:
    """Violations per customer in the date range of a tile."""
    rows = scope(daily, banks).filter(violation_tests(asof)[tile])
    return rows.groupBy("bank").agg(
        F.sum(_violated()).alias("total_violations"), *[F.sum(m).alias(m) for m in VIOLATIONS])
