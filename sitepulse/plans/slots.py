"""Signals per site, day and four-hour slot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import not_text, slot_label
from sitepulse.functions.time import SLOT_NAMES
from sitepulse.operators import crosstab_counts, dedupe, semi

# Group and unit codes of the counted sensors.
GROUP, MOTION_UNIT, DOOR_UNIT, DOOR_OPEN_CODE = "01", "36", "33", "40"


def critical_sensor_events(tickets: DataFrame) -> DataFrame:
    """Closed tickets of all sensors but the main door, not closed by the system itself."""
    kept = tickets.filter(
        (F.col("group_no") == GROUP) & (F.col("unit_no") != DOOR_UNIT)
        & F.col("closed_on").isNotNull()
        & not_text(F.col("closed_by"), "system", keep_null=False))
    return dedupe(kept, ["site_id", "group_no", "unit_no", "msg", "at_time"], ["event_id"])


def door_events(signals: DataFrame) -> DataFrame:
    kept = signals.filter((F.col("group_no") == GROUP) & (F.col("unit_no") == DOOR_UNIT)
                          & (F.col("event_code") == DOOR_OPEN_CODE))
    return dedupe(kept, ["site_id", "group_no", "unit_no", "at_time"])


def motion_events(tickets: DataFrame) -> DataFrame:
    kept = tickets.filter((F.col("group_no") == GROUP) & (F.col("unit_no") == MOTION_UNIT))
    return dedupe(kept, ["site_id", "group_no", "unit_no", "msg", "at_time"], ["event_id"])


def installed_sites(items: DataFrame, unit: str | None = None) -> DataFrame:
    """Sites with a live sensor, of one unit or of any."""
    live = items.filter(F.col("active") & F.col("enabled") & F.col("item_name").isNotNull())
    if unit is not None:
        live = live.filter((F.col("group_no") == GROUP) & (F.col("unit_no") == unit))
    return live.select("site_id").distinct()


def slot_counts(events: DataFrame, at: str, sites: DataFrame, installed: DataFrame,
                first_day: str, last_day: str) -> DataFrame:
    """Six counts per installed site and day of the range, zeros included."""
    counted = crosstab_counts(
        events.select("site_id", F.to_date(at).alias("date"), slot_label(at).alias("slot")),
        ["date", "site_id"], "slot", SLOT_NAMES)
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    calendar = semi(sites.select("site_id", "site_name", "bank"), installed, ["site_id"]).select(
        "*", F.explode(days).alias("date"))
    dense = calendar.join(counted, ["date", "site_id"], "left").fillna(0, SLOT_NAMES)
    return dense.select("date", "bank", "site_name", "site_id", *SLOT_NAMES)
