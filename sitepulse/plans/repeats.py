"""Faults that came back at least three times in a week."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import as_of
from sitepulse.operators import exclusive_classes
from sitepulse.sources.readers import look_back

# Camera names of the report and the two disk errors with a class of their own.
CAMERA_NAMES = ["Outdoor Camera", "Lobby Camera", "Lobby2 Camera", "Lobby3 Camera",
                "Backroom Camera", "Pinhole Camera"]
NO_ENTRY, NO_DRIVE = "ENOENT", "ENODR"
SITE = ["bank", "site_name", "street", "district", "state"]


def repeated_camera_faults(tickets: DataFrame, asof, *, days: int = 7, at_least: int = 3,
                           names: Sequence[str] = CAMERA_NAMES) -> DataFrame:
    """One row per site and camera name."""
    keys = [c for c in SITE if c in tickets.columns]
    recent = look_back(tickets, "opened_on", asof, days=days).filter(
        F.col("camera_name").isin(list(names)))
    return (recent.groupBy(*keys, "camera_name")
            .agg(F.count(F.lit(1)).alias("count_7days")).filter(F.col("count_7days") >= at_least)
            .select(F.to_date(as_of(asof)).alias("date"), *keys, "count_7days",
                    F.col("camera_name").alias("remark")))


def repeated_disk_faults(tickets: DataFrame, asof, *, days: int = 7, at_least: int = 3,
                         first: str = NO_ENTRY, second: str = NO_DRIVE) -> DataFrame:
    """One row per site, in the first class that fits: one error only, the two together, any."""
    keys = [c for c in SITE if c in tickets.columns]
    counted = look_back(tickets, "opened_on", asof, days=days).groupBy(*keys).agg(
        F.count_if(F.col("error") == first).alias("_first"),
        F.count_if(F.col("error") == second).alias("_second"),
        F.count("error").alias("_all"))
    one, two, every = F.col("_first"), F.col("_second"), F.col("_all")
    classes = [
        (first, (one == every) & (one >= at_least), one),
        (second, (two == every) & (two >= at_least), two),
        (f"{first}+{second}", one + two >= at_least, one + two),
        ("Others", every >= at_least, every),
    ]
    rows = exclusive_classes(counted, "remark", classes, "count_7days")
    return rows.select(F.to_date(as_of(asof)).alias("date"), *keys, "count_7days", "remark")
