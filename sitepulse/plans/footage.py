"""Is there video for a disputed transaction, and if not, why?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import clip, first_match, percent
from sitepulse.operators import covered_points, flag_members, latest_per_key

# Lobby cameras, and the camera whose tickets count.
LOBBY_CAMERAS = ["0702", "0702R"]
TICKET_CAMERA = "0702"


def lobby_availability(recordings: DataFrame, cameras: Sequence[str] = LOBBY_CAMERAS,
                       per_day: int = 1000) -> DataFrame:
    """Recorded share of the lobby per box and day, from the latest count of each camera."""
    stamped = recordings.filter(F.col("camera_id").isin(list(cameras))).withColumn(
        "date", F.to_date("at_time"))
    latest = latest_per_key(stamped, ["box_id", "camera_id", "date"],
                            ["at_time", "file_count", "remote_file_count"])
    files = F.coalesce("file_count", F.lit(0)) + F.coalesce("remote_file_count", F.lit(0))
    return latest.groupBy("box_id", "date").agg(
        clip(percent(F.sum(files), per_day), 0, 100).alias("availability"))


def footage_status(requests: DataFrame, availability: DataFrame, episodes: DataFrame,
                   camera_tickets: DataFrame, disk_tickets: DataFrame, *,
                   open_covers: bool = True) -> DataFrame:
    """One answer per request (ticket_id, site_id, box_id, asked_at)."""
    spans = {
        "_offline": episodes.select("site_id", F.col("at_time").alias("_from"),
                                    F.col("closed_on").alias("_to")),
        "_camera": camera_tickets.filter(F.col("camera_id") == TICKET_CAMERA).select(
            "site_id", F.col("opened_on").alias("_from"), F.col("closed_on").alias("_to")),
        "_disk": disk_tickets.select("site_id", F.col("opened_on").alias("_from"),
                                     F.col("closed_on").alias("_to")),
    }
    flagged = covered_points(requests, spans, "site_id", "asked_at", "_from", "_to",
                             open_covers=open_covers)
    dated = flagged.withColumn("date", F.to_date("asked_at")).join(
        availability, ["box_id", "date"], "left").fillna(0.0, ["availability"])
    now = flag_members(dated, episodes.filter("closed_on is null"), ["site_id"], "_down_now")
    share = F.col("availability")
    no_video = F.col("_offline") | F.col("_camera")
    return now.select(
        "ticket_id", "site_id", "asked_at", "availability",
        first_match([(share > 99, "Available"), (no_video, "Not Available"),
                     (share > 1, "Available")], "Not Available").alias("video_status"),
        first_match([(share > 99, None), (F.col("_offline"), "Offline"),
                     (F.col("_camera"), "Camera Issue"), (F.col("_disk"), "HDD Issue"),
                     (share > 1, "No HDD Issue")], "Online - No HDD Issue").alias("reason"),
        F.when(F.col("_down_now") == 1, "Offline").otherwise("Online").alias("current_status"))
