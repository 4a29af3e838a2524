"""Video-on-demand reports: did each camera record enough files a day?"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import clip, first_match, percent, recode, row_sum
from sitepulse.operators import latest_per_key, pivot_text

# Camera codes, their names, and the file count of a full day.
CAMERA_ALIASES = {"0702R": "0702"}
CAMERA_NAMES = {"0701": "Outdoor Camera", "0702": "Lobby Camera", "0702R": "Lobby Camera",
                "0703": "Backroom Camera", "0704": "Pinhole Camera"}
CAMERA_COLUMNS = {"Backroom Camera": "backroom", "Lobby Camera": "lobby",
                  "Outdoor Camera": "outdoor", "Pinhole Camera": "pinhole"}
FULL_DAY = 860
LABELS = ["0", "NO", "PR", "YES"]


def daily_totals(recordings: DataFrame) -> DataFrame:
    """Files per box, camera and day: the best count of a camera, remote camera merged in."""
    stamped = recordings.withColumn("date", F.to_date("at_time"))
    best = latest_per_key(stamped, ["box_id", "camera_id", "date"],
                          ["file_count", "at_time", "remote_file_count"])
    merged = best.withColumn("camera_id", recode(F.col("camera_id"), CAMERA_ALIASES))
    files = F.coalesce("file_count", F.lit(0)) + F.coalesce("remote_file_count", F.lit(0))
    return merged.groupBy("box_id", "camera_id", "date").agg(F.sum(files).alias("files"))


def camera_matrix(cameras: DataFrame, totals: DataFrame, first_day: str,
                  last_day: str) -> DataFrame:
    """Mean files per box, day and camera name; NULL where no such camera is installed."""
    installed = cameras.filter("active").select("box_id", "camera_id", "camera_name")
    per_box = installed.groupBy("box_id").agg(*[
        F.count_if(F.col("camera_name") == name).alias(f"_n_{column}")
        for name, column in CAMERA_COLUMNS.items()])
    named = totals.withColumn("camera_name", recode(F.col("camera_id"), CAMERA_NAMES))
    recorded = (named.join(installed, ["box_id", "camera_id", "camera_name"])
                .groupBy("box_id", "date").agg(*[
                    F.sum(F.when(F.col("camera_name") == name, F.col("files"))).alias(column)
                    for name, column in CAMERA_COLUMNS.items()]))
    # Days without any recording appear here, one row per box and day, not per camera.
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    calendar = per_box.select("*", F.explode(days).alias("date"))
    return calendar.join(recorded, ["box_id", "date"], "left").select("box_id", "date", *[
        F.when(F.col(f"_n_{c}") > 0, F.coalesce(F.col(c), F.lit(0)) / F.col(f"_n_{c}")).alias(c)
        for c in CAMERA_COLUMNS.values()])


def _label(files: Column, full: float) -> Column:
    return first_match([(files >= full, "YES"), (files >= 1, "PR"), (files == 0, "NO")])


def vod_daily(sites: DataFrame, matrix: DataFrame, *, full: float = FULL_DAY) -> DataFrame:
    """YES / PR / NO per camera; the status follows the lobby camera unless nothing recorded."""
    cams = list(CAMERA_COLUMNS.values())
    labelled = matrix.withColumn("_total", row_sum(cams)).withColumns(
        {c: _label(F.col(c), full) for c in cams})
    status = F.when(F.col("_total") == 0, "NO").otherwise(F.col("lobby"))
    return (sites.select("site_id", "box_id", "site_name", "bank").join(labelled, "box_id")
            .select("date", "bank", "site_name", "site_id", "box_id", *cams,
                    status.alias("status")))


def vod_summary(daily: DataFrame) -> DataFrame:
    status = F.col("status")
    return daily.groupBy("date", "bank").agg(
        F.count(F.lit(1)).alias("total_sites"), F.count_if(status == "YES").alias("full"),
        F.count_if(status == "PR").alias("partial"),
        F.count_if(status.isin("YES", "PR")).alias("received"),
        F.count_if(status == "NO").alias("zero"))


def vod_counts(sites: DataFrame, matrix: DataFrame, *, full: float = FULL_DAY) -> DataFrame:
    """File counts per camera and the lobby's share of a full day."""
    cams = list(CAMERA_COLUMNS.values())
    return (sites.select("site_id", "box_id", "site_name", "bank")
            .join(matrix, "box_id", "left")
            .select("date", "bank", "site_name", "site_id", "box_id", *cams,
                    clip(percent(F.col("lobby"), full), 0, 100).alias("lobby_pct")))


def vod_matrix(daily: DataFrame, camera: str, dates: Mapping[str, str]) -> DataFrame:
    """Labels of one camera per site, one column per date; ``'0'`` is "not installed"."""
    edge = daily.select("site_id", F.col("date").cast("string").alias("date"),
                        F.coalesce(F.col(camera), F.lit("0")).alias("label"))
    return pivot_text(edge, ["site_id"], "date", dates, "label", LABELS)


def vod_report(daily: DataFrame, counts: DataFrame, dates: Mapping[str, str],
               last_day: str) -> dict[str, DataFrame]:
    """Sheets of the 30-day report, to be stored with ``write_sheets``."""
    sheets = {"Summary": vod_summary(daily)}
    for name, column in (("Lobby", "lobby"), ("Outdoor", "outdoor"), ("Backroom", "backroom"),
                         ("Pinhole", "pinhole")):
        sheets[name] = vod_matrix(daily, column, dates)
    sheets["LobbyShare"] = counts.filter(F.col("date") == F.lit(last_day).cast("date"))
    return sheets
