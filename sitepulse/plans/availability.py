"""How long sites were online, and whether missing video is explained by it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import (
    as_of, clip, days_before, drop_blanks, first_match, minutes_between, percent, recode,
    row_argmin, row_null_count, row_range,
)
from sitepulse.operators import clip_intervals, dedupe, downtime_minutes, first_per_key

MINUTES_PER_DAY = 1440
FILES_PER_DAY = 1000


def reported_alive(episodes: DataFrame, heartbeats: DataFrame) -> DataFrame:
    """Open episodes whose site has sent a heartbeat after the start."""
    seen = heartbeats.groupBy("site_id").agg(F.max("received").alias("_seen"))
    return (episodes.filter("closed_on is null").join(seen, "site_id")
            .filter("opened_on < _seen").drop("_seen"))


def live_episodes(episodes: DataFrame, heartbeats: DataFrame, day_start: Column) -> DataFrame:
    """Offline episodes without repeats, false alarms and those that began after ``day_start``.

    An open episode is a false alarm when its site was heard of after the episode was opened.
    """
    single = dedupe(episodes, ["site_id", "event_type", "at_time"], ["event_id"])
    known = single.filter("event_id is not null and at_time is not null")
    began = known.filter(~(F.col("closed_on").isNull() & (F.col("at_time") >= day_start)))
    seen = heartbeats.groupBy("site_id").agg(F.max("received").alias("_seen"))
    heard = F.coalesce(F.col("opened_on") < F.col("_seen"), F.lit(False))
    return (began.join(seen, "site_id", "left")
            .filter(~(F.col("closed_on").isNull() & heard)).drop("_seen"))


def _touching(episodes: DataFrame, low: Column, high: Column) -> DataFrame:
    """Closed inside the range after starting before its end, or still open."""
    return episodes.filter(
        (F.col("closed_on").between(low, high) & (F.col("opened_on") < high))
        | F.col("closed_on").isNull())


def site_online_pct(sites: DataFrame, episodes: DataFrame, heartbeats: DataFrame, asof,
                    days: int = 30) -> DataFrame:
    """Share of the last ``days`` days each site was online."""
    high = days_before(asof, 0, whole_days=True)
    low = days_before(asof, days, whole_days=True)
    live = live_episodes(_touching(episodes, low, high), heartbeats, high)
    down = downtime_minutes(clip_intervals(live, "at_time", "closed_on", low, high),
                            ["site_id"], "at_time", "closed_on", "down_minutes")
    joined = sites.select("site_id", "site_name", "bank").join(down, "site_id", "left")
    offline = percent(F.coalesce(F.col("down_minutes"), F.lit(0)), MINUTES_PER_DAY * days)
    return joined.select("bank", "site_name", "site_id",
                         F.round(F.lit(100.0) - offline, 2).alias("online_pct"))


def daily_offline_pct(episodes: DataFrame, heartbeats: DataFrame, first_day: str,
                      last_day: str) -> DataFrame:
    """Offline share per site and day of the range.

    An episode is cut at midnight into one piece per day it touches; each piece is rounded to
    two decimals before it is added up.
    """
    low = as_of(first_day)
    high = as_of(last_day) + F.make_dt_interval(F.lit(1))
    live = clip_intervals(
        live_episodes(episodes.filter((F.col("opened_on") < high)
                                      & (F.col("closed_on").isNull()
                                         | (F.col("closed_on") >= low))), heartbeats, high),
        "at_time", "closed_on", low, high)
    last_touched = F.least(F.to_date("closed_on"), F.lit(last_day).cast("date"))
    pieces = live.select("site_id", "at_time", "closed_on", F.explode(F.sequence(
        F.to_date("at_time"), F.greatest(last_touched, F.to_date("at_time")))).alias("date"))
    day_low = F.col("date").cast("timestamp_ntz")
    day_high = day_low + F.make_dt_interval(F.lit(1))
    minutes = minutes_between(F.greatest("at_time", day_low), F.least("closed_on", day_high))
    return (pieces.select("site_id", "date", percent(minutes, MINUTES_PER_DAY).alias("share"))
            .groupBy("site_id", "date").agg(F.round(F.sum("share"), 2).alias("offline_pct")))


def video_availability(sites: DataFrame, cameras: DataFrame, recordings: DataFrame,
                       episodes: DataFrame, heartbeats: DataFrame, first_day: str, last_day: str,
                       camera_names: Mapping[str, str], *, per_day: int = FILES_PER_DAY
                       ) -> DataFrame:
    """Recorded share per camera, site and day, compared with the site's online share.

    The earliest count per camera name and day is taken, also where several camera ids have one
    name. ``camera_names`` maps camera names (without blanks) to output columns.
    """
    first, last = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    named = cameras.filter("active").select(
        "box_id", "camera_id", drop_blanks(F.col("camera_name")).alias("camera"))
    columns = list(camera_names.values())
    installed = named.groupBy("box_id").agg(*[
        F.count_if(F.col("camera") == name).alias(f"_n_{column}")
        for name, column in camera_names.items()])
    stamped = recordings.withColumn("date", F.to_date("at_time")).filter(
        F.col("date").between(first, last))
    order = ["at_time", "file_count", "remote_file_count"]
    # One row per camera id goes into the join, one per name is left after it.
    counted = first_per_key(
        first_per_key(stamped, ["box_id", "camera_id", "date"], order)
        .join(named.distinct(), ["box_id", "camera_id"]),
        ["box_id", "camera", "date"], [*order, "camera_id"])
    files = F.coalesce("file_count", F.lit(0)) + F.coalesce("remote_file_count", F.lit(0))
    recorded = counted.groupBy("box_id", "date").agg(*[
        F.max(F.when(F.col("camera") == name, files)).alias(column)
        for name, column in camera_names.items()])

    # Days without any recording appear here, one row per box and day, not per camera.
    calendar = installed.select("*", F.explode(F.sequence(first, last)).alias("date"))
    shares = calendar.join(recorded, ["box_id", "date"], "left").withColumns({
        c: F.when(F.col(f"_n_{c}") > 0, clip(
            percent(F.coalesce(F.col(c), F.lit(0)), per_day), 0, 100)) for c in columns})
    # Decimal sums, so that the mean does not depend on the order of the additions.
    total = sum((F.coalesce(F.col(c).cast("decimal(9,2)"), F.lit(0).cast("decimal(9,2)"))
                 for c in columns[1:]),
                F.coalesce(F.col(columns[0]).cast("decimal(9,2)"), F.lit(0).cast("decimal(9,2)")))
    present = F.lit(len(columns)) - row_null_count(columns)
    by_name = sorted(columns, key={c: n for n, c in camera_names.items()}.get)
    worst = recode(row_argmin(by_name), {c: n for n, c in camera_names.items()})
    stats = shares.filter(present > 0).withColumns({
        "video_pct": F.round(total / present, 2).cast("double"), "spread": row_range(columns),
        "worst_camera": worst})
    offline = daily_offline_pct(episodes, heartbeats, first_day, last_day)
    joined = (sites.select("site_id", "box_id", "site_name", "bank")
              .join(stats, "box_id")
              .join(offline, ["site_id", "date"], "left")
              .withColumn("site_pct", F.round(
                  F.lit(100.0) - F.coalesce("offline_pct", F.lit(0.0)), 2))
              .withColumn("gap", F.round(F.col("site_pct") - F.col("video_pct"), 2)))
    gap, spread = F.col("gap"), F.col("spread")
    status = first_match([
        (gap >= 50, "Site Level Video Recording Issue"),
        ((gap >= 20) & (spread <= 20), "Site Level Video Recording Issue"),
        (gap < 20, "No Issue"), ((gap >= 20) & (spread > 20), "Camera Issue")])
    remark = F.when(F.col("status") == "Camera Issue",
                    F.concat("worst_camera", F.lit(" Issue"))).otherwise(F.col("status"))
    return joined.withColumn("status", status).withColumn("remark", remark).select(
        "date", "bank", "site_name", "site_id", "box_id", *columns, "video_pct",
        "site_pct", "remark")
