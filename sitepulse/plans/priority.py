"""Which sites deserve attention: guard presence, last manual closure, visits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import as_of, contains, cube_root, minutes_between
from sitepulse.operators import bucket_by_rank
from sitepulse.sources.readers import look_back

# Codes of the back room and motion tickets, night hours and rank bands.
UNIT, BACKROOM_GROUP, MOTION_GROUP = "01", "32", "36"
NIGHT_HOURS = [22, 23, 0, 1, 2, 3, 4, 5]
EDGES = [-1, 0.2, 0.4, 0.6, 0.8, 1]
RECENCY_SCORES = [5, 4, 3, 2, 1]
VISIT_SCORES = [1, 2, 3, 4, 5]
CLASSES = ["S1", "S2", "S3", "S4", "S5"]


def site_features(sites: DataFrame, tickets: DataFrame, asof, *, days: int = 7) -> DataFrame:
    """Four scores per site from the tickets of the last days, which are read once per use."""
    recent = look_back(tickets, "at_time", asof, days=days).filter(F.col("at_time") <= as_of(asof))
    unit = F.col("unit_no") == UNIT
    guarded = unit & (F.col("group_no") == BACKROOM_GROUP) & contains(F.col("closing_reason"),
                                                                       "security")
    closure = F.when(F.col("closed_by").isNotNull() & F.col("closed_on").isNotNull(),
                     F.struct("at_time", "event_id", "closed_on"))
    # Tickets that repeat a message and time count as one visit.
    single = recent.groupBy("site_id", "msg", "at_time").agg(
        F.max(guarded).alias("guarded"), F.max(closure).alias("closure"),
        F.max(unit & (F.col("group_no") == MOTION_GROUP)).alias("motion"))
    night = F.col("motion") & F.hour("at_time").isin(NIGHT_HOURS)
    seen = single.groupBy("site_id").agg(
        F.max("guarded").alias("guarded"), F.max("closure").alias("closure"),
        F.count_if("motion").alias("visits"), F.count_if(night).alias("nights"))
    base = sites.select("bank", "site_name", "site_id").join(seen, "site_id", "left").select(
        "bank", "site_name", "site_id",
        F.coalesce(F.col("guarded"), F.lit(False)).cast("int").alias("security"),
        minutes_between("closure.closed_on", as_of(asof)).alias("since_closure"),
        F.coalesce("visits", F.lit(0)).alias("visits"),
        F.coalesce("nights", F.lit(0)).alias("nights"))
    listed = recent.filter(unit & (F.col("group_no") == MOTION_GROUP)).join(
        sites.select("site_id"), "site_id", "left_semi")
    any_visit = listed.agg(F.count(F.lit(1))).scalar() > 0
    ranked = bucket_by_rank(base, {
        "since_closure": ("manual_closure", RECENCY_SCORES), "visits": ("footfall", VISIT_SCORES),
        "nights": ("night_visit", VISIT_SCORES)}, EDGES, key="site_id")
    return ranked.select(
        "bank", "site_name", "site_id", "security",
        F.coalesce("manual_closure", F.lit(1)).alias("manual_closure"),
        F.when(any_visit, F.col("footfall")).otherwise(0).alias("footfall"),
        F.when(any_visit, F.col("night_visit")).otherwise(0).alias("night_visit"))


def site_priority(features: DataFrame) -> DataFrame:
    """Geometric mean of the three scores plus the guard flag, ranked into S1..S5.

    ``features`` is read twice; on large tables pass a stored one.
    """
    score = F.round(cube_root(F.col("manual_closure"), F.col("footfall"), F.col("night_visit"))
                    + F.col("security"), 2)
    # Three scores from 1 to 5 and a flag: some hundred values at most.
    ranked = bucket_by_rank(features.withColumn("_score", score),
                            {"_score": ("site_priority", CLASSES)}, EDGES, few=True)
    return ranked.drop("_score")
