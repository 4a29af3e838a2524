"""When did each installed sensor last fire, and which sites need a visit first?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import as_of, cut, hours_between, recode
from sitepulse.operators import bucket_by_rank, latest_values, pivot_mode, semi

# Codes, sensor units, age bands (hours) and scores.
GROUP = "01"
HEARTBEAT_CODE = "20"
TRIGGER_CODES = ["40", "48", "58", "59"]
SENSOR_UNITS = ["08", "09", "10", "11", "65", "66", "67", "12", "13", "14", "15", "75", "76",
                "77", "32", "33", "36", "56", "46", "47", "48", "49", "60", "61", "62"]
AGE_EDGES = [float("-inf"), 359, 719, 2159, 4319, 8759, float("inf")]
AGE_LABELS = ["<15days", "15-30days", "1-3months", "3-6months", "6-12months", ">1year"]
NO_TRIGGER = "Sensor Installed but No Trigger"
SCORES = {"<15days": 0, "15-30days": 2, "1-3months": 3, "3-6months": 4, "6-12months": 5,
          ">1year": 5, NO_TRIGGER: 5}
RECENT = "<15days"
PRIORITIES = ["P5", "P4", "P3", "P2", "P1"]
RANK_EDGES = [-1, 0.2, 0.4, 0.6, 0.8, 1]
LOW_RANK_EDGES = [-1, 0.19, 0.39, 0.59, 0.79, 2]
RENAMED_SENSORS = {
    "Lobby Motion Detector": "Lobby Movement Sensor",
    "Back Room Door Contact Sensor": "Backroom Door Sensor",
    "Battery Bank Location Sensor": "ATM1 Battery Bank Location Sensor",
    "ATM1 Hood Contact Sensor": "ATM1 Hood Sensor",
    "ATM4 Chest Vibration Sensor": "ATM4 Vibration Sensor",
}


def sensor_recency(installed: DataFrame, signals: DataFrame, dictionary: DataFrame, asof, *,
                   units: Sequence[str] = SENSOR_UNITS, group: str = GROUP) -> DataFrame:
    """Per installed sensor the age label of its last trigger and its last heartbeat."""
    key = ["site_id", "group_no", "unit_no"]
    sensors = installed.filter(F.col("active") & (F.col("group_no") == group)
                               & F.col("unit_no").isin(list(units)))
    names = (installed.filter(F.col("active") & (F.col("group_no") == group)
                              & F.col("item_name").isNotNull())
             .groupBy("group_no", "unit_no").agg(F.min("item_name").alias("item_name")))
    fired = F.col("event_code").isin(TRIGGER_CODES)
    wanted = signals.filter((F.col("group_no") == group) & F.col("unit_no").isin(list(units))
                            & (fired | (F.col("event_code") == HEARTBEAT_CODE)))
    listed = semi(wanted, dictionary, ["group_no", "unit_no", "event_code"])
    last = latest_values(listed, key, "at_time", {
        "last_trigger": fired, "last_heartbeat": F.col("event_code") == HEARTBEAT_CODE})

    def label(at: str) -> Column:
        age = hours_between(at, as_of(asof))
        return F.coalesce(cut(age, AGE_EDGES, AGE_LABELS), F.lit(NO_TRIGGER))

    return (sensors.select(*key).distinct().join(last, key, "left")
            .join(names, ["group_no", "unit_no"])
            .select(*key, recode(F.col("item_name"), RENAMED_SENSORS).alias("item_name"),
                    label("last_trigger").alias("trigger_label"),
                    label("last_heartbeat").alias("heartbeat_label")))


def sensor_matrix(recency: DataFrame, sites: DataFrame, columns: Mapping[str, str], asof,
                  kind: str = "trigger") -> DataFrame:
    """Sites by sensors; NULL where a sensor is not installed. ``columns`` maps item names."""
    wide = pivot_mode(recency, ["site_id"], "item_name", columns, f"{kind}_label")
    site = [c for c in ("bank", "site_name", "site_id", "street", "district", "state", "zone")
            if c in sites.columns]
    return sites.select(F.to_date(as_of(asof)).alias("date"), *site).join(
        wide, "site_id", "left")


def sensor_risk(matrix: DataFrame, columns: Sequence[str], video_daily: DataFrame, *,
                weighted: bool = True) -> DataFrame:
    """Risk score per site that was online at all in the availability rows given.

    The score adds the sensors' scores; ``weighted`` multiplies by the number of sensors that
    are not recent. Sites without risk are left out.
    """
    online = (video_daily.groupBy("site_id").agg(F.avg("site_availability").alias("_mean"))
              .filter("_mean != 0").select("site_id"))
    score, problems = F.lit(0), F.lit(0)
    for name in columns:
        points = recode(F.col(name), SCORES, keep_unmapped=False).cast("int")
        score = score + F.coalesce(points, F.lit(0))
        problems = problems + (points.isNotNull() & (F.col(name) != RECENT)).cast("int")
    risk = score * problems if weighted else score
    rated = semi(matrix, online, ["site_id"]).withColumn("risk_score", risk)
    return rated.filter("risk_score != 0")


def sensor_priority(risk: DataFrame, edges: Sequence[float] = RANK_EDGES) -> DataFrame:
    """P1 (most urgent fifth) to P5. ``risk`` is read twice; on large tables pass a stored one."""
    # A score is at most 5 points for each of some dozen sensors, times their number.
    return bucket_by_rank(risk, {"risk_score": ("priority", PRIORITIES)}, edges, few=True)


def most_urgent_first(prioritised: DataFrame) -> DataFrame:
    """Report order: P1 before P5, then the higher score."""
    order = recode(F.col("priority"), {p: i for i, p in enumerate(PRIORITIES)},
                   keep_unmapped=False).cast("int")
    return prioritised.orderBy(order.desc(), F.desc("risk_score"), "site_id")
