"""Sensor and site priority, and the portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse import bindings as b
from sitepulse.bindings import half_up, with_views
from sitepulse.catalog.registry import minutes, query
from sitepulse.plans import portfolio, priority, sensors

ASOF_SQL = f"timestamp '{b.ASOF}'"
# Two weeks after the sample ends, so that sensors fall into several age bands.
SENSOR_ASOF = "2024-02-13 12:00:00"
COLUMNS = {"Lobby Movement Sensor": "motion", "Main Door Sensor": "door",
           "Backroom Door Sensor": "backroom", "ATM1 Hood Sensor": "hood",
           "ATM1 Chest Sensor": "chest"}


def _label(at: str) -> str:
    hours = f"floor((epoch_us(timestamp '{SENSOR_ASOF}') - epoch_us({at})) / 3600000000.0)"
    return (f"case when {at} is null then 'Sensor Installed but No Trigger' when {hours} <= 359 "
            f"then '<15days' when {hours} <= 719 then '15-30days' when {hours} <= 2159 then "
            "'1-3months' else '3-6months' end")


_RECENCY = (
    ("last", "select site_id, unit_no, max(at_time) filter (event_code <> '20') as fired, "
             "max(at_time) filter (event_code = '20') as beat from sensor_signals join dictionary "
             "using (group_no, unit_no, event_code) where event_code in ('20', '40', '48', '58', "
             "'59') group by all"),
    ("recency", "select site_id, '01' as group_no, unit_no, case item_name "
                + " ".join(f"when '{old}' then '{new}'"
                           for old, new in sensors.RENAMED_SENSORS.items())
                + f" else item_name end as item_name, {_label('fired')} as trigger_label, "
                  f"{_label('beat')} as heartbeat_label from installed_items "
                  "left join last using (site_id, unit_no) where active"),
    ("matrix", "select bank, site_name, site_id, state, zone, " + ", ".join(
        f"max(trigger_label) filter (item_name = '{item}') as {name}"
        for item, name in COLUMNS.items())
     + " from sites left join recency using (site_id) group by all"))
_VIEWS = "sites installed_items sensor_signals dictionary"


def _recency(spark: SparkSession, sf: str) -> DataFrame:
    return sensors.sensor_recency(b.installed_items(spark, sf), b.sensor_signals(spark, sf),
                                  b.dictionary(spark, sf), SENSOR_ASOF)


def _matrix(spark: SparkSession, sf: str) -> DataFrame:
    return sensors.sensor_matrix(_recency(spark, sf), b.sites(spark, sf), COLUMNS, SENSOR_ASOF)


@query("sensor_recency", with_views(_VIEWS, "select * from recency", *_RECENCY))
def _(spark, sf):
    return _recency(spark, sf)


@query("sensor_matrix", with_views(
    _VIEWS, "select date '2024-02-13' as date, * from matrix", *_RECENCY))
def _(spark, sf):
    return _matrix(spark, sf)


@query("sensor_matrix_heartbeat", with_views(
    _VIEWS, "select date '2024-02-13' as date, bank, site_name, site_id, state, zone, "
    + ", ".join(f"max(heartbeat_label) filter (item_name = '{item}') as {name}"
                for item, name in COLUMNS.items())
    + " from sites left join recency using (site_id) group by all", *_RECENCY))
def _(spark, sf):
    return sensors.sensor_matrix(_recency(spark, sf), b.sites(spark, sf), COLUMNS, SENSOR_ASOF,
                                 "heartbeat")


def _scores(name: str) -> str:
    return (f"case {name} when '<15days' then 0 when '15-30days' then 2 when '1-3months' then 3 "
            f"when '3-6months' then 4 when 'Sensor Installed but No Trigger' then 5 end")


def _risk_check(weighted: bool, edges: list[float]) -> str:
    score = " + ".join(f"coalesce({_scores(c)}, 0)" for c in COLUMNS.values())
    problems = " + ".join(f"case when {c} is not null and {c} <> '<15days' then 1 else 0 end"
                          for c in COLUMNS.values())
    risk = f"({score}) * ({problems})" if weighted else f"({score})"
    bands = " ".join(f"when pct <= {e} then '{p}'" for e, p in zip(edges[1:], sensors.PRIORITIES))
    return with_views(_VIEWS, f"""
        select site_id, bank, cast(risk_score as bigint) as risk_score,
          case {bands} end as priority
        from (select *, {half_up("(rank() over (order by risk_score) + (count(*) over (partition "
                                 "by risk_score) - 1) / 2.0) / count(*) over ()", 2)} as pct
          from (select site_id, bank, {risk} as risk_score from matrix
                where site_id in (select user_id from events group by user_id
                                  having avg(value) <> 0)) where risk_score <> 0)""", *_RECENCY)


def _video_daily(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "events").select(
        F.col("user_id").alias("site_id"), F.to_date("ts").alias("date"),
        F.col("value").alias("site_availability"))


@query("sensor_priority", _risk_check(True, sensors.RANK_EDGES))
def _(spark, sf):
    risk = sensors.sensor_risk(_matrix(spark, sf), list(COLUMNS.values()),
                               _video_daily(spark, sf))
    return sensors.most_urgent_first(sensors.sensor_priority(risk)).select(
        "site_id", "bank", F.col("risk_score").cast("long").alias("risk_score"), "priority")


@query("sensor_priority_unweighted", _risk_check(False, sensors.LOW_RANK_EDGES))
def _(spark, sf):
    risk = sensors.sensor_risk(_matrix(spark, sf), list(COLUMNS.values()),
                               _video_daily(spark, sf), weighted=False)
    return sensors.sensor_priority(risk, sensors.LOW_RANK_EDGES).select(
        "site_id", "bank", F.col("risk_score").cast("long").alias("risk_score"), "priority")


def _pct(value: str) -> str:
    rank = (f"(rank() over (partition by {value} is null order by {value}) "
            f"+ (count(*) over (partition by {value}) - 1) / 2.0) / count({value}) over ()")
    return f"case when {value} is not null then {half_up(rank, 2)} end"


def _band(value: str, labels: str) -> str:
    marks = labels.split()
    arms = " ".join(f"when {value} <= {edge} then {mark}"
                    for edge, mark in zip((0.2, 0.4, 0.6, 0.8, 1), marks))
    return f"case {arms} end"


_FEATURES = (
    ("recent", "select event_id, site_id, unit_no as grp, msg, at_time, closed_on, closed_by, "
               f"closing_reason from tickets where at_time >= {ASOF_SQL} - interval 7 day and "
               f"at_time <= {ASOF_SQL}"),
    ("closures", f"select site_id, {minutes('closed_on', ASOF_SQL)} as since from recent where "
                 "closed_by is not null and closed_on is not null qualify row_number() over "
                 "(partition by site_id order by at_time desc, event_id desc) = 1"),
    ("visits", "select site_id, count(*) as visits, count(*) filter (hour(at_time) in (22, 23, 0, "
               "1, 2, 3, 4, 5)) as nights from (select distinct site_id, msg, at_time from recent "
               "where grp = '36') group by site_id"),
    ("ranked", f"select bank, site_name, site_id, {_pct('since')} as c, {_pct('v')} as f, "
               f"{_pct('n')} as m from (select bank, site_name, site_id, since, "
               "coalesce(visits, 0) as v, coalesce(nights, 0) as n from sites left join closures "
               "using (site_id) left join visits using (site_id))"),
    ("features", "select bank, site_name, site_id, case when site_id in (select site_id from "
                 "recent where grp = '32' and contains(lower(closing_reason), 'security')) "
                 "then 1 else 0 end as security, "
                 f"coalesce({_band('c', '5 4 3 2 1')}, 1) as manual_closure, "
                 f"{_band('f', '1 2 3 4 5')} as footfall, {_band('m', '1 2 3 4 5')} "
                 "as night_visit from ranked"))


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return priority.site_features(b.sites(spark, sf), b.visit_tickets(spark, sf), b.ASOF)


@query("site_features", with_views("sites tickets", "select * from features", *_FEATURES))
def _(spark, sf):
    return _features(spark, sf)


@query("site_priority", with_views("sites tickets", f"""
    select * exclude (score, pct), {_band('pct', "'S1' 'S2' 'S3' 'S4' 'S5'")} as site_priority
    from (select *, {half_up("(rank() over (order by score) + (count(*) over (partition by score) "
                             "- 1) / 2.0) / count(*) over ()", 2)} as pct
      from (select *, round(cbrt(manual_closure * footfall * night_visit) + security, 2) as score
            from features))""", *_FEATURES))
def _(spark, sf):
    return priority.site_priority(_features(spark, sf))


# ---- portfolio -------------------------------------------------------------------------------

def _share(columns: str, scale: float, digits: int) -> str:
    return with_views("sites", f"""
        select {columns}, count(*) as count,
          {half_up(f"count(*) * {scale} / (select count(*) from sites)", digits)} as percentage
        from (select zone as customer, bank as bank_name, zone as city,
                upper(state[1]) || lower(state[2:]) as state from sites) group by {columns}""")


for _name, _columns, _scale, _digits in (
        ("bank", "bank_name", 100.0, 2), ("state", "state", 100.0, 2),
        ("state_city", "state, city", 1.0, 4), ("customer_state", "customer, state", 1.0, 4)):
    def _portfolio(spark, sf, name=_name):
        return portfolio.portfolio_shares(b.portfolio(spark, sf))[name]

    query(f"portfolio_by_{_name}", _share(_columns, _scale, _digits))(_portfolio)


@query("portfolio_by_customer", with_views(
    "sites", "select zone as customer, count(*) as count from sites group by zone"))
def _(spark, sf):
    return portfolio.portfolio_shares(b.portfolio(spark, sf))["customer"]


@query("site_master", with_views("sites", "select bank, site_name, site_id from sites"))
def _(spark, sf):
    return portfolio.site_master(b.sites(spark, sf))
