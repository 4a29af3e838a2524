"""Ticket, service-level, availability, outage and penalty jobs on the sample tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse import bindings as b
from sitepulse import runs
from sitepulse.bindings import with_views
from sitepulse.catalog.registry import CHECKS, minutes, query
from sitepulse.functions import recode
from sitepulse.functions.time import SLOT_NAMES
from sitepulse.operators import union_all
from sitepulse.plans import (
    availability, footage, outages, penalties, recordings, repeats, rolling, sla, slots, tickets,
)
from sitepulse.session import shared_dir

ASOF_SQL = f"timestamp '{b.ASOF}'"
DAYS_SQL = f"generate_series(date '{b.FIRST_DAY}', date '{b.LAST_DAY}', interval 1 day)"
FIRST_SQL = f"timestamp '{b.FIRST_DAY}'"

# ---- service levels --------------------------------------------------------------------------

_RATED = (("acks", "select event_id, min(updated_on) as ack from remarks where tkt_status = 1 "
                   "group by event_id"),
          ("single", "select * exclude (ack_on) from tickets where event_type in ('SOS', "
                     "'Critical') and lower(closed_by) <> 'system' qualify row_number() over "
                     "(partition by site_id, msg, at_time order by event_id) = 1"),
          ("aged", "select single.*, ack as ack_on, cast(opened_on as date) as date, "
                   f"{minutes('opened_on', f'coalesce(closed_on, {ASOF_SQL})')} as age, "
                   f"{minutes('opened_on', 'ack')} as ack_age "
                   "from single left join acks using (event_id)"),
          ("rated", "select *, case when ack_on is null and age >= lim then event_type || "
                    "'NoAckVio' when ack_age >= lim then event_type || 'AckViolations' end "
                    "as ack_penalty, case when age >= close_lim then event_type || "
                    "'CloseViolations' end as close_penalty from (select *, case event_type "
                    "when 'SOS' then 5 else 10 end as lim, case event_type when 'SOS' then 30 "
                    "else 60 end as close_lim from aged)"))
_COUNTS = """count(*) filter (event_type = 'SOS') as total_sos,
  count(*) filter (event_type = 'Critical') as total_critical,
  count(*) filter (event_type = 'SOS' and ack_penalty is not null) as sos_ack,
  count(*) filter (event_type = 'SOS' and close_penalty is not null) as sos_close,
  count(*) filter (event_type = 'Critical' and ack_penalty is not null) as critical_ack,
  count(*) filter (event_type = 'Critical' and close_penalty is not null) as critical_close"""


def _rated(spark: SparkSession, sf: str) -> DataFrame:
    return sla.rated_tickets(b.tickets(spark, sf).drop("ack_on"), b.remarks(spark, sf), b.ASOF,
                             excluded=["nothing"])


@query("sla_daily_tickets", with_views("tickets remarks sites", """
    select date, bank, site_name, site_id, event_id, event_type, at_time, opened_on, ack_on,
      closed_on, coalesce(ack_penalty, '0') as ack_penalty, coalesce(close_penalty, '0')
      as close_penalty from rated join sites using (site_id)
    where ack_penalty is not null or close_penalty is not null""", *_RATED))
def _(spark, sf):
    return sla.violated_tickets(_rated(spark, sf), b.sites(spark, sf))


@query("sla_daily_site", with_views("tickets remarks sites", f"""
    select date, bank, site_name, site_id, coalesce(total_tickets, 0) as total_tickets,
      coalesce(total_sos, 0) as total_sos, coalesce(total_critical, 0) as total_critical,
      coalesce(sos_ack, 0) as sos_ack, coalesce(sos_close, 0) as sos_close,
      coalesce(critical_ack, 0) as critical_ack, coalesce(critical_close, 0) as critical_close
    from (select site_id, site_name, bank, cast(unnest({DAYS_SQL}) as date) as date from sites)
    left join (select date, site_id, count(*) as total_tickets, {_COUNTS} from rated
               group by date, site_id) using (date, site_id)""", *_RATED))
def _(spark, sf):
    return sla.site_violations(_rated(spark, sf), b.sites(spark, sf), b.FIRST_DAY, b.LAST_DAY)


@query("sla_daily_bank", with_views("tickets remarks sites", f"""
    select date, bank, count(*) as total_tickets, {_COUNTS}
    from rated join sites using (site_id) group by date, bank""", *_RATED))
def _(spark, sf):
    return sla.bank_violations(_rated(spark, sf), b.sites(spark, sf))


DAY = 1440
WIDE_LIMITS = sla.Limits(ack={"SOS": 3, "Critical": 6}, near_ack={"SOS": (0, 10 * DAY),
                         "Critical": (0, 12 * DAY)}, near_close={"SOS": (5 * DAY, 20 * DAY),
                                                                 "Critical": (6 * DAY, 25 * DAY)})
_OPEN = (("open_acks", "select event_id, min(updated_on) as ack from remarks where updated_on >= "
                  f"{ASOF_SQL} - interval 31 day group by event_id"),
         ("open_single", "select * exclude (ack_on) from tickets where event_type in ('SOS', "
                    "'Critical') and closed_on is null and at_time >= "
                    f"{ASOF_SQL} - interval 31 day qualify row_number() over "
                    "(partition by site_id, event_type, at_time order by event_id) = 1"),
         ("open_aged", "select event_id, event_type, msg, opened_on, site_id, site_name, bank, ack, "
                  f"round(floor((epoch_us({ASOF_SQL}) - epoch_us(opened_on)) / 1000000.0) / 60.0,"
                  " 2) as age_minutes, round(floor((epoch_us(ack) - epoch_us(opened_on)) / "
                  "1000000.0) / 60.0, 2) as ack_minutes from open_single left join open_acks "
                  "using (event_id) join sites using (site_id)"),
         ("due", "select *, case event_type when 'SOS' then age_minutes >= 0 and age_minutes < "
                 "14400 else age_minutes >= 0 and age_minutes < 17280 end as to_ack, case "
                 "event_type when 'SOS' then age_minutes >= 7200 and age_minutes < 28800 else "
                 "age_minutes >= 8640 and age_minutes < 36000 end as to_close, case event_type "
                 "when 'SOS' then ack_minutes > 3 else ack_minutes > 6 end as late_ack "
                 "from open_aged"),
         ("near", "select bank, site_name, site_id, event_id, event_type, msg, opened_on, "
                  "age_minutes, case when to_ack then 'TicketToAck' else 'TicketToClose' end "
                  "as required_action from due where to_ack or to_close"))


def open_due(spark: SparkSession, sf: str, *, acks: bool = False) -> DataFrame:
    return sla.open_tickets(b.tickets(spark, sf).drop("ack_on"),
                            b.remarks(spark, sf) if acks else None, b.sites(spark, sf), b.ASOF, WIDE_LIMITS, days=31,
                            excluded=["nothing"])


@query("sla_near_violation", with_views("tickets remarks sites", "select * from near", *_OPEN))
def _(spark, sf):
    return sla.near_violation(open_due(spark, sf))


@query("sla_class_summary", with_views("tickets remarks sites", """
    select bank, event_type, coalesce(total_tickets, 0) as total_tickets,
      coalesce(acknowledged, 0) as acknowledged, coalesce(not_acknowledged, 0)
      as not_acknowledged, coalesce(violated_ack, 0) as violated_ack,
      coalesce(near_ack, 0) as near_ack, coalesce(near_close, 0) as near_close
    from (select distinct bank, unnest(['Critical', 'SOS']) as event_type from sites)
    left join (select bank, event_type, count(*) as total_tickets, count(ack) as acknowledged,
      count(*) - count(ack) as not_acknowledged, count(*) filter (late_ack) as violated_ack,
      count(*) filter (to_ack) as near_ack, count(*) filter (to_close) as near_close
      from due group by all) using (bank, event_type)""", *_OPEN))
def _(spark, sf):
    return sla.class_summary(open_due(spark, sf, acks=True), b.sites(spark, sf))


# ---- penalties -------------------------------------------------------------------------------

def _penalty_check(tickets_where: str, remarks_where: str) -> str:
    return with_views("tickets remarks sites", f"""
        select distinct event_id, site_id, site_name, event_type, msg, opened_on, closed_on,
          updated_by, updated_on, lower(remarks) as remarks, age, ack_age,
          'Penalty Applicable' as penalty from (
          select *, {minutes('opened_on', 'closed_on')} as age,
            {minutes('opened_on', 'updated_on')} as ack_age
          from tickets join remarks using (event_id) join sites using (site_id)
          where active and (closed_by is null or lower(closed_by) <> 'system')
            and {tickets_where} and {remarks_where}
            and contains(lower(remarks), 'working') and not contains(lower(remarks), 'closed'))
        where (event_type = 'SOS' and (age > 30 or ack_age > 5))
          or (event_type = 'Critical' and (age > 60 or ack_age > 10))""")


@query("penalty_tickets", _penalty_check("true", "true"))
def _(spark, sf):
    return penalties.penalty_tickets(b.tickets(spark, sf).drop("ack_on"), b.remarks(spark, sf),
                                     b.sites(spark, sf))


@query("penalty_tickets_month", _penalty_check(
    "opened_on >= timestamp '2024-01-01' and opened_on < timestamp '2024-02-01'",
    "updated_on >= timestamp '2024-01-01' and updated_on < timestamp '2024-02-01'"))
def _(spark, sf):
    return penalties.penalty_tickets(b.tickets(spark, sf).drop("ack_on"), b.remarks(spark, sf),
                                     b.sites(spark, sf), "2024-01-01")


FEEDS = {"mcu": "1-URGENT", "equipment": "2-HIGH", "footage": "3-MEDIUM",
         "pm_q2": "4-NOT SPECIFIED", "pm_q3": "5-LOW"}
# Months that the consolidated report leaves out.
LEFT_OUT = (8, 9)


def _fed(spark: SparkSession, sf: str) -> DataFrame:
    """All feeds in one table, read once; ``consolidate`` takes separate feeds."""
    return b.penalties(spark, sf).withColumn("feed", recode(
        F.col("item"), {item: name for name, item in FEEDS.items()}, keep_unmapped=False))


@query("penalty_consolidation", with_views("penalties", """
    select site, case month when 4 then 'Apr' when 5 then 'May' when 6 then 'June' when 7 then
      'July' else cast(month as varchar) end as month, """ + ", ".join(
    f"round(coalesce(sum(amount) filter (item = '{i}'), 0), 2) as {n}"
    for n, i in FEEDS.items()) + """, round(sum(amount), 2) as total
    from penalties where month not in (8, 9) group by site, penalties.month
    """))
def _(spark, sf):
    out = penalties.month_names(penalties.consolidate_rows(_fed(spark, sf), list(FEEDS),
                                                           drop_months=LEFT_OUT))
    return out.withColumns({c: F.round(c, 2) for c in [*FEEDS, "total"]})


@query("penalty_ranking", with_views("penalties", """
    select site, month, round(sum(amount), 2) as total from penalties
      where month not in (8, 9) group by site, month"""))
def _(spark, sf):
    total = penalties.consolidate_rows(_fed(spark, sf), list(FEEDS), drop_months=LEFT_OUT)
    return total.select("site", "month", F.round("total", 2).alias("total")).orderBy(
        F.desc("total"), "site", "month")


@query("penalty_matrix", with_views("penalties", """
    select site, month, """ + ", ".join(
    f"round(coalesce(sum(amount) filter (item = '{i}'), 0), 2) as {n}"
    for n, i in FEEDS.items()) + """, round(coalesce(sum(amount), 0), 2)
      as total from penalties group by site, month"""))
def _(spark, sf):
    out = penalties.item_matrix(b.penalties(spark, sf), {i: n for n, i in FEEDS.items()})
    return out.withColumns({c: F.round(c, 2) for c in [*FEEDS.keys(), "total"]})


_BANDS = [("<100", 99), ("100-200", 199), ("200-500", 499), ("500-1000", 999),
          ("1000-2000", 1999), ("2000-3000", 2999), ("3000-5000", 4999), ("5000-10000", 9999),
          ("10000-20000", 19999), (">20000", float("inf"))]


@query("penalty_trend", with_views("penalties", f"""
    select site, round("Apr", 2) as "Apr", round("May", 2) as "May", round("June", 2) as "June",
      round("July", 2) as "July", round(total, 2) as total, round(mean, 2) as mean, std, cv,
      slope, case when mean <= 0 then null {' '.join(
          f"when mean <= '{top}'::double then '{label}'" for label, top in _BANDS)} end as bucket,
      case when cv <= -1 then null when cv <= 0.05 then 'Very Regular' when cv <= 0.5 then
        'Regular' when cv <= 1 then 'Tolerant' when cv <= 1.5 then 'Irregular' when cv <= 2 then
        'Very Irregular' end as regularity,
      case when cv between -0.05 and 0.05 then 'Stable'
        when cv >= -0.5 and cv < 0.5 and slope > 0 then 'Increasing'
        when cv >= -0.5 and cv < 0.5 and slope < 0 then 'Decreasing'
        when slope > 0 then 'Agg Increasing' when slope < 0 then 'Agg Decreasing' end as trend
    from (select *, {b.half_up('std / mean', 2)} as cv from (
      select site, "Apr", "May", "June", "July", total, total / 4 as mean,
        round(sqrt((power("Apr" - total / 4, 2) + power("May" - total / 4, 2)
          + power("June" - total / 4, 2) + power("July" - total / 4, 2)) / 4), 2) as std,
        round((-1.5 * "Apr" - 0.5 * "May" + 0.5 * "June" + 1.5 * "July") / 5, 2) as slope
      from (select *, "Apr" + "May" + "June" + "July" as total from (
        select site, {', '.join(
            f"coalesce(sum(case when o_orderstatus = 'P' then 0.0 else amount end) "
            f"filter (month = {m}), 0) as " + chr(34) + n + chr(34)
            for m, n in penalties.TREND_MONTHS.items())}
        from penalties where month between 4 and 7 group by site)) where total <> 0))"""))
def _(spark, sf):
    out = penalties.penalty_trend(b.penalty_texts(spark, sf))
    return out.withColumns({c: F.round(c, 2) for c in
                            [*penalties.TREND_MONTHS.values(), "total", "mean"]})


# ---- counts per slot -------------------------------------------------------------------------

_SLOT_CASE = ("case when hour({0}) <= 3 then '12AM~4AM' when hour({0}) <= 7 then '4AM~8AM' "
              "when hour({0}) <= 11 then '8AM~12PM' when hour({0}) <= 15 then '12PM~4PM' "
              "when hour({0}) <= 19 then '4PM~8PM' else '8PM~12AM' end")


def _slot_check(events: str, at: str, installed: str) -> str:
    cells = ", ".join(f"coalesce(count(slot) filter (slot = '{s}'), 0) as \"{s}\""
                      for s in SLOT_NAMES)
    return with_views("tickets sites installed_items", f"""
        select date, bank, site_name, site_id, {cells} from (
          select site_id, site_name, bank, cast(unnest({DAYS_SQL}) as date) as date from sites
          where site_id in (select site_id from installed_items where active {installed}))
        left join (select site_id, cast({at} as date) as date, {_SLOT_CASE.format(at)} as slot
                   from ({events})) using (date, site_id) group by all""")


@query("slot_counts_motion", _slot_check(
    "select distinct site_id, msg, opened_on from tickets where unit_no = '36'", "opened_on",
    "and unit_no = '36'"))
def _(spark, sf):
    return slots.slot_counts(slots.motion_events(b.tickets(spark, sf)), "opened_on",
                             b.sites(spark, sf), slots.installed_sites(
                                 b.installed_items(spark, sf), slots.MOTION_UNIT),
                             b.FIRST_DAY, b.LAST_DAY)


@query("slot_counts_door", _slot_check(
    "select distinct site_id, at_time from tickets where unit_no = '33' and event_code = '40'",
    "at_time", "and unit_no = '33'"))
def _(spark, sf):
    return slots.slot_counts(slots.door_events(b.tickets(spark, sf)), "at_time",
                             b.sites(spark, sf), slots.installed_sites(
                                 b.installed_items(spark, sf), slots.DOOR_UNIT),
                             b.FIRST_DAY, b.LAST_DAY)


@query("slot_counts_critical", _slot_check(
    "select distinct site_id, unit_no, msg, at_time, opened_on from tickets where unit_no <> "
    "'33' and closed_on is not null and lower(closed_by) <> 'system'", "opened_on", ""))
def _(spark, sf):
    return slots.slot_counts(slots.critical_sensor_events(b.tickets(spark, sf)), "opened_on",
                             b.sites(spark, sf),
                             slots.installed_sites(b.installed_items(spark, sf)),
                             b.FIRST_DAY, b.LAST_DAY)


# ---- availability ----------------------------------------------------------------------------

_SEEN = ("seen", "select site_id, max(received) as seen from heartbeats group by site_id")


def _live(touching: str, high: str) -> tuple[str, str]:
    return ("live", f"""select e.* from (select * from episodes where {touching}
        qualify row_number() over (partition by site_id, event_type, at_time
                                   order by event_id) = 1) e left join seen using (site_id)
        where not (closed_on is null and (at_time >= {high} or coalesce(opened_on < seen,
        false)))""")


@query("stale_open_episodes", with_views("episodes heartbeats", """
    select event_id, site_id, opened_on from episodes join seen using (site_id)
    where closed_on is null and opened_on < seen""", _SEEN))
def _(spark, sf):
    return availability.reported_alive(b.episodes(spark, sf), b.heartbeats(spark, sf)).select(
        "event_id", "site_id", "opened_on")


@query("site_online_pct", with_views("episodes heartbeats sites", f"""
    select bank, site_name, site_id, round(100.0 - round(coalesce(down, 0) * 100.0 / 43200, 2), 2)
      as online_pct from sites left join (select site_id, sum({minutes(
          f"greatest({FIRST_SQL}, least(at_time, {ASOF_SQL}))",
          f"greatest({FIRST_SQL}, least(coalesce(closed_on, {ASOF_SQL}), {ASOF_SQL}))")})
      as down from live group by site_id) using (site_id)""", _SEEN, _live(
          f"(closed_on between {FIRST_SQL} and {ASOF_SQL} and opened_on < {ASOF_SQL}) "
          "or closed_on is null", ASOF_SQL)))
def _(spark, sf):
    return availability.site_online_pct(b.sites(spark, sf), b.episodes(spark, sf),
                                        b.heartbeats(spark, sf), b.ASOF)


_VIDEO_COLUMNS = {"BackroomCamera": "backroom", "LobbyCamera": "lobby",
                  "OutdoorCamera": "outdoor", "PinholeCamera": "pinhole"}
_PIECE = minutes("greatest(a, day)", "least(z, day + interval 1 day)")


@query("video_availability_daily", with_views(
    "episodes heartbeats sites cameras recordings", f"""
    select date, bank, site_name, site_id, box_id, backroom, lobby, outdoor, pinhole, video_pct,
      site_pct, case when gap >= 50 or (gap >= 20 and spread <= 20) then
        'Site Level Video Recording Issue' when gap < 20 then 'No Issue'
        when gap >= 20 then worst || ' Issue' end as remark
    from (select *, round(site_pct - video_pct, 2) as gap from (
      select wide.*, site_id, site_name, bank, round(100.0 - coalesce(offline_pct, 0), 2)
        as site_pct from wide join sites using (box_id)
        left join offline using (site_id, date)))""",
    _SEEN, _live(f"opened_on < {ASOF_SQL} and (closed_on is null or closed_on >= {FIRST_SQL})",
                 ASOF_SQL),
    ("pieces", f"""select site_id, a, z, unnest(generate_series(date_trunc('day', a),
        date_trunc('day', least(z, timestamp '{b.LAST_DAY}')), interval 1 day)) as day
        from (select site_id, greatest(at_time, {FIRST_SQL}) as a,
                least(coalesce(closed_on, {ASOF_SQL}), {ASOF_SQL}) as z from live)"""),
    ("offline", f"select site_id, cast(day as date) as date, round(sum(round({_PIECE} * 100.0 "
                "/ 1440, 2)), 2) as offline_pct from pieces group by all"),
    ("named", "select distinct box_id, camera_id, replace(camera_name, ' ', '') as camera "
              "from cameras where active"),
    ("firsts", "select box_id, camera, cast(at_time as date) as date, coalesce(file_count, 0) + "
               "coalesce(remote_file_count, 0) as files from recordings join named "
               "using (box_id, camera_id) qualify row_number() over (partition by box_id, camera, "
               "cast(at_time as date) order by at_time, file_count, remote_file_count, "
               "camera_id) = 1"),
    ("shares", f"""select box_id, date, camera, least(greatest(round(coalesce(files, 0)
        * 100.0 / 1000, 2), 0), 100) as share from (select distinct box_id, camera,
          cast(unnest({DAYS_SQL}) as date) as date from named)
        left join firsts using (box_id, camera, date)"""),
    ("wide", "select box_id, date, " + ", ".join(
        f"max(share) filter (camera = '{c}') as {n}" for c, n in _VIDEO_COLUMNS.items())
     + f", {b.half_up('sum(cast(share as decimal(9, 2))) / count(*)', 2)} as video_pct, max(share) - min(share) as spread, "
       "arg_min(camera, (share, camera)) as worst from shares group by all")))
def _(spark, sf):
    return availability.video_availability(
        b.sites(spark, sf), b.cameras(spark, sf), b.recordings(spark, sf), b.episodes(spark, sf),
        b.heartbeats(spark, sf), b.FIRST_DAY, b.LAST_DAY, _VIDEO_COLUMNS)


# ---- recordings ------------------------------------------------------------------------------

_VOD = (("best", "select box_id, camera_id, cast(at_time as date) as date, file_count + "
                 "coalesce(remote_file_count, 0) as files from recordings qualify row_number() "
                 "over (partition by box_id, camera_id, cast(at_time as date) order by "
                 "file_count desc, at_time desc, remote_file_count desc nulls last) = 1"),
        ("totals", "select box_id, date, case camera_id when '0702R' then '0702' else camera_id "
                   "end as camera_id, sum(files) as files from best group by all"),
        ("matrix", "select box_id, date, " + ", ".join(
            f"avg(coalesce(files, 0)) filter (camera_name = '{c}') as {n}"
            for c, n in recordings.CAMERA_COLUMNS.items())
         + f" from (select box_id, camera_id, camera_name, cast(unnest({DAYS_SQL}) as date) "
           "as date from cameras where active) left join totals using (box_id, camera_id, date) "
           "group by all"),
        ("daily", "select date, bank, site_name, site_id, box_id, " + ", ".join(
            f"case when {c} >= 400 then 'YES' when {c} >= 1 then 'PR' when {c} = 0 then 'NO' end "
            f"as {c}_label" for c in recordings.CAMERA_COLUMNS.values())
         + ", coalesce(backroom, 0) + coalesce(lobby, 0) + coalesce(outdoor, 0) "
           "+ coalesce(pinhole, 0) as total from matrix join sites using (box_id)"),
        ("labelled", "select date, bank, site_name, site_id, box_id, backroom_label as backroom, "
                     "lobby_label as lobby, outdoor_label as outdoor, pinhole_label as pinhole, "
                     "case when total = 0 then 'NO' else lobby_label end as status from daily"))
VOD_FULL = 400


def _matrix(spark: SparkSession, sf: str) -> DataFrame:
    return recordings.camera_matrix(b.cameras(spark, sf),
                                    recordings.daily_totals(b.recordings(spark, sf)),
                                    b.FIRST_DAY, b.LAST_DAY)


def _vod(spark: SparkSession, sf: str) -> DataFrame:
    return recordings.vod_daily(b.sites(spark, sf), _matrix(spark, sf), full=VOD_FULL)


@query("vod_daily", with_views("sites cameras recordings", "select * from labelled", *_VOD))
def _(spark, sf):
    return _vod(spark, sf)


@query("vod_summary", with_views("sites cameras recordings", """
    select date, bank, count(*) as total_sites, count(*) filter (status = 'YES') as "full",
      count(*) filter (status = 'PR') as partial, count(*) filter (status in ('YES', 'PR'))
      as received, count(*) filter (status = 'NO') as zero from labelled group by all""", *_VOD))
def _(spark, sf):
    return recordings.vod_summary(_vod(spark, sf))


@query("vod_counts", with_views("sites cameras recordings", """
    select date, bank, site_name, site_id, box_id, backroom, lobby, outdoor, pinhole,
      least(greatest(round(lobby * 100.0 / 400, 2), 0), 100) as lobby_pct
    from sites left join matrix using (box_id)""", *_VOD))
def _(spark, sf):
    return recordings.vod_counts(b.sites(spark, sf), _matrix(spark, sf), full=VOD_FULL)


_REPORT_DATES = {f"2024-01-{d:02d}": f"d{d:02d}" for d in range(1, 31)}


for _sheet in ("lobby", "outdoor", "backroom", "pinhole"):
    def _vod_sheet(spark, sf, sheet=_sheet):
        return recordings.vod_matrix(_vod(spark, sf), sheet, _REPORT_DATES)

    query(f"vod_report_{_sheet}", with_views(
        "sites cameras recordings", "select site_id, " + ", ".join(
            f"string_agg(coalesce({_sheet}, '0'), ' ') filter (date = date '{d}') as {n}"
            for d, n in _REPORT_DATES.items()) + " from labelled group by site_id",
        *_VOD))(_vod_sheet)


# ---- footage ---------------------------------------------------------------------------------

def _span(table: str, start: str, open_covers: bool, more: str = "") -> str:
    reach = "s.closed_on >= q.asked_at" + (" or s.closed_on is null" if open_covers else "")
    return (f"exists (select 1 from {table} s where s.site_id = q.site_id "
            f"and s.{start} <= q.asked_at and ({reach}) {more})")


def _footage_check(open_covers: bool) -> str:
    return with_views("tickets episodes recordings fault_tickets", f"""
        select ticket_id, site_id, asked_at, coalesce(availability, 0.0) as availability,
          case when coalesce(availability, 0) > 99 then 'Available' when offline or camera then
            'Not Available' when availability > 1 then 'Available' else 'Not Available' end
            as video_status,
          case when coalesce(availability, 0) > 99 then null when offline then 'Offline'
            when camera then 'Camera Issue' when disk then 'HDD Issue' when availability > 1 then
            'No HDD Issue' else 'Online - No HDD Issue' end as reason,
          case when site_id in (select site_id from episodes where closed_on is null)
            then 'Offline' else 'Online' end as current_status
        from (select *, {_span('episodes', 'at_time', open_covers)} as offline,
            {_span('fault_tickets', 'opened_on', open_covers, "and s.camera_id = '0702'")}
              as camera,
            {_span('fault_tickets', 'opened_on', open_covers, "and s.error = 'EIO'")} as disk
          from (select event_id as ticket_id, site_id, site_id as box_id,
                  at_time + to_minutes(90) as asked_at from tickets) q)
        left join (select box_id, date, least(greatest(round(sum(files) * 100.0 / 1000, 2), 0),
            100) as availability from (select box_id, cast(at_time as date) as date, file_count
              + coalesce(remote_file_count, 0) as files from recordings
              where camera_id in ('0702', '0702R') qualify row_number() over (partition by
                box_id, camera_id, cast(at_time as date) order by at_time desc, file_count desc,
                remote_file_count desc nulls last) = 1) group by box_id, date) v
          on v.box_id = site_id and v.date = cast(asked_at as date)""")


def _footage(spark: SparkSession, sf: str, open_covers: bool) -> DataFrame:
    faults = b.fault_tickets(spark, sf)
    asked = b.tickets(spark, sf).select(
        F.col("event_id").alias("ticket_id"), "site_id", F.col("site_id").alias("box_id"),
        (F.col("at_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(90))).alias("asked_at"))
    return footage.footage_status(asked, footage.lobby_availability(b.recordings(spark, sf)),
                                  b.episodes(spark, sf), faults, faults.filter("error = 'EIO'"),
                                  open_covers=open_covers)


@query("footage_status", _footage_check(True))
def _(spark, sf):
    return _footage(spark, sf, True)


@query("footage_status_closed_only", _footage_check(False))
def _(spark, sf):
    """Tickets and episodes without an end explain nothing."""
    return _footage(spark, sf, False)


# ---- outages ---------------------------------------------------------------------------------

# All event types count as outages here, and limits are low: sample times are random.
LOW = outages.Thresholds(pattern=(1, 1, 2), total=(5, 13, 33), night=(1, 1, 1))
# With these some sites show a pattern and some do not.
SOME = outages.Thresholds(pattern=(2, 3, 5), total=(5, 13, 33), night=(1, 1, 1))


def _pattern(remark: str, unit: str, off: str, on: str, by: str, least: tuple) -> str:
    off_key, on_key = off or "null", on or "null"
    horizon = "at_time" if by == "off" else "closed_on"
    return f"""select site_id, '{remark}' as remark, '{unit}' as unit,
      cast({off_key} as varchar) as o, cast({on_key} as varchar) as n,
      count(*) filter ({horizon} >= timestamp '2024-01-28') as c3,
      count(*) filter ({horizon} >= timestamp '2024-01-24') as c7, count(*) as c15
      from base group by site_id, {off_key}, {on_key}
      having c3 >= {least[0]} and c7 >= {least[1]} and c15 >= {least[2]}"""


_TO = "strftime(at_time, '%H:%M')"
_TN = "strftime(closed_on, '%H:%M')"
_HO = "strftime(at_time, '%H')"
_HN = "strftime(closed_on, '%H')"
def _patterns(limits: outages.Thresholds) -> tuple:
    return (
        ("base", f"""select * from tickets where at_time between timestamp '2024-01-16' and {ASOF_SQL}
            and closed_on < {ASOF_SQL} qualify row_number() over (partition by site_id, msg, at_time
            order by event_id) = 1"""),
        ("mp", _pattern("Offline-Online", "minute", _TO, _TN, "off", limits.pattern)),
        ("hp", _pattern("Offline-Online", "hour", _HO, _HN, "off", limits.pattern)),
        ("mf", _pattern("Offline", "minute", _TO, "", "off", limits.pattern)
         + " and (site_id, o) not in (select site_id, o from mp)"),
        ("mn", _pattern("Online", "minute", "", _TN, "on", limits.pattern)
         + " and (site_id, n) not in (select site_id, n from mp)"),
        ("hf0", _pattern("Offline", "hour", _HO, "", "off", limits.pattern)
         + " and (site_id, o) not in (select site_id, o from hp)"),
        ("hn0", _pattern("Online", "hour", "", _HN, "on", limits.pattern)
         + " and (site_id, n) not in (select site_id, n from hp)"),
        ("hf", "select * from hf0 where (site_id, o) not in (select site_id, o[1:2] from mf)"),
        ("hn", "select * from hn0 where (site_id, n) not in (select site_id, n[1:2] from mn)"),
        ("hp1", "select * from hp where (site_id, o, n) not in "
                "(select site_id, o[1:2], n[1:2] from mp)"),
        ("busy", f"""select site_id, count(*) filter (at_time >= timestamp '2024-01-28') as c3,
            count(*) filter (at_time >= timestamp '2024-01-24') as c7, count(*) as c15 from base
            group by site_id having c3 >= {limits.total[0]} and c7 >= {limits.total[1]}
            and c15 >= {limits.total[2]}"""),
        ("found", """select * from (select * from mp union all select * from hp1
            union all select * from mf where site_id not in (select site_id from hp1)
            union all select * from mn where site_id not in (select site_id from hp1)
            union all select * from hf where site_id not in (select site_id from mp)
            union all select * from hn where site_id not in (select site_id from mp))
            where site_id not in (select site_id from busy)"""))


_PATTERNS = _patterns(LOW)


def _outage_base(spark: SparkSession, sf: str) -> DataFrame:
    return outages.outage_base(b.tickets(spark, sf), b.ASOF)


@query("outage_patterns", with_views("tickets sites", """
    select date '2024-01-31' as date, bank, site_name, site_id, o as time_offline,
      n as time_online, c3 as count_3days, c7 as count_7days, c15 as count_15days, remark
    from found join sites using (site_id)""", *_PATTERNS))
def _(spark, sf):
    patterns = outages.all_patterns(_outage_base(spark, sf), b.ASOF, LOW)
    return outages.recurring_patterns(patterns, b.sites(spark, sf), b.ASOF)


@query("outage_frequent_sites", with_views("tickets sites", """
    select date '2024-01-31' as date, bank, site_name, site_id, c3 as count_3days,
      c7 as count_7days, c15 as count_15days, 'TotalTickets' as remark
    from busy join sites using (site_id)""", *_PATTERNS))
def _(spark, sf):
    patterns = outages.all_patterns(_outage_base(spark, sf), b.ASOF, LOW)
    return outages.frequent_sites(patterns, b.sites(spark, sf), b.ASOF)


@query("outage_patterns_kept", CHECKS["outage_patterns"])
def _(spark, sf):
    """The same report from the kept clock table: loaded once, then two more days added."""
    store = runs.Store(spark, f"{shared_dir(spark)}/sitepulse-{uuid.uuid4().hex}")
    b.tickets(spark, sf).write.parquet(store.path("tickets"))
    kinds = list(b.UNITS)
    runs.outage_load(store, "2024-01-02", "2024-01-29", kinds)
    for day in ("2024-01-30", "2024-01-31"):
        runs.outage_add_day(store, day, kinds)
    changes = runs._clock_changes(store).read()
    patterns = outages.patterns_of(outages.kept_clock(changes, b.ASOF), LOW)
    return outages.recurring_patterns(patterns, b.sites(spark, sf), b.ASOF)


def _night_check(least: tuple[int, int, int], where: str) -> str:
    return with_views("tickets sites", f"""
        select date '2024-01-31' as date, bank, site_name, site_id, c3 as count_3days,
          c7 as count_7days, c15 as count_15days, 'Business hour sites' as remark
        from (select site_id, count(*) filter (at_time >= timestamp '2024-01-28') as c3,
            count(*) filter (at_time >= timestamp '2024-01-24') as c7, count(*) as c15
          from (select *, strftime(at_time, '%H') as ho, strftime(closed_on + to_hours(9), '%H')
                  as hn from base)
          where ho in ('16', '17', '18', '19', '20', '21', '22', '23', '24', '01')
            and hn in ('06', '07', '08', '09', '10') group by site_id
          having c3 >= {least[0]} and c7 >= {least[1]} and c15 >= {least[2]})
        join sites using (site_id) where {where}
          and site_id not in (select site_id from found)
          and site_id not in (select site_id from busy)""", *_patterns(SOME))


def _night(spark: SparkSession, sf: str, least: tuple[int, int, int], **options) -> DataFrame:
    """Sample outages are short, so the end is moved by nine hours to reach the morning."""
    base = _outage_base(spark, sf)
    shown = outages.all_patterns(base, b.ASOF, SOME)
    moved = base.withColumn("closed_on", F.col("closed_on") + F.make_dt_interval(
        F.lit(0), F.lit(9)))
    return outages.business_hour_outages(moved, shown, b.sites(spark, sf), b.ASOF, least, **options)


@query("business_hour_outages", _night_check(LOW.night, "on_site = 1"))
def _(spark, sf):
    return _night(spark, sf, LOW.night)


@query("business_hour_outages_any_site", _night_check((0, 1, 2), "true"))
def _(spark, sf):
    return _night(spark, sf, (0, 1, 2), on_site_only=False)


# ---- repeated faults -------------------------------------------------------------------------

@query("repeated_camera_faults", with_views("fault_tickets", f"""
    select date '2024-01-31' as date, bank, site_name, count(*) as count_7days,
      camera_name as remark from fault_tickets
    where opened_on >= {ASOF_SQL} - interval 7 day group by bank, site_name, camera_name
    having count(*) >= 3"""))
def _(spark, sf):
    return repeats.repeated_camera_faults(b.fault_tickets(spark, sf), b.ASOF)


@query("repeated_camera_faults_counted", CHECKS["repeated_camera_faults"])
def _(spark, sf):
    """The weekly list from daily counters, far fewer of them than there are keys."""
    faults = b.fault_tickets(spark, sf)
    day = F.to_date("opened_on")
    daily = rolling.daily_counters(faults.filter(day >= F.lit("2024-01-24").cast("date")), day,
                                   rolling.camera_keys(faults), 512)
    return rolling.repeated_camera_faults(faults, daily, b.ASOF, counters=512)


@query("repeated_disk_faults", with_views("fault_tickets", f"""
    select date '2024-01-31' as date, bank, site_name, case when e = a and e >= 3 then 'ENOENT'
      when d = a and d >= 3 then 'ENODR' when e + d >= 3 then 'ENOENT+ENODR' else 'Others' end
      as remark, case when e = a and e >= 3 then e when d = a and d >= 3 then d
      when e + d >= 3 then e + d else a end as count_7days
    from (select bank, site_name, count(*) filter (error = 'ENOENT') as e,
        count(*) filter (error = 'ENODR') as d, count(error) as a from fault_tickets
      where opened_on >= {ASOF_SQL} - interval 7 day group by bank, site_name) where a >= 3"""))
def _(spark, sf):
    return repeats.repeated_disk_faults(b.fault_tickets(spark, sf), b.ASOF)


# ---- ticket lifecycle ------------------------------------------------------------------------

def _open_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Stands for the stored table of open tickets."""
    return b.fault_tickets(spark, sf).filter("closed_on is null")


_DISK = (("open", "select * from fault_tickets where closed_on is null"),
         ("latest", "select * from disk_status qualify row_number() over (partition by box_id "
                    "order by at_time desc, error desc) = 1"),
         ("ok", "select box_id from latest where hdd = '1'"),
         ("remote", "select box_id, max(at_time) as seen from recorder_signals "
                    "where event_code = 'REMOTERECORD' and box_id in (select box_id from open) "
                    "group by box_id"),
         ("older", "select ticket_id, box_id from open qualify row_number() over (partition by "
                   "box_id order by opened_on desc, ticket_id desc) > 1"),
         ("closing", "select ticket_id, box_id from open where box_id in (select box_id from ok) "
                     "union select ticket_id, box_id from older"))
_DISK_VIEWS = "sites disk_status recorder_signals fault_tickets"


def _disk(spark: SparkSession, sf: str, close_on: str) -> tickets.Changes:
    return tickets.disk_tickets(b.sites(spark, sf), b.disk_status(spark, sf),
                                b.recorder_signals(spark, sf), _open_faults(spark, sf),
                                close_on=close_on)


@query("disk_tickets_new", with_views(_DISK_VIEWS, """
    select site_id, box_id, error, opened_on, bank, site_name, seen as latest_remote_recording
    from (select l.site_id, l.box_id, l.error, l.at_time as opened_on from latest l where
      hdd = '0' and not exists (select 1 from open o where o.box_id = l.box_id
        and o.error is not distinct from l.error)) join sites using (site_id, box_id)
    left join remote using (box_id)""", *_DISK))
def _(spark, sf):
    return _disk(spark, sf, "box").opened.select(
        "site_id", "box_id", "error", "opened_on", "bank", "site_name", "latest_remote_recording")


@query("disk_tickets_closed", with_views(_DISK_VIEWS, "select ticket_id from closing", *_DISK))
def _(spark, sf):
    return _disk(spark, sf, "box").closed


@query("disk_tickets_touched", with_views(_DISK_VIEWS, """
    select ticket_id, seen as latest_remote_recording from open join remote using (box_id)
    where box_id not in (select box_id from ok) and box_id not in (select box_id from closing)
    """, *_DISK))
def _(spark, sf):
    return _disk(spark, sf, "box").touched


@query("disk_tickets_close_variants", with_views(_DISK_VIEWS, """
    select 'same error' as rule, ticket_id from open o where exists (select 1 from latest l
      where hdd = '1' and l.box_id = o.box_id and l.error is not distinct from o.error)
    union all select 'no fault', ticket_id from open where box_id not in (
      select box_id from latest where hdd = '0')""", *_DISK))
def _(spark, sf):
    return union_all([
        _disk(spark, sf, how).closed.select(F.lit(rule).alias("rule"), "ticket_id")
        for rule, how in (("same error", "box_error"), ("no fault", "absence"))])


_LAG = (("open", "select * from fault_tickets where closed_on is null"),
        ("last", "select box_id, device_id as camera_id, max(at_time) as opened_on from "
                 "recorder_signals where event_code = 'RECORD' group by all"),
        ("known", "select box_id, camera_id, camera_name, opened_on, max(opened_on) over "
                  "(partition by box_id) as newest from cameras join last using (box_id, "
                  "camera_id) where active"),
        ("faulty", f"select * from known where {minutes('opened_on', 'newest')} >= 60"))


@query("camera_lag_tickets", with_views("sites cameras recorder_signals fault_tickets", """
    select 'new' as change, box_id, camera_id, opened_on, cast(null as bigint) as ticket_id
    from faulty where (box_id, camera_id) not in (select box_id, camera_id from open)
    union all select 'closed', null, null, null, ticket_id from open
    where (box_id, camera_id) not in (select box_id, camera_id from faulty)""", *_LAG))
def _(spark, sf):
    change = tickets.camera_lag_tickets(b.sites(spark, sf), b.cameras(spark, sf),
                                        b.recorder_signals(spark, sf), _open_faults(spark, sf))
    return _both(change, "box_id", "camera_id", "opened_on")


def _both(change: tickets.Changes, *columns: str) -> DataFrame:
    return union_all([
        change.opened.select(F.lit("new").alias("change"), *columns),
        change.closed.select(F.lit("closed").alias("change"), "ticket_id")])


_ABSENT = (("open", "select * from fault_tickets where closed_on is null"),
           ("seen", "select distinct box_id, device_id as camera_id from recorder_signals where "
                    f"event_code = 'RECORD' and at_time >= {ASOF_SQL} - interval 2880 minute"))


@query("camera_absent_tickets", with_views("sites cameras recorder_signals fault_tickets", f"""
    select 'new' as change, box_id, camera_id, camera_name, {ASOF_SQL} as opened_on,
      cast(null as bigint) as ticket_id from cameras where active
      and box_id in (select box_id from seen)
      and (box_id, camera_id) not in (select box_id, camera_id from seen)
      and (box_id, camera_id, camera_name) not in (select box_id, camera_id, camera_name
        from open)
    union all select 'closed', null, null, null, null, ticket_id from open
    where (box_id, camera_id) in (select box_id, camera_id from seen)""", *_ABSENT))
def _(spark, sf):
    change = tickets.camera_absent_tickets(
        b.sites(spark, sf), b.cameras(spark, sf), b.recorder_signals(spark, sf),
        _open_faults(spark, sf), b.ASOF, minutes=2880)
    return _both(change, "box_id", "camera_id", "camera_name", "opened_on")


def _lobby_check(works: str, fails: str) -> str:
    return with_views("sites recorder_signals fault_tickets", f"""
        select 'new' as change, site_id, camera_id, opened_on, cast(null as bigint) as ticket_id
        from aged where ({fails}) and site_name not in (select site_name from open)
        union all select 'closed', null, null, null, ticket_id from open
        where site_name in (select site_name from aged where {works})""",
        ("open", "select * from fault_tickets where closed_on is null and camera_id = '0702'"),
        ("aged", "select site_id, site_name, device_id as camera_id, status, at_time as "
                 f"opened_on, {minutes('at_time', ASOF_SQL)} as age from (select * from "
                 "recorder_signals where device_id in ('0702', '0702R') qualify row_number() "
                 "over (partition by box_id order by at_time desc, device_id desc) = 1) "
                 "join sites using (box_id)"))


def _lobby(spark: SparkSession, sf: str, use_status: bool) -> DataFrame:
    open_ = _open_faults(spark, sf).filter("camera_id = '0702'")
    change = tickets.lobby_stale_tickets(b.sites(spark, sf), b.recorder_signals(spark, sf), open_,
                                         b.ASOF, minutes=1440, use_status=use_status)
    return _both(change, "site_id", "camera_id", "opened_on")


@query("lobby_stale_tickets", _lobby_check("age < 1440", "age > 1440"))
def _(spark, sf):
    return _lobby(spark, sf, False)


@query("lobby_status_tickets", _lobby_check(
    "age < 1440 and status = '1'", "age > 1440 or (age < 1440 and status = '-1')"))
def _(spark, sf):
    return _lobby(spark, sf, True)


@query("ticket_day_report", with_views("fault_tickets", """
    select ticket_id, bank, site_name, opened_on, closed_on from fault_tickets
    where opened_on < timestamp '2024-01-16' and (closed_on >= timestamp '2024-01-15'
      or closed_on is null)"""))
def _(spark, sf):
    return tickets.ticket_day_report(b.fault_tickets(spark, sf), "2024-01-15")
