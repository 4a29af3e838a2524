"""The streams, run over the sample events until everything available is processed.

The SQL twin leaves out windows and sessions that end after the last watermark: those are not
written before later data arrives.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse import bindings as b
from sitepulse import streaming as st
from sitepulse.bindings import with_views
from sitepulse.catalog.jobs import _OPEN, WIDE_LIMITS
from sitepulse.catalog.registry import query
from sitepulse.session import shared_dir
from sitepulse.sources import current_version, replace_table


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/sitepulse-{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    # As a pattern, the path may be one file or a folder of files.
    return st.event_stream(spark, f"{sf}/events.parque[t]").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int"))


def _plain(df: DataFrame) -> DataFrame:
    """Times without zone again, as the sample tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes
                           if kind == "timestamp"})


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    return _plain(st.run_available(stream, _folder(spark)))


@query("stream_slot_counts", """
    select user_id, slot_start, slot_start + interval 4 hour as slot_end, signals
    from (select user_id, time_bucket(interval 4 hour, ts) as slot_start, count(*) as signals
          from events group by user_id, time_bucket(interval 4 hour, ts))
    where slot_start + interval 4 hour <= (select max(ts) from events) - interval 1 hour""")
def _(spark, sf):
    return _drained(spark, st.slot_counts(_events(spark, sf), "ts", ["user_id"]))


@query("stream_slot_counts_whole", """
    select user_id, slot_start, slot_start + interval 4 hour as slot_end, signals
    from (select user_id, time_bucket(interval 4 hour, ts) as slot_start, count(*) as signals
          from events group by user_id, time_bucket(interval 4 hour, ts))""")
def _(spark, sf):
    """Every row counts, in the newest slots and behind the watermark as well."""
    folder = _folder(spark)
    st.run_batches(_events(spark, sf), folder, st.slot_handler(spark, f"{folder}/slots", "ts",
                                                               ["user_id"]))
    return _plain(st.slot_totals(spark, f"{folder}/slots", ["user_id"]))


@query("stream_sliding_counts", """
    select event_type, window_start, window_start + interval 2 hour as window_end, signals
    from (select event_type, window_start, count(*) as signals from (
        select event_type, unnest(generate_series(time_bucket(interval 15 minute, ts)
          - interval 105 minute, time_bucket(interval 15 minute, ts), interval 15 minute))
          as window_start from events) group by event_type, window_start)
    where signals >= 2 and window_start + interval 2 hour
      <= (select max(ts) from events) - interval 15 minute""")
def _(spark, sf):
    return _drained(spark, st.sliding_counts(_events(spark, sf), "ts", ["event_type"],
                                             at_least=2))


@query("stream_distinct_tickets", "select distinct user_id, event_type from events")
def _(spark, sf):
    """The delay spans the whole sample, so every key is kept once."""
    return _drained(spark, st.distinct_tickets(
        _events(spark, sf), "ts", ["user_id", "event_type"], "60 days").select(
        "user_id", "event_type"))


@query("stream_acknowledged", with_views("tickets", """
    select event_id, opened_on, ack_on from tickets where ack_on is not null
      or opened_on + interval 1 hour < (select least(max(opened_on), max(ack_on)) from tickets)
        - interval 30 minute"""))
def _(spark, sf):
    """Pairs, and tickets whose hour for an acknowledgement had passed when the input ended."""
    opened = _events(spark, sf).select("event_id", F.col("ts").alias("opened_on"))
    acks = _events(spark, sf).filter("k < 75").select("event_id", (F.col("ts") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.floor(F.col("k") / 5).cast("int"))).alias("ack_on"))
    return _drained(spark, st.acknowledged_tickets(opened, acks))


_SESSIONS = """
    select user_id, session_start, last_signal, signals from (
      select user_id, s, min(ts) as session_start, max(ts) as last_signal, count(*) as signals
      from (select *, sum(fresh) over (partition by user_id order by ts, event_id) as s
        from (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id)
                < interval {gap} then 0 else 1 end as fresh from events {where}))
      group by user_id, s)
    where last_signal + interval {gap} <= (select max(ts) from events {where}) - interval 1 hour"""


@query("stream_offline_sessions", _SESSIONS.format(gap="6 hour",
                                                   where="where event_type = 'error'"))
def _(spark, sf):
    errors = _events(spark, sf).filter("event_type = 'error'")
    return _drained(spark, st.offline_sessions(errors, "ts", "user_id", gap="6 hours"))


@query("stream_silent_sites", "select user_id, last_signal, last_signal + interval 12 hour "
       f"as alarm_at from ({_SESSIONS.format(gap='12 hour', where='')})")
def _(spark, sf):
    return _drained(spark, st.silent_sites(_events(spark, sf), "ts", "user_id",
                                           silence="12 hours"))


@query("stream_site_alarms", f"""
    with sites as (select c_custkey as user_id, timestamp '{b.FIRST_DAY}' as ts from customer),
    rows as (select user_id, ts, true as seen from events union all
      select user_id, ts, false from sites),
    runs as (select user_id, min(ts) as first, max(ts) as last,
        max(ts) filter (seen) as last_signal,
        row_number() over (partition by user_id order by min(ts)) as pos
      from (select *, sum(fresh) over (partition by user_id order by ts, seen) as s
        from (select *, case when ts - lag(ts) over (partition by user_id order by ts, seen)
                < interval 12 hour then 0 else 1 end as fresh from rows)) group by user_id, s),
    reached as (select max(ts) - interval 1 hour as t from events)
    select user_id, 'silent' as kind, last_signal, last + interval 12 hour as at
    from runs, reached where last + interval 12 hour <= t
    union all select user_id, 'back', null, first from runs, reached where pos > 1 and first <= t
    """)
def _(spark, sf):
    """Every customer is watched from the first day on; most of them never send anything."""
    watched = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit(b.FIRST_DAY).cast("timestamp").alias("since"))
    return _drained(spark, st.site_alarms(_events(spark, sf), watched, "ts", "user_id",
                                          silence="12 hours"))


# Tickets that are open when the stream starts.
_KNOWN = "closed_on is null and opened_on < timestamp_ntz'2024-01-05'"


@query("stream_fault_states", with_views("fault_tickets disk_status", """
    select box_id, st as error, opened_on, closed_on from (
      select box_id, st, min(moment) as opened_on,
        lead(min(moment)) over (partition by box_id order by s) as closed_on
      from (select *, sum(fresh) over (partition by box_id order by moment, pos, hdd, error) as s
        from (select *, case when st is not distinct from lag(st) over w and lag(moment) over w
                is not null then 0 else 1 end as fresh from rows
              window w as (partition by box_id order by moment, pos, hdd, error)))
      group by box_id, s, st) where st is not null""",
    ("known", "select * from fault_tickets where closed_on is null and opened_on < timestamp "
              "'2024-01-05' qualify row_number() over (partition by box_id order by opened_on "
              "desc, error desc) = 1"),
    ("rows", "select box_id, '0' as hdd, error, opened_on as moment, 0 as pos, error as st from known "
             "union all select d.box_id, hdd, d.error, at_time, 1, "
             "case when hdd = '0' then d.error end from disk_status d left join known k "
             "on k.box_id = d.box_id where k.box_id is null or at_time >= k.opened_on")))
def _(spark, sf):
    """Closed tickets as the stream writes them, open ones from its state."""
    folder = _folder(spark)
    status = _events(spark, sf).filter("event_type in ('error', 'click')").select(
        F.col("user_id").alias("box_id"),
        F.when(F.col("event_type") == "error", "0").otherwise("1").alias("hdd"),
        b._error(F.col("k")).alias("error"), F.col("ts").alias("at_time"))
    known = b.fault_tickets(spark, sf).filter(_KNOWN)
    closed = st.run_available(st.fault_states(status, known), folder)
    still = st.open_faults(spark, f"{folder}/state")
    return _plain(closed.unionByName(still, allowMissingColumns=True))


@query("stream_near_violation", with_views("tickets remarks sites", "select * from near", *_OPEN))
def _(spark, sf):
    folder = _folder(spark)
    k, ts = F.col("k"), F.col("ts")
    stream = _plain(_events(spark, sf).select(
        "event_id", F.col("user_id").alias("site_id"),
        F.when(F.col("event_type") == "error", "SOS")
        .when(F.col("event_type") == "signup", "Critical").otherwise("Info").alias("event_type"),
        F.col("event_type").alias("msg"), ts.alias("at_time"), ts.alias("opened_on"),
        F.when(k >= 10, ts + F.make_dt_interval(F.lit(0), F.lit(0),
                                                F.floor("value").cast("int")))
        .alias("closed_on")))
    handler = st.near_violation_feed(
        spark, f"{folder}/tickets", f"{folder}/feed", lambda: b.sites(spark, sf),
        lambda: b.ASOF, limits=WIDE_LIMITS, days=31, excluded=["nothing"])
    st.run_batches(stream, folder, handler)
    return current_version(spark, f"{folder}/feed")


_STREAM_DISK = (
    ("open", "select * from fault_tickets where closed_on is null"),
    ("latest", "select * from disk_status qualify row_number() over (partition by box_id "
               "order by at_time desc, error desc) = 1"),
    ("fresh", "select box_id, error, at_time from latest l where hdd = '0' and not exists ("
              "select 1 from open o where o.box_id = l.box_id and o.error = l.error)"),
    ("closing", "select ticket_id from open where box_id in (select box_id from latest where "
                "hdd = '1') union select ticket_id from (select ticket_id, row_number() over "
                "(partition by box_id order by opened_on desc, ticket_id desc) as rn from open) "
                "where rn > 1"))


@query("stream_fault_lifecycle", with_views("fault_tickets disk_status sites", f"""
    select box_id, error, opened_on, case when ticket_id in (select ticket_id from closing)
      then timestamp '{b.ASOF}' end as closed_on from open union all
    select box_id, error, at_time, null from fresh
    where box_id in (select box_id from sites)""", *_STREAM_DISK))
def _(spark, sf):
    folder = _folder(spark)
    tickets = b.fault_tickets(spark, sf).filter("closed_on is null").select(
        "ticket_id", "site_id", "box_id", "site_name", "bank", "error", "opened_on", "closed_on",
        F.lit(None).cast("timestamp_ntz").alias("latest_remote_recording"))
    replace_table(tickets, f"{folder}/open", version=-1)
    k = F.col("k")
    status = _plain(_events(spark, sf).filter("event_type in ('error', 'click')").select(
        F.col("user_id").alias("site_id"), F.col("user_id").alias("box_id"),
        F.when(F.col("event_type") == "error", "0").otherwise("1").alias("hdd"),
        F.when(k < 40, "ENOENT").when(k < 80, "ENODR").otherwise("EIO").alias("error"),
        F.col("ts").alias("at_time")))
    handler = st.fault_lifecycle(
        spark, f"{folder}/open", f"{folder}/archive", lambda: b.sites(spark, sf),
        lambda: b.recorder_signals(spark, sf), lambda: b.ASOF, minutes=31 * 1440)
    st.run_batches(status, folder, handler)
    columns = ["box_id", "error", "opened_on", "closed_on"]
    archive = spark.read.parquet(f"{folder}/archive").select(*columns)
    return current_version(spark, f"{folder}/open").select(*columns).unionByName(archive)
