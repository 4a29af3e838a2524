"""The building blocks on the sample tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse import bindings as b
from sitepulse import operators as op
from sitepulse import sources as src
from sitepulse.bindings import half_up, with_views
from sitepulse.catalog.registry import CHECKS, minutes, query
from sitepulse.functions import (
    clamp, clip, combine_date_time, contains, cube_root, cut, days_before, drop_blanks,
    first_match, hours_between, minutes_between, minutes_between_exact, not_text, number_or_zero,
    parse_time, ratio, recode, row_argmin, row_max, row_mean, row_min, row_null_count, row_range,
    row_slope, row_std, row_sum, slot_label, text_flag, title_case,
)
from sitepulse.plans import rolling
from sitepulse.session import shared_dir

TYPES = ["click", "error", "purchase", "signup", "view"]
PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium",
              "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
ASOF_SQL = f"timestamp '{b.ASOF}'"


def _types(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(t=t) for t in TYPES)


# ---- one row per key -------------------------------------------------------------------------

@query("latest_per_key", """
    select user_id, event_id, event_type, ts, value from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return op.latest_per_key(
        b.table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts", "value"),
        ["user_id"], ["ts", "event_id"])


@query("first_per_key", """
    select user_id, event_type, event_id, ts from events
    qualify row_number() over (partition by user_id, event_type order by ts, event_id) = 1""")
def _(spark, sf):
    return op.first_per_key(
        b.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts"),
        ["user_id", "event_type"], ["ts", "event_id"])


@query("dedupe_business_key", """
    select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate, l_partkey, l_suppkey, l_quantity) = 1""")
def _(spark, sf):
    cols = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    return op.dedupe(b.table(spark, sf, "lineitem").select(*cols), cols[:2], cols[2:])


@query("distinct_rows", "select distinct l_partkey, l_suppkey, l_returnflag from lineitem")
def _(spark, sf):
    return b.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey",
                                                 "l_returnflag").distinct()


@query("last_non_null", with_views("tickets", """
    select site_id, arg_max(closed_on, opened_on) filter (closed_on is not null) as closed_on,
      arg_max(ack_on, opened_on) filter (ack_on is not null) as ack_on,
      arg_max(closing_reason, opened_on) filter (closing_reason is not null) as closing_reason
    from tickets group by site_id"""))
def _(spark, sf):
    return op.last_non_null(b.tickets(spark, sf), ["site_id"], "opened_on",
                            ["closed_on", "ack_on", "closing_reason"])


@query("latest_values", with_views("recorder_signals", """
    select box_id, max(at_time) filter (event_code = 'RECORD') as last_local,
      max(at_time) filter (event_code = 'REMOTERECORD') as last_remote
    from recorder_signals group by box_id"""))
def _(spark, sf):
    code = F.col("event_code")
    return op.latest_values(b.recorder_signals(spark, sf), ["box_id"], "at_time", {
        "last_local": code == "RECORD", "last_remote": code == "REMOTERECORD"})


@query("peer_latest", with_views("recorder_signals", f"""
    select box_id, device_id, last_at, max(last_at) over (partition by box_id) as newest,
      {minutes('last_at', 'max(last_at) over (partition by box_id)')} as lag_minutes
    from (select box_id, device_id, max(at_time) as last_at from recorder_signals
          group by box_id, device_id)"""))
def _(spark, sf):
    last = b.recorder_signals(spark, sf).groupBy("box_id", "device_id").agg(
        F.max("at_time").alias("last_at"))
    return op.peer_latest(last, ["box_id"], "last_at", "newest").withColumn(
        "lag_minutes", minutes_between("last_at", "newest"))


@query("superseded_rows", with_views("fault_tickets", """
    select ticket_id, box_id, opened_on from fault_tickets where closed_on is null
    qualify row_number() over (partition by box_id order by opened_on desc, ticket_id desc) > 1
    """))
def _(spark, sf):
    open_ = b.fault_tickets(spark, sf).filter("closed_on is null")
    return op.superseded(open_.select("ticket_id", "box_id", "opened_on"), ["box_id"],
                         ["opened_on", "ticket_id"], "ticket_id")


@query("group_size", """
    select event_id, user_id, count(*) over (partition by user_id) as site_tickets from events""")
def _(spark, sf):
    return op.group_size(b.table(spark, sf, "events").select("event_id", "user_id"),
                         ["user_id"], "site_tickets")


# ---- ranks, buckets, labels ------------------------------------------------------------------

_RANK = "(rank() over (order by {v}) + (count(*) over (partition by {v}) - 1) / 2.0) / count(*) over ()"


@query("pct_rank_sites", f"""
    select user_id, n, {half_up(_RANK.format(v='n'), 2)} as pct
    from (select user_id, count(*) as n from events group by user_id)""")
def _(spark, sf):
    counts = b.table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return op.pct_rank(counts, "n", "pct")


@query("pct_rank_orders", f"""
    select o_orderkey, {half_up(_RANK.format(v='o_totalprice'), 4)} as pct
    from orders where o_orderstatus <> 'P'
    union all select o_orderkey, null from orders where o_orderstatus = 'P'""")
def _(spark, sf):
    priced = b.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v"))
    return op.pct_rank(priced, "v", "pct", digits=4).drop("v")


@query("pct_rank_kept", CHECKS["pct_rank_orders"])
def _(spark, sf):
    """The same ranks from a kept histogram into which the second half of the orders was merged."""
    priced = b.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v"))
    path = _folder(spark)
    src.replace_table(op.rank_histogram(priced.filter("o_orderkey % 2 = 0"), ["v"]), path)
    src.replace_table(op.rank_histogram(priced.filter("o_orderkey % 2 = 1"), ["v"],
                                        src.current_version(spark, path)), path)
    kept = src.current_version(spark, path)
    return op.ranks_from(priced, kept, {"v": "pct"}, digits=4).drop("v")


@query("bucket_by_rank", f"""
    select c_custkey, case when pct <= 0.2 then 'P5' when pct <= 0.4 then 'P4'
      when pct <= 0.6 then 'P3' when pct <= 0.8 then 'P2' else 'P1' end as priority
    from (select c_custkey, {half_up(_RANK.format(v='c_acctbal'), 2)} as pct from customer)""")
def _(spark, sf):
    return op.bucket_by_rank(
        b.table(spark, sf, "customer").select("c_custkey", "c_acctbal"),
        {"c_acctbal": ("priority", ["P5", "P4", "P3", "P2", "P1"])},
        [-1, 0.2, 0.4, 0.6, 0.8, 1]).drop("c_acctbal")


@query("cut_right_closed", """
    select event_id, case when floor(value) > 0 and floor(value) <= 10 then 'a'
      when floor(value) > 10 and floor(value) <= 30 then 'b'
      when floor(value) > 30 and floor(value) <= 60 then 'c'
      when floor(value) > 60 and floor(value) <= 120 then 'd' end as band from events""")
def _(spark, sf):
    return b.table(spark, sf, "events").select("event_id", cut(
        F.floor("value"), [0, 10, 30, 60, 120], ["a", "b", "c", "d"]).alias("band"))


@query("first_match_label", """
    select l_returnflag, l_linestatus, label, count(*) as lines from (
      select l_returnflag, l_linestatus, case when l_quantity >= 40 and l_discount >= 0.08
        then 'bulk rebate' when l_quantity >= 40 then 'bulk' when l_discount >= 0.08
        then 'rebate' else '0' end as label from lineitem) group by all""")
def _(spark, sf):
    big, rebate = F.col("l_quantity") >= 40, F.col("l_discount") >= 0.08
    label = first_match([(big & rebate, "bulk rebate"), (big, "bulk"), (rebate, "rebate")], "0")
    return (b.table(spark, sf, "lineitem")
            .groupBy("l_returnflag", "l_linestatus", label.alias("label"))
            .agg(F.count("*").alias("lines")))


@query("recode_values", """
    select o_orderkey, case o_orderpriority when '1-URGENT' then 'P1' when '2-HIGH' then 'P2'
      else o_orderpriority end as kept, case o_orderpriority when '1-URGENT' then 'P1'
      when '2-HIGH' then 'P2' end as listed from orders""")
def _(spark, sf):
    names = {"1-URGENT": "P1", "2-HIGH": "P2"}
    value = F.col("o_orderpriority")
    return b.table(spark, sf, "orders").select(
        "o_orderkey", recode(value, names).alias("kept"),
        recode(value, names, keep_unmapped=False).alias("listed"))


# ---- joins -----------------------------------------------------------------------------------

@query("enrich_sites", with_views("tickets sites", """
    select event_id, site_id, site_name, bank, state, zone
    from tickets left join sites using (site_id)"""))
def _(spark, sf):
    site = b.sites(spark, sf).select("site_id", "site_name", "bank", "state", "zone")
    return b.tickets(spark, sf).select("event_id", "site_id").join(site, "site_id", "left")


@query("dictionary_right_join", with_views("sensor_signals dictionary", """
    select site_id, unit_no, event_code, count(*) as signals
    from sensor_signals join dictionary using (group_no, unit_no, event_code) group by all"""))
def _(spark, sf):
    joined = b.sensor_signals(spark, sf).join(
        b.dictionary(spark, sf), ["group_no", "unit_no", "event_code"], "right")
    return (joined.filter("at_time is not null").groupBy("site_id", "unit_no", "event_code")
            .agg(F.count("*").alias("signals")))


@query("semi_join", """
    select c_custkey, c_name from customer
    where c_custkey in (select user_id from events where event_type = 'error')""")
def _(spark, sf):
    seen = b.table(spark, sf, "events").filter("event_type = 'error'")
    return op.semi(b.table(spark, sf, "customer").select("c_custkey", "c_name"), seen,
                   ["c_custkey"], ["user_id"])


@query("semi_join_two_keys", """
    select event_id, user_id, event_type from events
    where (user_id, event_type) in (select user_id, event_type from events where value > 200)""")
def _(spark, sf):
    df = b.table(spark, sf, "events")
    return op.semi(df.select("event_id", "user_id", "event_type"), df.filter("value > 200"),
                   ["user_id", "event_type"])


@query("anti_join", """
    select c_custkey, c_name from customer where not exists (
      select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')""")
def _(spark, sf):
    done = b.table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    return op.anti(b.table(spark, sf, "customer").select("c_custkey", "c_name"), done,
                   ["c_custkey"], ["o_custkey"])


@query("anti_join_two_keys", with_views("disk_status fault_tickets", """
    select box_id, error, at_time from disk_status d where hdd = '0' and not exists (
      select 1 from fault_tickets f where closed_on is null and f.box_id = d.box_id
        and f.error = d.error)"""))
def _(spark, sf):
    open_ = b.fault_tickets(spark, sf).filter("closed_on is null")
    faulty = b.disk_status(spark, sf).filter("hdd = '0'")
    return op.anti(faulty.select("box_id", "error", "at_time"), open_, ["box_id", "error"])


@query("null_safe_anti", with_views("tickets", """
    select t.event_id, t.site_id, t.closed_on, t.ack_on from tickets t where not exists (
      select 1 from tickets o where o.closed_on is null and t.site_id = o.site_id
        and t.msg = o.msg and t.closed_on is not distinct from o.closed_on
        and t.ack_on is not distinct from o.ack_on)"""))
def _(spark, sf):
    df = b.tickets(spark, sf)
    keys = ["site_id", "msg", "closed_on", "ack_on"]
    out = op.null_safe_anti(df, df.filter("closed_on is null").select(*keys), keys)
    return out.select("event_id", "site_id", "closed_on", "ack_on")


@query("null_safe_semi", with_views("tickets", """
    select t.event_id, t.closing_reason from tickets t where exists (
      select 1 from tickets o where o.event_type = 'SOS' and t.site_id = o.site_id
        and t.closing_reason is not distinct from o.closing_reason)"""))
def _(spark, sf):
    df = b.tickets(spark, sf)
    return op.null_safe_semi(df, df.filter("event_type = 'SOS'"),
                             ["site_id", "closing_reason"]).select("event_id", "closing_reason")


@query("except_rows", with_views("tickets", """
    select t.site_id, t.unit_no, t.closing_reason from tickets t where not exists (
      select 1 from tickets o where o.event_code = '20' and o.site_id = t.site_id
        and o.unit_no = t.unit_no and o.closing_reason is not distinct from t.closing_reason)"""))
def _(spark, sf):
    cols = ["site_id", "unit_no", "closing_reason"]
    df = b.tickets(spark, sf)
    return op.except_rows(df.select(*cols), df.filter("event_code = '20'").select(*cols))


@query("natural_join", with_views("tickets", """
    select event_id, site_id, closing_reason, n from tickets join (
      select site_id as s, closing_reason as r, count(*) as n from tickets group by all)
      on s = site_id and r is not distinct from closing_reason"""))
def _(spark, sf):
    df = b.tickets(spark, sf).select("event_id", "site_id", "closing_reason")
    counts = df.groupBy("site_id", "closing_reason").agg(F.count("*").alias("n"))
    return op.natural_join(df, counts)


@query("natural_join_outer", with_views("tickets", """
    select coalesce(o.site_id, t.site_id) as site_id, coalesce(o.closing_reason, t.closing_reason)
      as closing_reason, o.n as opened, t.n as noted
    from (select site_id, closing_reason, count(*) as n from tickets where event_code = '20'
          group by all) o
    full join (select site_id, closing_reason, count(*) as n from tickets where unit_no = '36'
               group by all) t
      on o.site_id = t.site_id and o.closing_reason is not distinct from t.closing_reason"""))
def _(spark, sf):
    tickets = b.tickets(spark, sf)
    opened, noted = (tickets.filter(test).groupBy("site_id", "closing_reason").agg(
        F.count("*").alias(name)) for test, name in (("event_code = '20'", "opened"),
                                                     ("unit_no = '36'", "noted")))
    return op.natural_join(opened, noted, "outer")


@query("densify", with_views("sites tickets", """
    select site_id, bank, coalesce(n, 0) as n from sites left join (
      select site_id, count(*) as n from tickets group by site_id) using (site_id)"""))
def _(spark, sf):
    counts = b.tickets(spark, sf).groupBy("site_id").agg(F.count("*").alias("n"))
    return op.densify(b.sites(spark, sf).select("site_id", "bank"), counts, ["site_id"], ["n"])


@query("flag_members", with_views("tickets sites", """
    select site_id, case when site_id in (select site_id from tickets where msg = 'purchase'
      and lower(closing_reason) like '%security%') then 1 else 0 end as security from sites"""))
def _(spark, sf):
    guarded = b.tickets(spark, sf).filter(
        (F.col("msg") == "purchase") & contains(F.col("closing_reason"), "security"))
    return op.flag_members(b.sites(spark, sf).select("site_id"), guarded, ["site_id"], "security")


_SIDES = ("(select site, month, sum(amount) as s, count(*) as n from penalties "
          "where item = '{item}' group by site, month)")


@query("outer_combine", with_views("penalties", f"""
    select coalesce(a.site, c.site) as site, coalesce(a.month, c.month) as month,
      round(coalesce(a.s, c.s), 2) as amount
    from {_SIDES.format(item='1-URGENT')} a full join {_SIDES.format(item='2-HIGH')} c
      on a.site = c.site and a.month = c.month"""))
def _(spark, sf):
    df = b.penalties(spark, sf)
    out = op.outer_combine(df.filter("item = '1-URGENT'"), df.filter("item = '2-HIGH'"),
                           ["site", "month"], "amount")
    return out.withColumn("amount", F.round("amount", 2))


@query("outer_join_sums", with_views("penalties", """
    select site, month, round(sum(coalesce(p, 0)), 2) as mcu,
      round(sum(coalesce(q, 0)), 2) as equipment from (
      select coalesce(a.site, c.site) as site, coalesce(a.month, c.month) as month,
        a.amount as p, c.amount as q
      from (select * from penalties where item = '1-URGENT') a
      full join (select * from penalties where item = '2-HIGH') c
        on a.site = c.site and a.month = c.month) group by site, month"""))
def _(spark, sf):
    df = b.penalties(spark, sf)
    sides = [(df.filter("item = '1-URGENT'").withColumnRenamed("amount", "mcu"), "mcu"),
             (df.filter("item = '2-HIGH'").withColumnRenamed("amount", "equipment"),
              "equipment")]
    return op.outer_join_sums(sides, ["site", "month"]).select(
        "site", "month", F.round("mcu", 2).alias("mcu"),
        F.round("equipment", 2).alias("equipment"))


# ---- intervals -------------------------------------------------------------------------------

_STAB = with_views("tickets episodes", """
    select event_id, exists (select 1 from episodes e where e.site_id = t.site_id
      and e.at_time <= t.asked_at and (e.closed_on >= t.asked_at or e.closed_on is null))
      as offline, exists (select 1 from episodes e where e.site_id = t.site_id
      and e.at_time <= t.asked_at and e.closed_on >= t.asked_at) as offline_closed
    from (select event_id, site_id, opened_on + to_minutes(20) as asked_at from tickets) t""")


def _stabbed(spark: SparkSession, sf: str, **options) -> DataFrame:
    asked = b.tickets(spark, sf).select(
        "event_id", "site_id",
        (F.col("opened_on") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(20)))
        .alias("asked_at"))
    down = b.episodes(spark, sf)
    out = op.covered_points(asked, {"offline": down, "offline_closed":
                                    down.filter("closed_on is not null")},
                            "site_id", "asked_at", "at_time", "closed_on", **options)
    return out.select("event_id", "offline", "offline_closed")


@query("interval_stab", _STAB)
def _(spark, sf):
    return _stabbed(spark, sf)


@query("interval_stab_busy", _STAB)
def _(spark, sf):
    """Days as bins, each with more than a few rows split into hours."""
    return _stabbed(spark, sf, bin_unit="day", piece_unit="hour", busy_rows=2)


@query("interval_overlap", with_views("episodes", """
    select event_id, site_id, at_time, closed_on from episodes
    where opened_on < timestamp '2024-01-16' and (closed_on >= timestamp '2024-01-15'
      or closed_on is null)"""))
def _(spark, sf):
    low = F.lit("2024-01-15").cast("timestamp_ntz")
    return op.overlapping(b.episodes(spark, sf), "opened_on", "closed_on", low,
                          low + F.make_dt_interval(F.lit(1))).select(
        "event_id", "site_id", "at_time", "closed_on")


@query("interval_clip", with_views("episodes", """
    select event_id, greatest(timestamp '2024-01-10', least(at_time, timestamp '2024-01-20'))
      as at_time, greatest(timestamp '2024-01-10', least(coalesce(closed_on,
      timestamp '2024-01-20'), timestamp '2024-01-20')) as closed_on from episodes"""))
def _(spark, sf):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-20"))
    return op.clip_intervals(b.episodes(spark, sf), "at_time", "closed_on", low, high).select(
        "event_id", "at_time", "closed_on")


@query("downtime_minutes", with_views("episodes", f"""
    select site_id, cast(sum({minutes('at_time', 'closed_on')}) as bigint) as down_minutes
    from episodes group by site_id"""))
def _(spark, sf):
    return op.downtime_minutes(b.episodes(spark, sf), ["site_id"], "at_time", "closed_on",
                               "down_minutes")


# ---- aggregation -----------------------------------------------------------------------------

@query("crosstab_counts", f"""
    select user_id, {_types("count(*) filter (event_type = '{t}') as {t}")}
    from events group by user_id""")
def _(spark, sf):
    return op.crosstab_counts(b.table(spark, sf, "events"), ["user_id"], "event_type", TYPES)


@query("pivot_mean", f"""
    select user_id, {_types("cast(round(cast(avg(value) filter (event_type = '{t}') "
                            "as decimal(28, 12)), 4) as double) as {t}")}
    from events group by user_id""")
def _(spark, sf):
    return op.pivot_agg(b.table(spark, sf, "events"), ["user_id"], "event_type", TYPES, "value",
                        lambda c: F.round(F.avg(c.cast("decimal(18,8)")), 4).cast("double"))


@query("pivot_sum", """
    select o_custkey, """ + ", ".join(
    f"round(sum(o_totalprice) filter (o_orderpriority = '{p}'), 2) as {n}"
    for p, n in PRIORITIES.items()) + " from orders group by o_custkey")
def _(spark, sf):
    return op.pivot_agg(b.table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority",
                        PRIORITIES, "o_totalprice", lambda c: F.round(F.sum(c), 2))


@query("pivot_mode", """
    with c as (select o_custkey, o_orderpriority, o_orderstatus, count(*) as n from orders
      group by all), r as (select *, row_number() over (partition by o_custkey, o_orderpriority
      order by n desc, o_orderstatus) as rn from c)
    select o_custkey, """ + ", ".join(
    f"max(o_orderstatus) filter (o_orderpriority = '{p}') as {n}"
    for p, n in PRIORITIES.items()) + " from r where rn = 1 group by o_custkey")
def _(spark, sf):
    return op.pivot_mode(b.table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority",
                         PRIORITIES, "o_orderstatus")


@query("pivot_text", """
    select o_custkey, """ + ", ".join(
    f"string_agg(o_orderstatus, ' ' order by o_orderstatus) filter (o_orderpriority = '{p}') "
    f"as {n}" for p, n in PRIORITIES.items()) + " from orders group by o_custkey")
def _(spark, sf):
    return op.pivot_text(b.table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority",
                         PRIORITIES, "o_orderstatus", ["F", "O", "P"])


@query("pivot_unique", """
    select nation, """ + ", ".join(
    f"max(n) filter (seg = '{s}') as {s.lower()}" for s in
    ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + """
    from (select c_nationkey as nation, c_mktsegment as seg, count(*) as n from customer
          group by all) group by nation""")
def _(spark, sf):
    counted = b.table(spark, sf, "customer").groupBy(
        F.col("c_nationkey").alias("nation"), F.lower("c_mktsegment").alias("seg")).agg(
        F.count("*").alias("n"))
    return op.pivot_unique(counted, ["nation"], "seg",
                           ["automobile", "building", "furniture", "household", "machinery"], "n")


@query("horizon_counts", """
    select user_id, event_type, count(*) filter (ts >= timestamp '2024-01-28') as count_3days,
      count(*) filter (ts >= timestamp '2024-01-24') as count_7days,
      count(*) filter (ts >= timestamp '2024-01-16') as count_15days from events
    group by all having count_3days >= 1 and count_7days >= 2 and count_15days >= 4""")
def _(spark, sf):
    at_least = {"count_3days": 1, "count_7days": 2, "count_15days": 4}
    since = {name: F.col("ts") >= days_before(b.ASOF, days)
             for name, days in zip(at_least, (3, 7, 15))}
    return op.horizon_counts(b.table(spark, sf, "events"), ["user_id", "event_type"], since,
                             at_least)


@query("conditional_counts", """
    select count(*) as all_rows, count(*) filter (value >= 12) as high,
      count(*) filter (value >= 8 and value < 12) as middle,
      count(*) filter (event_type = 'error' and value < 8) as low_errors from events""")
def _(spark, sf):
    value = F.col("value")
    return op.conditional_counts(b.table(spark, sf, "events"), {
        "all_rows": F.lit(True), "high": value >= 12, "middle": (value >= 8) & (value < 12),
        "low_errors": (F.col("event_type") == "error") & (value < 8)})


@query("non_null_counts", with_views("tickets", """
    select site_id, count(event_id) as event_id, count(closed_on) as closed_on,
      count(closed_by) as closed_by, count(ack_on) as ack_on from tickets group by site_id"""))
def _(spark, sf):
    cols = ["event_id", "closed_on", "closed_by", "ack_on"]
    return b.tickets(spark, sf).groupBy("site_id").agg(*[F.count(c).alias(c) for c in cols])


@query("summed_measures", """
    select l_suppkey, cast(sum(l_linenumber) as bigint) as l_linenumber,
      round(sum(l_quantity), 2) as l_quantity,
      round(sum(l_linenumber) + sum(l_quantity), 2) as both from lineitem group by l_suppkey""")
def _(spark, sf):
    out = op.summed_measures(b.table(spark, sf, "lineitem"), ["l_suppkey"],
                             ["l_linenumber", "l_quantity"], "both")
    return out.withColumns({c: F.round(c, 2) for c in ("l_quantity", "both")})


@query("distinct_counts", """
    select l_returnflag, count(distinct l_orderkey) as orders, count(distinct l_suppkey)
      as suppliers from lineitem group by l_returnflag""")
def _(spark, sf):
    # Distinct pairs first, so a flag's keys are spread over tasks before they are counted.
    df = b.table(spark, sf, "lineitem")
    return df.groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"),
        F.countDistinct("l_suppkey").alias("suppliers"))


@query("distinct_rolling", """
    with days as (select unnest(generate_series((select min(ts) from events)::date,
        (select max(ts) from events)::date, interval 1 day))::date as day)
    select day, event_type, count(distinct user_id) as exact, true as within_bound
    from days join events on ts::date between day - 6 and day group by day, event_type""")
def _(spark, sf):
    """Different users in the seven days up to each day: exact, and checked against sketches."""
    events, day = b.table(spark, sf, "events"), F.to_date("ts")
    sketches = rolling.distinct_sketches(events, day, ["event_type"], "user_id")
    found = rolling.rolling_distinct(sketches, ["event_type"], 7).join(
        rolling.rolling_distinct_exact(events, day, ["event_type"], "user_id", 7),
        ["day", "event_type"])
    gap = F.abs(F.col("estimate") - F.col("exact"))
    return found.select("day", "event_type", "exact",
                        (gap <= rolling.distinct_bound(F.col("exact"))).alias("within_bound"))


@query("profile_of_days", """
    select 'value' as "column", count(*) as rows, count(*) - count(value) as nulls,
      round(avg(value), 6) as mean, round(stddev(value), 6) as std, min(value) as smallest,
      max(value) as largest, true as ranks_right from events
    union all select 'event_id', count(*), count(*) - count(event_id),
      round(avg(event_id::double), 6), round(stddev(event_id::double), 6),
      min(event_id)::double, max(event_id)::double, true from events""")
def _(spark, sf):
    """A month's profile from daily sketches; each quantile's true rank is near its share."""
    events, columns = b.table(spark, sf, "events"), ["value", "event_id"]
    shares = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    daily = rolling.daily_profiles(events, F.to_date("ts"), columns)
    profile = rolling.merged_profile(daily, shares)
    errors = rolling.rank_errors(events, profile, columns, shares)
    right = F.greatest(*[F.col(f"e.{n}") for n in shares]) <= 3 / rolling.QUANTILE_K
    return profile.alias("p").join(errors.alias("e"), "column").select(
        "column", "rows", "nulls", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"),
        "smallest", "largest", right.alias("ranks_right"))


@query("grouping_levels", with_views("tickets sites", """
    select bank, site_id, case when grouping(site_id) = 1 then 'group' else 'member' end
      as level, cast(count(*) as bigint) as tickets,
      cast(count(*) filter (event_type = 'SOS') as bigint) as sos
    from tickets join sites using (site_id) group by grouping sets ((bank), (bank, site_id))"""))
def _(spark, sf):
    counted = b.tickets(spark, sf).groupBy("site_id").agg(
        F.count("*").alias("tickets"), F.count_if(F.col("event_type") == "SOS").alias("sos"))
    named = counted.join(b.sites(spark, sf).select("site_id", "bank"), "site_id")
    return op.two_level_sums(named, ["bank"], ["site_id"], ["tickets", "sos"])


@query("share_of_total", f"""
    select l_returnflag, l_linestatus, count(*) as count,
      {half_up('count(*) * 100.0 / (select count(*) from lineitem)', 2)} as percentage
    from lineitem group by all""")
def _(spark, sf):
    return op.share_of_total(b.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("frequency", "select o_orderpriority, count(*) as count from orders group by all")
def _(spark, sf):
    return op.frequency(b.table(spark, sf, "orders"), "o_orderpriority")


@query("column_profile", with_views("", """
    select 'o_totalprice' as "column", count(*) as rows, count(*) - count(o_totalprice) as nulls,
      round(avg(o_totalprice), 2) as mean, round(stddev(o_totalprice), 2) as std,
      min(o_totalprice) as smallest, max(o_totalprice) as largest,
      round(quantile_cont(o_totalprice, 0.25), 2) as q25,
      round(quantile_cont(o_totalprice, 0.5), 2) as median,
      round(quantile_cont(o_totalprice, 0.75), 2) as q75 from orders
    union all select 'o_orderstatus', count(*), count(*) - count(o_orderstatus), null, null,
      null, null, null, null, null from orders"""))
def _(spark, sf):
    out = op.column_profile(b.table(spark, sf, "orders"), ["o_totalprice"], ["o_orderstatus"])
    return out.withColumns({c: F.round(c, 2) for c in ("mean", "std", "q25", "median", "q75")})


@query("slope", """
    select o_custkey, case when not isnan(s) then cast(round(cast(s as decimal(18, 6)), 2)
      as double) end as slope
    from (select o_custkey, regr_slope(o_totalprice, month(o_orderdate)) as s from orders
          group by o_custkey)""")
def _(spark, sf):
    df = b.table(spark, sf, "orders").withColumn("m", F.month("o_orderdate"))
    return op.slope(df, ["o_custkey"], "o_totalprice", "m").withColumn(
        "slope", F.round(F.col("slope").cast("decimal(18,6)"), 2).cast("double"))


_MONTHS = {4: "apr", 5: "may", 6: "june", 7: "july"}
_WIDE = "wide as (select site, " + ", ".join(
    f"sum(amount) filter (month = {m}) as {n}" for m, n in _MONTHS.items()) + \
    " from penalties group by site)"
_LONG = ("long as (select site, 1 as pos, 'apr' as name, apr as v from wide union all "
         "select site, 2, 'may', may from wide union all select site, 3, 'june', june from wide "
         "union all select site, 4, 'july', july from wide)")


def _site_months(spark: SparkSession, sf: str) -> DataFrame:
    return op.pivot_agg(b.penalties(spark, sf), ["site"], "month", _MONTHS, "amount", F.sum)


@query("row_statistics", with_views("penalties", f"""
    , {_WIDE}, {_LONG}
    select site, round(coalesce(sum(v), 0), 2) as total, round(avg(v), 4) as mean,
      round(min(v), 2) as lowest, round(max(v), 2) as highest,
      round(max(v) - min(v), 2) as spread, cast(count(*) - count(v) as int) as nulls,
      round(stddev_pop(v), 4) as std, round(case when avg(v) <> 0
      then stddev_pop(v) / avg(v) end, 4) as cv from long group by site"""))
def _(spark, sf):
    cols = list(_MONTHS.values())
    return _site_months(spark, sf).select(
        "site", F.round(row_sum(cols), 2).alias("total"), F.round(row_mean(cols), 4).alias("mean"),
        F.round(row_min(cols), 2).alias("lowest"), F.round(row_max(cols), 2).alias("highest"),
        F.round(row_range(cols), 2).alias("spread"), row_null_count(cols).alias("nulls"),
        F.round(row_std(cols), 4).alias("std"),
        ratio(row_std(cols), row_mean(cols), 4).alias("cv"))


@query("row_argmin", with_views("penalties", f"""
    , {_WIDE}, {_LONG}
    select site, arg_min(name, (v, pos)) filter (v is not null) as lowest_month,
      round(case when count(v) = 4 then regr_slope(v, pos) end, 2) as slope
    from long group by site"""))
def _(spark, sf):
    cols = list(_MONTHS.values())
    return _site_months(spark, sf).select("site", row_argmin(cols).alias("lowest_month"),
                                          F.round(row_slope(cols), 2).alias("slope"))


# ---- row sets --------------------------------------------------------------------------------

@query("union_different_columns", """
    select o_custkey as party, o_totalprice as amount, o_orderstatus as status,
      cast(null as varchar) as name from orders union all
    select c_custkey, c_acctbal, null, c_name from customer""")
def _(spark, sf):
    orders = b.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("party"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"))
    customers = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("party"), F.col("c_acctbal").alias("amount"),
        F.col("c_name").alias("name"))
    return op.union_all([orders, customers])


@query("drop_matching", with_views("tickets", """
    select event_id, closed_by from tickets where not coalesce(closed_by = 'System', false)"""))
def _(spark, sf):
    return op.drop_matching(b.tickets(spark, sf).select("event_id", "closed_by"),
                            F.col("closed_by") == "System")


@query("exclusive_classes", """
    with c as (select user_id, count(*) filter (event_type = 'error') as e,
      count(*) filter (event_type = 'signup') as s, count(*) as a from events group by user_id)
    select user_id, case when e >= 15 then 'errors' when e + s >= 30 then 'both'
      when a >= 60 then 'others' end as remark, case when e >= 15 then e
      when e + s >= 30 then e + s when a >= 60 then a end as count_7days
    from c where e >= 15 or e + s >= 30 or a >= 60""")
def _(spark, sf):
    counted = op.crosstab_counts(b.table(spark, sf, "events").withColumn("one", F.lit(1)),
                                 ["user_id"], "event_type", TYPES)
    e, s = F.col("error"), F.col("signup")
    every = e + s + F.col("click") + F.col("view") + F.col("purchase")
    return op.exclusive_classes(counted, "remark", [
        ("errors", e >= 15, e), ("both", e + s >= 30, e + s), ("others", every >= 60, every),
    ], "count_7days").select("user_id", "remark", "count_7days")


@query("top_rows", """
    select o_orderkey, o_custkey, o_totalprice from orders
    order by o_totalprice desc, o_orderkey limit 50""")
def _(spark, sf):
    return op.top_rows(
        b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        [F.desc("o_totalprice"), F.asc("o_orderkey")], 50)


@query("column_housekeeping", """
    select timestamp '2024-01-31' as as_of, event_id, user_id, 0 as missing, ts from events""")
def _(spark, sf):
    df = b.table(spark, sf, "events").select("event_id", "user_id", "ts").withColumn(
        "as_of", F.lit("2024-01-31").cast("timestamp_ntz"))
    return op.move_first(op.ensure_columns(df, {"missing": 0, "user_id": -1}), "as_of")


# ---- column functions ------------------------------------------------------------------------

@query("ages", with_views("tickets", f"""
    select event_id, {minutes('opened_on', 'closed_on')} as minutes,
      {minutes('closed_on', 'opened_on')} as minutes_back,
      cast(floor((epoch_us({ASOF_SQL}) - epoch_us(opened_on)) / 3600000000.0) as bigint)
        as hours, round(floor((epoch_us({ASOF_SQL}) - epoch_us(opened_on)) / 1000000.0) / 60.0, 2)
        as exact_minutes from tickets"""))
def _(spark, sf):
    now = F.lit(b.ASOF).cast("timestamp_ntz")
    return b.tickets(spark, sf).select(
        "event_id", minutes_between("opened_on", "closed_on").alias("minutes"),
        minutes_between("closed_on", "opened_on").alias("minutes_back"),
        hours_between("opened_on", now).alias("hours"),
        minutes_between_exact("opened_on", now).alias("exact_minutes"))


@query("clock_parts", """
    select event_id, strftime(ts, '%H:%M') as minute, strftime(ts, '%H') as hour,
      dayname(ts) as weekday, cast(month(ts) as int) as month, cast(ts as date) as day,
      case when hour(ts) <= 3 then '12AM~4AM' when hour(ts) <= 7 then '4AM~8AM'
        when hour(ts) <= 11 then '8AM~12PM' when hour(ts) <= 15 then '12PM~4PM'
        when hour(ts) <= 19 then '4PM~8PM' else '8PM~12AM' end as slot,
      greatest(timestamp '2024-01-10', least(ts, timestamp '2024-01-20')) as clamped
    from events""")
def _(spark, sf):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-20"))
    return b.table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "HH:mm").alias("minute"),
        F.date_format("ts", "HH").alias("hour"), F.date_format("ts", "EEEE").alias("weekday"),
        F.month("ts").alias("month"), F.to_date("ts").alias("day"), slot_label("ts").alias("slot"),
        clamp("ts", low, high).alias("clamped"))


@query("parsed_times", """
    select event_id, date_trunc('second', ts) as parsed, date_trunc('second', ts) as joined,
      cast(cast(ts as date) as timestamp) as by_pattern, cast(null as timestamp) as bad
    from events""")
def _(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return b.table(spark, sf, "events").select(
        "event_id", parse_time(text).alias("parsed"),
        combine_date_time(F.to_date("ts"), F.date_format("ts", "HH:mm:ss")).alias("joined"),
        parse_time(F.date_format("ts", "dd/MM/yyyy"), "dd/MM/yyyy").alias("by_pattern"),
        parse_time(F.concat(F.lit("no time "), text)).alias("bad"))


@query("text_functions", """
    select p_partkey, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) as title,
      replace(p_name, ' ', '') as squeezed, contains(lower(p_name), 'red') as red,
      lower(p_type) <> 'economy' as not_economy, substr(p_brand, 1, 2) as head,
      p_brand || '/' || p_type as joined, p_size > 25 as flag from part""")
def _(spark, sf):
    return b.table(spark, sf, "part").select(
        "p_partkey", title_case(F.concat(F.lit(" "), F.col("p_type"))).alias("title"),
        drop_blanks(F.col("p_name")).alias("squeezed"), contains(F.col("p_name"), "Red").alias(
            "red"), not_text(F.col("p_type"), "Economy", keep_null=False).alias("not_economy"),
        F.substring("p_brand", 1, 2).alias("head"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        text_flag(F.when(F.col("p_size") > 25, "True").otherwise("false")).alias("flag"))


@query("number_functions", """
    select o_orderkey, case when o_orderstatus = 'P' then 0.0 else o_totalprice end as amount,
      least(greatest(o_totalprice, 1000.0), 200000.0) as clipped,
      round(cbrt(o_totalprice * o_custkey), 4) as root from orders""")
def _(spark, sf):
    typed = F.when(F.col("o_orderstatus") == "P", "NA ").otherwise(
        F.col("o_totalprice").cast("string"))
    price = F.col("o_totalprice")
    return b.table(spark, sf, "orders").select(
        "o_orderkey", number_or_zero(typed).alias("amount"),
        clip(price, 1000.0, 200000.0).alias("clipped"),
        F.round(cube_root(price, F.col("o_custkey")), 4).alias("root"))


# ---- sources and sinks -----------------------------------------------------------------------

def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/sitepulse-{uuid.uuid4().hex}"


@query("scan_pushdown", """
    select l_orderkey, l_extendedprice from lineitem
    where l_shipdate >= timestamp '1998-01-01' and l_shipdate < timestamp '1999-01-01'""")
def _(spark, sf):
    return src.read_table(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_extendedprice"],
                          (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                          & (F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")))


@query("time_slices", """
    select 'day' as slice, count(*) as n from events where ts >= timestamp '2024-01-10'
      and ts < timestamp '2024-01-11' union all
    select 'closed', count(*) from orders where o_orderdate between timestamp '1996-01-01'
      and timestamp '1996-01-02' union all
    select 'month', count(*) from orders where o_orderdate >= timestamp '1996-02-01'
      and o_orderdate < timestamp '1996-03-01' union all
    select 'back', count(*) from events where ts >= timestamp '2024-01-28 12:00:00'""")
def _(spark, sf):
    events, orders = b.table(spark, sf, "events"), b.table(spark, sf, "orders")
    slices = {
        "day": src.day_slice(events, "ts", "2024-01-10", "2024-01-11"),
        "closed": src.day_slice(orders, "o_orderdate", "1996-01-01", "1996-01-02", closed=True),
        "month": src.month_slice(orders, "o_orderdate", "1996-02-01"),
        "back": src.look_back(events, "ts", b.ASOF, days=2, hours=12),
    }
    return op.union_all([df.agg(F.lit(name).alias("slice"), F.count("*").alias("n"))
                         for name, df in slices.items()])


@query("tenant_scope", with_views("sites", """
    select 'ALL' as banks, site_id from sites union all
    select 'two', site_id from sites where bank in ('BUILDING', 'MACHINERY') union all
    select 'one', site_id from sites where bank = 'FURNITURE'"""))
def _(spark, sf):
    sites = b.sites(spark, sf)
    scopes = {"ALL": ["All"], "two": ["BUILDING", "MACHINERY"], "one": "FURNITURE"}
    return op.union_all([src.scope(sites, banks).select(F.lit(n).alias("banks"), "site_id")
                         for n, banks in scopes.items()])


@query("active_sites", with_views("sites", """
    select site_id, site_name, bank from sites where on_site = 1 and bank <> 'HOUSEHOLD'"""))
def _(spark, sf):
    raw = b.sites(spark, sf).select(
        "site_id", "site_name", "bank", F.col("bank").alias("bank_code"),
        F.col("on_site").alias("status"), F.lit("True").alias("qStatus"))
    named = src.canonical_names(raw)
    customers = named.select("bank_code", "bank",
                             (F.col("bank") != "HOUSEHOLD").alias("active")).distinct()
    return op.active_sites(named, customers, drop_test=True).select("site_id", "site_name", "bank")


@query("json_records", """
    select cast(event_id as varchar) as event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S')
      as ts from events""")
def _(spark, sf):
    rows = src.json_records(b.table(spark, sf, "events").select("event_id", "event_type", "ts"))
    return rows.select(*[F.get_json_object("record", f"$.{c}").alias(c)
                         for c in ("event_id", "event_type", "ts")])


@query("replace_one_slice", """
    select o_orderkey, case when o_orderstatus = 'F' then 0.0 else o_totalprice end
      as o_totalprice, o_orderstatus from orders""")
def _(spark, sf):
    """Store by status, then replace one status only."""
    path = _folder(spark)
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    src.replace_slices(orders, path, ["o_orderstatus"])
    src.replace_slices(orders.filter("o_orderstatus = 'F'").withColumn(
        "o_totalprice", F.lit(0.0)), path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query("replace_whole_table", """
    select c_custkey, c_acctbal * 2 as c_acctbal from customer""")
def _(spark, sf):
    """The second version reads the first one."""
    path = _folder(spark)
    src.replace_table(b.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), path)
    first = src.current_version(spark, path)
    src.replace_table(first.withColumn("c_acctbal", F.col("c_acctbal") * 2), path)
    return src.current_version(spark, path)


@query("append_table", """
    select c_custkey, c_mktsegment from customer union all
    select s_suppkey, 'SUPPLIER' from supplier""")
def _(spark, sf):
    path = _folder(spark)
    src.append(b.table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), path)
    src.append(b.table(spark, sf, "supplier").select(
        F.lit("SUPPLIER").alias("c_mktsegment"), F.col("s_suppkey").alias("c_custkey")), path)
    return src.read_table(spark, path, schema="c_custkey bigint, c_mktsegment string")


@query("csv_sheets", """
    select 'orders' as sheet, cast(o_custkey as varchar) as site, cast(o_orderkey as varchar)
      as item from orders union all
    select 'parts', p_brand, p_name from part""")
def _(spark, sf):
    """A report written sheet by sheet, read back without header, headers promoted."""
    path = _folder(spark)
    src.write_sheets({
        "orders": b.table(spark, sf, "orders").select(
            F.col("o_custkey").cast("string").alias("site"),
            F.col("o_orderkey").cast("string").alias("item")),
        "parts": b.table(spark, sf, "part").select(F.col("p_brand").alias("site"),
                                                   F.col("p_name").alias("item")),
    }, path)
    raw = src.read_sheets(spark, {n: f"{path}/{n}" for n in ("orders", "parts")}, header=False)
    return op.union_all([
        src.drop_header_rows(src.promote_header(df, "site"), "item").select(
            F.lit(name).alias("sheet"), "site", "item") for name, df in raw.items()])


@query("csv_table", "select c_custkey, c_name, c_mktsegment from customer")
def _(spark, sf):
    """A table written as CSV with a header and read back."""
    path = _folder(spark)
    src.write_csv(b.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"),
                  path)
    return src.read_sheets(spark, {"t": path}, {
        "t": "c_custkey long, c_name string, c_mktsegment string"})["t"]


@query("ticket_changes", with_views("fault_tickets", f"""
    , open as (select * from fault_tickets where closed_on is null),
    newest as (select box_id, max(opened_on) as last_on from open group by box_id)
    select ticket_id, coalesce(closed_on, case when opened_on < last_on then {ASOF_SQL} end)
      as closed_on from fault_tickets left join newest using (box_id)"""))
def _(spark, sf):
    """Open tickets that are not the newest of their box are closed, all others stay."""
    tickets = b.fault_tickets(spark, sf).select("ticket_id", "box_id", "opened_on", "closed_on")
    older = op.superseded(tickets.filter("closed_on is null"), ["box_id"],
                          ["opened_on", "ticket_id"], "ticket_id")
    return src.apply_ticket_changes(tickets, b.ASOF, closed=older).select("ticket_id",
                                                                          "closed_on")


@query("ticket_touch", with_views("fault_tickets recorder_signals", """
    select ticket_id, closed_on, case when closed_on is null then coalesce(seen, opened_on)
      else opened_on end as latest_remote_recording
    from fault_tickets left join (select box_id, max(at_time) as seen from recorder_signals
      where event_code = 'REMOTERECORD' group by box_id) using (box_id)"""))
def _(spark, sf):
    """Open tickets take the latest remote recording of their box."""
    tickets = b.fault_tickets(spark, sf).select(
        "ticket_id", "box_id", "closed_on", F.col("opened_on").alias("latest_remote_recording"))
    seen = b.recorder_signals(spark, sf).filter("event_code = 'REMOTERECORD'").groupBy(
        "box_id").agg(F.max("at_time").alias("latest_remote_recording"))
    touched = tickets.filter("closed_on is null").select("ticket_id", "box_id").join(
        seen, "box_id")
    return src.apply_ticket_changes(tickets, b.ASOF, touched=touched).drop("box_id")


@query("customer_slice_replaced", """
    select c_custkey, case when c_mktsegment in ('BUILDING', 'FURNITURE') then -1.0
      else c_acctbal end as c_acctbal, c_mktsegment from customer
    where c_mktsegment <> 'FURNITURE'""")
def _(spark, sf):
    """Two customers are replaced; one of them has no new rows and ends up empty."""
    path = _folder(spark)
    customer = b.table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    src.replace_table(customer, path)
    scope = customer.filter("c_mktsegment in ('BUILDING', 'FURNITURE')")
    fresh = customer.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(-1.0))
    src.replace_customers(fresh, path, scope, key="c_mktsegment")
    return src.current_version(spark, path)


@query("customer_buckets_replaced", CHECKS["customer_slice_replaced"])
def _(spark, sf):
    """The same replacement on a table in buckets, where only two buckets are written again."""
    customer = b.table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    table = src.KeyedTable(spark, _folder(spark), ["c_mktsegment"], 16)
    table.replace_keys(customer, customer)
    scope = customer.filter("c_mktsegment in ('BUILDING', 'FURNITURE')")
    fresh = customer.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(-1.0))
    table.replace_keys(fresh, scope)
    return table.read()


@query("day_parts_replaced", """
    select event_id, event_type, cast(ts as date) as date,
      case when cast(ts as date) = date '2024-01-07' then -value else value end as value
    from events where cast(ts as date) <> date '2024-01-08'""")
def _(spark, sf):
    """A daily table in which one day is replaced and another one becomes empty."""
    events = b.table(spark, sf, "events").select("event_id", "event_type", "value",
                                                 F.to_date("ts").alias("date"))
    days = [f"2024-01-{d:02d}" for d in range(1, 32)]
    table = src.PartTable(spark, _folder(spark), "date")
    table.replace(events, days)
    table.replace(events.filter("date = date'2024-01-07'").withColumn("value", -F.col("value")),
                  days[6:8])
    return table.read()


@query("ticket_buckets_changed", with_views("fault_tickets", f"""
    select ticket_id, box_id, error, opened_on, case when closed_on is null and error = 'EIO'
      then timestamp '{b.ASOF}' else closed_on end as closed_on,
      case when error = 'ENODR' and closed_on is null then opened_on + interval 1 hour end
      as latest_remote_recording from fault_tickets
    union all select null, c_custkey, 'NEW', timestamp '{b.ASOF}', null, null from customer
    where c_custkey < 20"""))
def _(spark, sf):
    """Tickets in buckets: close one kind, touch another, open new ones (numbered by the table)."""
    known = b.fault_tickets(spark, sf).select("ticket_id", "box_id", "error", "opened_on", "closed_on",
                                              F.lit(None).cast("timestamp_ntz").alias(
                                                  "latest_remote_recording"))
    table = src.TicketTable(spark, _folder(spark), known.schema)
    table.begin(known)
    now = table.open()
    later = F.col("opened_on") + F.expr("interval 1 hour")
    opened = b.table(spark, sf, "customer").filter("c_custkey < 20").select(
        F.col("c_custkey").alias("box_id"), F.lit("NEW").alias("error"),
        F.lit(b.ASOF).cast("timestamp_ntz").alias("opened_on"),
        F.lit(None).cast("timestamp_ntz").alias("closed_on"))
    table.apply(b.ASOF, closed=now.filter("error = 'EIO'").select("ticket_id"), opened=opened,
                touched=now.filter("error = 'ENODR'").select(
                    "ticket_id", later.alias("latest_remote_recording")))
    out = table.read()
    # Which new row gets which new number depends on its hash.
    return out.withColumn("ticket_id", F.when(F.col("error") != "NEW", F.col("ticket_id")))
