"""Sites that go offline at the same time of day again and again."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.functions import days_before
from sitepulse.operators import anti, dedupe

HORIZONS = (3, 7, 15)
COUNTS = ["count_3days", "count_7days", "count_15days"]

# Hours in which a site may go off and come back over night. "24" never occurs on
# the clock and is kept as the published rule has it.
OFF_HOURS = ["16", "17", "18", "19", "20", "21", "22", "23", "24", "01"]
ON_HOURS = ["06", "07", "08", "09", "10"]


@dataclass(frozen=True)
class Thresholds:
    """Least counts in the last 3, 7 and 15 days."""

    pattern: tuple[int, int, int] = (2, 5, 10)
    total: tuple[int, int, int] = (5, 10, 20)
    night: tuple[int, int, int] = (1, 2, 7)


STRICT_NIGHT = (2, 4, 8)


def outage_base(episodes: DataFrame, asof, horizon: int = HORIZONS[-1]) -> DataFrame:
    """Closed episodes of the longest look-back, repeats removed."""
    today = days_before(asof, 0, whole_days=True)
    kept = episodes.filter(
        (F.col("at_time") >= days_before(asof, horizon, whole_days=True))
        & (F.col("at_time") <= today) & (F.col("closed_on") < today))
    return dedupe(kept, ["site_id", "msg", "at_time"], ["event_id"])


def _clock_table(base: DataFrame, asof) -> DataFrame:
    """Counts per site and pair of clock minutes: all later groupings add these rows up."""
    recent = {days: days_before(asof, days, whole_days=True) for days in HORIZONS[:2]}
    return base.groupBy(
        "site_id", F.date_format("at_time", "HH:mm").alias("off"),
        F.date_format("closed_on", "HH:mm").alias("on"),
    ).agg(
        *[F.count_if(F.col("at_time") >= low).alias(f"off{days}")
          for days, low in recent.items()],
        *[F.count_if(F.col("closed_on") >= low).alias(f"on{days}")
          for days, low in recent.items()],
        F.count(F.lit(1)).alias("all15"))


def _grouped(clock: DataFrame) -> DataFrame:
    """One row per site and key of every kind of pattern, from one pass over the clock table."""
    none = F.lit(None).cast("string")
    off, on = F.col("off"), F.col("on")
    off_hour, on_hour = F.substring("off", 1, 2), F.substring("on", 1, 2)

    def kind(name: str, unit: str, off_key: Column, on_key: Column, by: str) -> Column:
        return F.struct(F.lit(name).alias("remark"), F.lit(unit).alias("unit"),
                        off_key.alias("time_offline"), on_key.alias("time_online"),
                        F.col(f"{by}3").alias("c3"), F.col(f"{by}7").alias("c7"))

    kinds = F.explode(F.array(
        kind("Offline-Online", "minute", off, on, "off"),
        kind("Offline", "minute", off, none, "off"), kind("Online", "minute", none, on, "on"),
        kind("Offline-Online", "hour", off_hour, on_hour, "off"),
        kind("Offline", "hour", off_hour, none, "off"),
        kind("Online", "hour", none, on_hour, "on"),
        kind("TotalTickets", "site", none, none, "off")))
    wide = clock.select("site_id", kinds.alias("k"), "all15").select("site_id", "k.*", "all15")
    return wide.groupBy("site_id", "remark", "unit", "time_offline", "time_online").agg(
        F.sum("c3").alias(COUNTS[0]), F.sum("c7").alias(COUNTS[1]),
        F.sum("all15").alias(COUNTS[2]))


def _reach(thresholds: Sequence[int]) -> Column:
    cond = F.lit(True)
    for name, least in zip(COUNTS, thresholds):
        cond = cond & (F.col(name) >= least)
    return cond


def _exists(test: Column, *by: str) -> Column:
    """Does any row with the same values in ``by`` pass the test?"""
    return F.coalesce(F.max(test).over(Window.partitionBy(*by)), F.lit(False))


def all_patterns(base: DataFrame, asof, limits: Thresholds = Thresholds()) -> DataFrame:
    """``patterns_of`` the closed episodes of the look-back (``outage_base``)."""
    return patterns_of(_clock_table(base, asof), limits)


def patterns_of(clock: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Patterns per site after the precedence rules, plus the rows of too frequent sites.

    Precedence: a pair of times wins over one of its times; a minute wins over its hour; a pair
    of hours displaces single minutes of the site and a pair of minutes its single hours; a site
    with too many tickets in total shows only as such. A site has at most one row per pair of
    clock minutes here, whatever the number of its tickets, so the per-site windows are bounded.
    """
    found = _grouped(clock).filter(
        F.when(F.col("remark") == "TotalTickets", _reach(limits.total))
        .otherwise(_reach(limits.pattern)))
    # One exchange by site serves every window below.
    rows = found.repartition("site_id")
    pair, single_off, single_on = (F.col("remark") == name
                                   for name in ("Offline-Online", "Offline", "Online"))
    minute, hour = F.col("unit") == "minute", F.col("unit") == "hour"
    rows = rows.withColumns({
        "_off_in_pair": _exists(pair, "site_id", "unit", "time_offline"),
        "_on_in_pair": _exists(pair, "site_id", "unit", "time_online"),
    }).filter(~((single_off & F.col("_off_in_pair")) | (single_on & F.col("_on_in_pair"))))
    rows = rows.withColumns({
        "_off_hour": F.substring("time_offline", 1, 2),
        "_on_hour": F.substring("time_online", 1, 2)})
    rows = rows.withColumn("_finer", _exists(minute, "site_id", "remark", "_off_hour", "_on_hour"))
    rows = rows.filter(~(hour & F.col("_finer")))
    rows = rows.withColumns({
        "_hour_pair": _exists(pair & hour, "site_id"),
        "_minute_pair": _exists(pair & minute, "site_id"),
        "_busy": _exists(F.col("remark") == "TotalTickets", "site_id")})
    single = single_off | single_on
    kept = rows.filter(
        (F.col("remark") == "TotalTickets")
        | (~F.col("_busy") & ~(single & minute & F.col("_hour_pair"))
           & ~(single & hour & F.col("_minute_pair"))))
    return kept.select("site_id", "time_offline", "time_online", *COUNTS, "remark")


def _with_site(rows: DataFrame, sites: DataFrame, asof) -> DataFrame:
    day = F.to_date(days_before(asof, 0, whole_days=True)).alias("date")
    return (rows.join(sites.select("site_id", "site_name", "bank"), "site_id")
            .select(day, "bank", "site_name", "site_id",
                    *[c for c in rows.columns if c != "site_id"]))


def recurring_patterns(patterns: DataFrame, sites: DataFrame, asof) -> DataFrame:
    return _with_site(patterns.filter("remark != 'TotalTickets'"), sites, asof)


def frequent_sites(patterns: DataFrame, sites: DataFrame, asof) -> DataFrame:
    """Sites with many tickets, whatever the time of day."""
    return _with_site(patterns.filter("remark = 'TotalTickets'")
                      .drop("time_offline", "time_online"), sites, asof)


def business_hour_outages(base: DataFrame, patterns: DataFrame, sites: DataFrame, asof,
                          limits: tuple[int, int, int] = Thresholds.night, *,
                          on_site_only: bool = True) -> DataFrame:
    """Sites off in the evening and back in the morning that show no finer pattern."""
    return night_outages(_clock_table(base, asof), patterns, sites, asof, limits,
                         on_site_only=on_site_only)


def night_outages(clock: DataFrame, patterns: DataFrame, sites: DataFrame, asof,
                  limits: tuple[int, int, int] = Thresholds.night, *,
                  on_site_only: bool = True) -> DataFrame:
    """``business_hour_outages`` from the clock table."""
    night = clock.filter(F.substring("off", 1, 2).isin(OFF_HOURS)
                         & F.substring("on", 1, 2).isin(ON_HOURS))
    counted = night.groupBy("site_id").agg(
        F.sum("off3").alias(COUNTS[0]), F.sum("off7").alias(COUNTS[1]),
        F.sum("all15").alias(COUNTS[2])).filter(_reach(limits))
    members = sites.filter("on_site = 1") if on_site_only else sites
    rows = anti(counted, patterns, ["site_id"]).withColumn(
        "remark", F.lit("Business hour sites"))
    return _with_site(rows, members, asof)


# ---- kept from day to day -----------------------------------------------------------------------

EPISODE = ["site_id", "msg", "at_time"]


def counting_rows(episodes: DataFrame) -> DataFrame:
    """Closed episodes with the first day whose look-back counts them (``counts_from``): the day after
    they closed, and not before the midnight that follows their start."""
    at_day, closed_day = F.to_date("at_time"), F.to_date("closed_on")
    begun = F.when(F.col("at_time") == at_day.cast("timestamp_ntz"), at_day).otherwise(
        F.date_add(at_day, 1))
    return episodes.filter("at_time is not null and closed_on is not null").select(
        *EPISODE, "event_id", "closed_on", at_day.alias("at_day"),
        F.greatest(F.date_add(closed_day, 1), begun).alias("counts_from"))


def counted_once(rows: DataFrame) -> DataFrame:
    """Which of repeated episodes counts from which day on: the smallest ``event_id`` so far.

    A row that takes the place of another one from a later day on brings ``replaces`` (that row's
    closing time).
    """
    so_far = Window.partitionBy(*EPISODE).orderBy("counts_from", "event_id")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    smaller = rows.withColumn("_least", F.min("event_id").over(before)).filter(
        "_least is null or event_id < _least").drop("_least")
    return smaller.withColumn("replaces", F.lag("closed_on").over(so_far))


def clock_changes(counted: DataFrame) -> DataFrame:
    """Clock-minute counts by site and days, with the rows that others replaced taken off again."""
    kinds = F.explode(F.array(
        F.struct(F.col("closed_on").alias("closed"), F.lit(1).alias("n")),
        F.struct(F.col("replaces").alias("closed"), F.lit(-1).alias("n"))))
    rows = counted.withColumn("_k", kinds).filter("_k.closed is not null")
    return rows.groupBy(
        "counts_from", "at_day", F.to_date("_k.closed").alias("closed_day"), "site_id",
        F.date_format("at_time", "HH:mm").alias("off"),
        F.date_format("_k.closed", "HH:mm").alias("on")).agg(F.sum("_k.n").alias("n"))


def kept_clock(changes: DataFrame, asof) -> DataFrame:
    """The clock table of a day from the stored changes of its look-back."""
    today = F.to_date(days_before(asof, 0, whole_days=True))

    def since(column: str, days: int) -> Column:
        return F.col(column) >= F.date_sub(today, days)

    recent = changes.filter((F.col("counts_from") <= today) & since("at_day", HORIZONS[-1]))
    sums = [F.sum(F.when(since(day, days), F.col("n")).otherwise(0)).alias(f"{by}{days}")
            for by, day in (("off", "at_day"), ("on", "closed_day")) for days in HORIZONS[:2]]
    return recent.groupBy("site_id", "off", "on").agg(
        *sums, F.sum("n").alias("all15")).filter("all15 > 0")
