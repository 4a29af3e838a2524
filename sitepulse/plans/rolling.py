"""Rolling reports from small daily summaries that merge: distinct counts, quantiles, frequent keys.

A day is summarised once. A week or a month is the merger of its days, so no row is read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import as_of
from sitepulse.plans.repeats import CAMERA_NAMES, SITE
from sitepulse.sources.readers import look_back

LG_K = 12
QUANTILE_K = 400
COUNTERS = 1 << 16


# ---- distinct counts ----------------------------------------------------------------------------

def distinct_sketches(df: DataFrame, day: Column, keys: Sequence[str], value: str,
                      lg_k: int = LG_K) -> DataFrame:
    """Per day and key a HyperLogLog sketch of the values (some KB, whatever their number)."""
    return df.groupBy(day.alias("day"), *keys).agg(
        F.hll_sketch_agg(F.col(value), F.lit(lg_k)).alias("sketch"))


def _in_windows(daily: DataFrame, days: int) -> DataFrame:
    """Each daily row once for every window of ``days`` days that holds it; ``day`` is the last day of
    the window, and windows end on days up to the last one there is."""
    last = daily.agg(F.max("day")).scalar()
    ends = F.sequence(F.col("day"), F.least(F.date_add("day", days - 1), last))
    return daily.withColumn("day", F.explode(ends))


def rolling_distinct(sketches: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """day, keys, estimate: different values in the ``days`` days up to each day."""
    return _in_windows(sketches, days).groupBy("day", *keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def distinct_bound(exact: Column, lg_k: int = LG_K) -> Column:
    """Largest error to expect: three standard errors of the sketch, at least 1."""
    return F.greatest(F.lit(1.0), exact * (3 * 1.04 / 2 ** (lg_k / 2)))


def rolling_distinct_exact(df: DataFrame, day: Column, keys: Sequence[str], value: str,
                           days: int) -> DataFrame:
    """day, keys, exact: the same from distinct (day, key, value) rows."""
    daily = df.select(day.alias("day"), *keys, value).distinct()
    return _in_windows(daily, days).groupBy("day", *keys).agg(
        F.countDistinct(value).alias("exact"))


# ---- profiles -----------------------------------------------------------------------------------

def daily_profiles(df: DataFrame, day: Column, columns: Sequence[str],
                   k: int = QUANTILE_K) -> DataFrame:
    """Per day and column: rows, nulls, sums, extremes, and a quantile sketch of bounded size."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias(
        "v")) for c in columns]))
    return df.select(day.alias("day"), cells.alias("c")).select("day", "c.*").groupBy(
        "day", "column").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("v").isNull()).alias("nulls"),
            F.sum("v").alias("total"), F.sum(F.col("v") * F.col("v")).alias("squares"),
            F.min("v").alias("smallest"), F.max("v").alias("largest"),
            F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))


def merged_profile(daily: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """One row per column from the daily rows given: the profile of the whole time, with quantiles
    whose rank is right to about 3 / k."""
    merged = daily.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("total").alias("_t"),
        F.sum("squares").alias("_s"), F.min("smallest").alias("smallest"),
        F.max("largest").alias("largest"), F.kll_merge_agg_double("sketch").alias("_k"))
    n = F.col("rows") - F.col("nulls")
    spread = F.greatest(F.col("_s") - F.col("_t") * F.col("_t") / n, F.lit(0.0))
    return merged.select(
        "column", "rows", "nulls", F.when(n > 0, F.col("_t") / n).alias("mean"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std"), "smallest", "largest",
        *[F.when(n > 0, F.kll_sketch_get_quantile_double("_k", F.lit(share))).alias(name)
          for name, share in shares.items()])


def rank_errors(df: DataFrame, profile: DataFrame, columns: Sequence[str],
                shares: Mapping[str, float]) -> DataFrame:
    """column and one number per quantile: how far its rank among all rows is from its share."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias(
        "v")) for c in columns]))
    values = df.select(cells.alias("c")).select("c.*").filter("v is not null")
    found = values.join(F.broadcast(profile.select("column", *shares)), "column")

    def error(name: str, share: float) -> Column:
        below = F.avg((F.col("v") < F.col(name)).cast("int"))
        upto = F.avg((F.col("v") <= F.col(name)).cast("int"))
        return F.greatest(below - share, share - upto, F.lit(0.0)).alias(name)

    return found.groupBy("column").agg(*[error(n, s) for n, s in shares.items()])


# ---- frequent keys ------------------------------------------------------------------------------

def _counter(keys: Sequence[str], row: int, counters: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), *keys), F.lit(counters))


def daily_counters(tickets: DataFrame, day: Column, keys: Sequence[str],
                   counters: int = COUNTERS) -> DataFrame:
    """Per day two rows of ``counters`` counters; each key adds to one counter of either row.

    A summary never grows beyond 2 x ``counters`` rows a day, however many keys there are.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("row"), _counter(keys, r, counters).alias(
        "counter")) for r in range(2)]))
    return tickets.select(day.alias("day"), cells.alias("c")).select("day", "c.*").groupBy(
        "day", "row", "counter").agg(F.count(F.lit(1)).alias("n"))


def frequent_keys(tickets: DataFrame, daily: DataFrame, keys: Sequence[str], at_least: int,
                  counters: int = COUNTERS) -> DataFrame:
    """keys, count: every key with ``at_least`` rows in ``tickets``, whose days ``daily`` sums up.

    A counter is at least as high as the count of each of its keys, so a key with a low counter in
    either row is out at once. What is left is counted exactly.
    """
    high = daily.groupBy("row", "counter").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= at_least)
    kept = tickets
    for r in range(2):
        # 16 bytes a counter at most, so the broadcast is bounded by ``counters``.
        names = F.broadcast(high.filter(F.col("row") == r).select(F.col("counter").alias("_c")))
        kept = kept.withColumn("_c", _counter(keys, r, counters)).join(
            names, "_c", "left_semi").drop("_c")
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(
        F.col("count") >= at_least)


def repeated_camera_faults(tickets: DataFrame, daily: DataFrame, asof, *, days: int = 7,
                           at_least: int = 3, names: Sequence[str] = CAMERA_NAMES,
                           counters: int = COUNTERS) -> DataFrame:
    """The weekly report from the daily counters of ``camera_keys`` and one pass over the tickets of
    frequent keys. ``daily`` holds the days the look-back touches."""
    keys = camera_keys(tickets)
    recent = look_back(tickets, "opened_on", asof, days=days).filter(
        F.col("camera_name").isin(list(names)))
    found = frequent_keys(recent, daily, keys, at_least, counters)
    return found.select(F.to_date(as_of(asof)).alias("date"), *keys[:-1],
                        F.col("count").alias("count_7days"),
                        F.col("camera_name").alias("remark"))


def camera_keys(tickets: DataFrame) -> list[str]:
    return [*[c for c in SITE if c in tickets.columns], "camera_name"]
