"""Penalties: tickets that cost money, consolidation of the feeds, trend per site."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.functions import (
    contains, cut, first_match, minutes_between, not_text, number_or_zero, ratio, recode, row_slope,
    row_std, row_sum,
)
from sitepulse.operators import pivot_agg, union_all
from sitepulse.sources.readers import month_slice

# Months of the trend report and the bands of mean, regularity and trend.
TREND_MONTHS = {4: "Apr", 5: "May", 6: "June", 7: "July"}
MEAN_EDGES = [0, 99, 199, 499, 999, 1999, 2999, 4999, 9999, 19999,
              float("inf")]
MEAN_BANDS = ["<100", "100-200", "200-500", "500-1000", "1000-2000", "2000-3000", "3000-5000",
              "5000-10000", "10000-20000", ">20000"]
REGULARITY_EDGES = [-1, 0.05, 0.5, 1, 1.5, 2]
REGULARITY = ["Very Regular", "Regular", "Tolerant", "Irregular", "Very Irregular"]


def penalty_tickets(tickets: DataFrame, remarks: DataFrame, sites: DataFrame,
                    month: str | None = None) -> DataFrame:
    """Ticket x remark rows of a month (or of all months) that carry a penalty."""
    if month is not None:
        tickets = month_slice(tickets, "opened_on", month)
        remarks = month_slice(remarks, "updated_on", month)
    fit = remarks.filter(contains(F.col("remarks"), "working")
                         & ~contains(F.col("remarks"), "closed"))
    fit = fit.select("event_id", "updated_by", "updated_on",
                     F.lower("remarks").alias("remarks")).distinct()
    # Copies go before the join, so they are neither multiplied nor gathered in one task.
    open_to = tickets.filter(
        F.col("active") & not_text(F.col("closed_by"), "system", keep_null=True)).select(
        "event_id", "site_id", "event_type", "msg", "opened_on", "closed_on").distinct()
    names = sites.select("site_id", "site_name").distinct()
    joined = open_to.join(fit, "event_id").join(names, "site_id")
    aged = joined.withColumns({"age": minutes_between("opened_on", "closed_on"),
                               "ack_age": minutes_between("opened_on", "updated_on")})
    late = (((F.col("event_type") == "SOS") & ((F.col("age") > 30) | (F.col("ack_age") > 5)))
            | ((F.col("event_type") == "Critical")
               & ((F.col("age") > 60) | (F.col("ack_age") > 10))))
    return aged.filter(late).select(
        "event_id", "site_id", "site_name", "event_type", "msg", "opened_on", "closed_on",
        "updated_by", "updated_on", "remarks", "age", "ack_age",
        F.lit("Penalty Applicable").alias("penalty"))


def consolidate_rows(stacked: DataFrame, feeds: Sequence[str], *,
                     drop_months: Sequence[int] = ()) -> DataFrame:
    """Rows of (site, month, amount, feed) as one column per feed and a total."""
    summed = (stacked.filter(F.col("feed").isin(list(feeds))
                             & ~F.col("month").isin(list(drop_months)))
              .dropna(subset=["site", "month"]).groupBy("site", "month").agg(*[
                  F.coalesce(F.sum(F.when(F.col("feed") == name, F.col("amount"))), F.lit(0.0))
                  .alias(name) for name in feeds]))
    return summed.withColumn("total", row_sum(list(feeds)))


def consolidate(feeds: Mapping[str, DataFrame], *,
                drop_months: Sequence[int] = ()) -> DataFrame:
    """Feeds of (site, month, amount) side by side per site and month, with the total."""
    stacked = union_all([df.select("site", "month", F.col("amount").cast("double"),
                                   F.lit(name).alias("feed")) for name, df in feeds.items()])
    return consolidate_rows(stacked, list(feeds), drop_months=drop_months)


def month_names(df: DataFrame, names: Mapping[int, str] = TREND_MONTHS) -> DataFrame:
    """Month numbers as text, the listed ones by name."""
    text = {str(number): name for number, name in names.items()}
    return df.withColumn("month", recode(F.col("month").cast("string"), text))


def item_matrix(penalties: DataFrame, items: Mapping[str, str]) -> DataFrame:
    """Sum per site, month and item, with the total of the listed items."""
    wide = pivot_agg(penalties, ["site", "month"], "item", items, "amount",
                     lambda c: F.coalesce(F.sum(c), F.lit(0.0)))
    return wide.withColumn("total", row_sum(list(items.values())))


def penalty_trend(penalties: DataFrame, months: Mapping[int, str] = TREND_MONTHS) -> DataFrame:
    """Size, regularity and direction of a site's penalties over consecutive months.

    ``amount`` may be text with placeholders. Sites without any penalty are left out.
    """
    names = list(months.values())
    amount = (F.col("amount") if dict(penalties.dtypes)["amount"] != "string"
              else number_or_zero(F.col("amount")))
    wide = pivot_agg(
        penalties.filter(F.col("month").isin(list(months))).withColumn("amount", amount),
        ["site"], "month", months, "amount", lambda c: F.coalesce(F.sum(c), F.lit(0.0)))
    rated = (wide.withColumn("total", row_sum(names)).filter("total != 0")
             .withColumns({"mean": F.col("total") / len(names),
                           "std": F.round(row_std(names), 2),
                           "slope": F.round(row_slope(names), 2)})
             .withColumn("cv", ratio(F.col("std"), F.col("mean"))))
    cv, rising, falling = F.col("cv"), F.col("slope") > 0, F.col("slope") < 0
    flat = (cv >= -0.05) & (cv <= 0.05)
    mild = ~flat & (cv >= -0.5) & (cv < 0.5)
    steep = (cv < -0.5) | (cv >= 0.5)
    return rated.withColumns({
        "bucket": cut(F.col("mean"), MEAN_EDGES, MEAN_BANDS),
        "regularity": cut(cv, REGULARITY_EDGES, REGULARITY),
        "trend": first_match([(flat, "Stable"), (mild & rising, "Increasing"),
                              (mild & falling, "Decreasing"), (steep & rising, "Agg Increasing"),
                              (steep & falling, "Agg Decreasing")]),
    })
