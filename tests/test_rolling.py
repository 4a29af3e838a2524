"""Reports kept from day to day against the same reports computed from all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sitepulse import bindings as b
from sitepulse import runs
from sitepulse import streaming as st
from sitepulse.plans import outages, repeats, rolling
from tests.conftest import SF, rows, t
from tests.test_streams import feed

LOW = outages.Thresholds(pattern=(1, 1, 2), total=(20, 40, 90), night=(0, 0, 1))


def _episodes(spark):
    """Few sites and clock minutes, repeats with other closing days, open rows, odd durations."""
    rng = random.Random(9)
    made = []
    for i in range(900):
        at = datetime(2024, 1, 1) + timedelta(days=rng.randint(0, 28), hours=rng.choice([0, 1, 9, 17, 23]),
                                              minutes=rng.choice([0, 0, 30]))
        closed = at + timedelta(minutes=rng.choice([-90, 0, 25, 600, 1500, 6000]))
        site = rng.choice(["a", "b", "c", None]) if i % 7 else "busy"
        made.append((i, site, "off", at, None if i % 31 == 0 else closed))
        if i % 5 == 0:  # the same episode again, with another id and closing time
            made.append((5000 - i, site, "off", at, closed + timedelta(days=rng.choice([-3, 0, 1, 4]))))
    return spark.createDataFrame(
        made, "event_id long, site_id string, msg string, at_time timestamp_ntz, closed_on timestamp_ntz")


def test_kept_outages_are_the_batch_report_on_twenty_days(spark, tmp_path):
    store = runs.Store(spark, str(tmp_path / "s"))
    tickets = _episodes(spark)
    tickets.write.parquet(store.path("tickets"))
    tickets = store.read("tickets")
    sites = spark.createDataFrame([(s, f"site {s}", "bank", s == "a") for s in ("a", "b", "c", "busy")],
                                  "site_id string, site_name string, bank string, flag boolean").select(
        "site_id", "site_name", "bank", F.col("flag").cast("int").alias("on_site"))
    sites.write.parquet(store.path("sites"))
    runs.outage_load(store, "2023-12-25", "2024-01-14", ["off"])
    seen = set()
    for day in range(15, 35):
        asof = str(datetime(2024, 1, 1) + timedelta(days=day - 1, hours=day % 24))
        runs.outage_add_day(store, asof[:10], ["off"])
        if day == 20:
            runs.outage_add_day(store, asof[:10], ["off"])  # the same day again
        base = outages.outage_base(tickets, asof)
        found = outages.all_patterns(base, asof, LOW)
        batch = (outages.recurring_patterns(found, sites, asof)
                 .unionByName(outages.frequent_sites(found, sites, asof), allowMissingColumns=True)
                 .unionByName(outages.business_hour_outages(base, found, sites, asof, LOW.night),
                              allowMissingColumns=True))
        kept = runs.kept_outages(store, asof, LOW)
        assert rows(kept, *batch.columns) == rows(batch), asof
        seen |= {r["remark"] for r in batch.collect()}
    assert len(seen) >= 3, seen
    # A day writes its own part and reads its tickets with a filter.
    assert runs._clock_changes(store).read(["2024-01-20"]).select("counts_from").distinct().count() == 1


def test_rolling_distinct_counts(spark):
    df = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 12).cast("int")).alias("d"),
        F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("user"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("x").alias("k"))
    daily = rolling.distinct_sketches(df, F.col("d"), ["k"], "user")
    assert daily.agg(F.max(F.length("sketch"))).first()[0] < 10_000
    estimate = {(r["day"], r["k"]): r["estimate"] for r in rolling.rolling_distinct(daily, ["k"], 7).collect()}
    exact = {}
    for r in rolling.rolling_distinct_exact(df, F.col("d"), ["k"], "user", 7).collect():
        exact[r["day"], r["k"]] = r["exact"]
        low = datetime.combine(r["day"], datetime.min.time()) - timedelta(days=6)
        assert r["exact"] == df.filter((F.col("d") >= F.lit(low.date())) & (F.col("d") <= F.lit(r["day"]))
                                       & (F.col("k") == r["k"])).select("user").distinct().count()
    assert set(estimate) == set(exact) and len(exact) > 20
    assert all(abs(estimate[x] - n) <= max(1, 3 * 1.04 / 64 * n) for x, n in exact.items())


def test_profile_of_days(spark):
    df = spark.range(50_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 31).cast("int")).alias("d"),
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, 5.0).otherwise(
            F.pow(F.rand(4), 3) * 1000).alias("v"), F.lit(None).cast("double").alias("none"))
    daily = rolling.daily_profiles(df, F.col("d"), ["v", "none"])
    assert daily.count() == 62 and daily.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    shares = {"q01": 0.01, "q25": 0.25, "median": 0.5, "q99": 0.99}
    profile = rolling.merged_profile(daily, shares)
    got = {r["column"]: r for r in profile.collect()}
    assert got["none"]["median"] is None and got["none"]["nulls"] == got["none"]["rows"] == 50_000
    exact = df.agg(F.avg("v"), F.stddev("v"), F.min("v"), F.max("v")).first()
    assert [got["v"][c] for c in ("mean", "std", "smallest", "largest")] == pytest.approx(list(exact))
    errors = {r["column"]: r for r in rolling.rank_errors(df, profile, ["v", "none"], shares).collect()}
    assert set(errors) == {"v"} and all(errors["v"][q] <= 3 / rolling.QUANTILE_K for q in shares)


@pytest.mark.parametrize("counters", [1, 16, 512])
def test_frequent_keys_whatever_the_number_of_counters(spark, counters):
    faults = b.fault_tickets(spark, SF)
    day = F.to_date("opened_on")
    daily = rolling.daily_counters(faults, day, rolling.camera_keys(faults), counters)
    assert daily.groupBy("day").count().agg(F.max("count")).first()[0] <= 2 * counters
    week = daily.filter((F.col("day") >= F.lit("2024-01-24").cast("date")))
    got = rolling.repeated_camera_faults(faults, week, b.ASOF, counters=counters)
    assert rows(got) == rows(repeats.repeated_camera_faults(faults, b.ASOF)) and not got.isEmpty()


def test_late_rows_count_in_their_slots(spark, tmp_path):
    """Rows behind the watermark go to the side table, the newest slots are there, replays change nothing."""
    batches = ([("a", "01 01:00"), ("a", "01 03:59:59")], [("a", "01 09:30"), ("b", "01 04:00")],
               [("b", "01 09:31")], [("a", "01 02:00"), ("a", "01 20:00"), (None, "01 02:00")])
    path = str(tmp_path / "out")
    handle = st.slot_handler(spark, path, "ts", ["k"], fold=3)
    st.run_batches(feed(spark, tmp_path / "in", *batches), str(tmp_path / "run"), handle)

    def totals():
        return rows(st.slot_totals(spark, path, ["k"]).select("k", F.date_format("slot_start", "HH"), "signals"))

    wanted = [(None, "00", 1), ("a", "00", 3), ("a", "08", 1), ("a", "20", 1), ("b", "04", 1), ("b", "08", 1)]
    assert totals() == wanted
    late = st.late_counts(spark, path)
    assert rows(late.select("k", F.date_format("slot_start", "HH"), "signals", "v")) == [
        (None, "00", 1, 3), ("a", "00", 1, 3)]
    last = spark.createDataFrame([(k, t(at)) for k, at in batches[3]], "k string, ts timestamp_ntz")
    handle(last, 3)
    assert totals() == wanted
