"""All jobs on stored tables, end to end, and again."""

import json

import pytest
from pyspark.sql import functions as F

from sitepulse import bindings as b
from sitepulse import runs
from sitepulse.sources import replace_table
from tests.conftest import SF, rows

DAY, NOW = "2024-01-29", "2024-01-30 00:00:00"
SENSORS = {"Lobby Movement Sensor": "motion", "Main Door Sensor": "door"}
CAMERAS = {"LobbyCamera": "lobby", "OutdoorCamera": "outdoor"}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = runs.Store(spark, str(tmp_path_factory.mktemp("store")))
    tables = {
        "sites": b.sites(spark, SF), "tickets": b.tickets(spark, SF).drop("ack_on", "k"),
        "remarks": b.remarks(spark, SF), "installed_items": b.installed_items(spark, SF),
        "sensor_signals": b.sensor_signals(spark, SF), "event_dictionary": b.dictionary(spark, SF),
        "recording_counts": b.recordings(spark, SF), "cameras": b.cameras(spark, SF),
        "heartbeats": b.heartbeats(spark, SF), "disk_status": b.disk_status(spark, SF),
        "recorder_signals": b.recorder_signals(spark, SF),
        "motion_events": b.door_events(spark, SF, "purchase"),
        "door_events": b.door_events(spark, SF, "click"),
    }
    for name, df in tables.items():
        df.write.parquet(made.path(name))
    return made


def test_daily_tables_are_replaced_not_doubled(store):
    for _ in range(2):
        runs.sla_daily(store, DAY)
        runs.slot_counts(store, "motion", DAY)
        runs.slot_counts(store, "critical", DAY)
        runs.slot_counts(store, "door", DAY)
        runs.vod_daily(store, DAY)
        runs.video_daily(store, DAY, CAMERAS, b.OFFLINE)
        runs.outage_patterns(store, NOW, b.OFFLINE)
    sites = store.read("sites").count()
    for name in ("sla_sitewise", "slots_critical", "slots_door", "vod_daily", "vod_counts", "video_daily"):
        assert store.read(name).count() == sites, name
    runs.sla_daily(store, "2024-01-28")
    assert store.read("sla_sitewise").count() == 2 * sites
    assert store.read("site_master").count() == sites
    total = store.read("sla_sitewise").agg(F.sum("total_tickets")).first()[0]
    assert total == store.read("sla_bankwise").agg(F.sum("total_tickets")).first()[0] > 0


def test_a_day_can_become_empty(store):
    runs.sla_daily(store, "2024-01-27")
    assert not store.read("tickets_violated").filter("date = '2024-01-27'").isEmpty()
    rerun = runs.Store(store.spark, store.root + "/again")
    for name in ("sites", "remarks"):
        store.read(name).write.parquet(rerun.path(name))
    store.read("tickets").write.parquet(rerun.path("tickets"))
    runs.sla_daily(rerun, "2024-01-27")
    store.read("tickets").filter("opened_on < timestamp_ntz'2024-01-27'").write.mode(
        "overwrite").parquet(rerun.path("tickets"))
    runs.sla_daily(rerun, "2024-01-27")
    assert rerun.read("tickets_violated").isEmpty()
    assert rerun.read("sla_sitewise").agg(F.sum("total_tickets")).first()[0] == 0


def test_ticket_tables_settle(store):
    for run, name, options in (
            (runs.disk_tickets, "disk_tickets", {"minutes": 5000}),
            (runs.camera_tickets, "camera_tickets", {"minutes": 5000}),
            (runs.camera_lag_tickets, "camera_lag_tickets", {}),
            (runs.lobby_tickets, "lobby_tickets", {"minutes": 60})):
        run(store, NOW, **options)
        run(store, NOW, **options)  # a new disk ticket takes its recording time with the next run
        first = rows(store.read(name))
        run(store, NOW, **options)
        assert rows(store.read(name)) == first and first, name
    runs.lobby_day_report(store, DAY)
    runs.repeated_faults(store, NOW)
    assert store.read("disk_faults_repeated").isEmpty()


def test_priorities_rewrite_their_own_table(store):
    runs.video_daily(store, DAY, CAMERAS, b.OFFLINE)
    runs.sensor_matrices(store, "2024-02-10 00:00:00", SENSORS)
    before = store.read("sensor_trigger").count()
    runs.sensor_priority(store, NOW, list(SENSORS.values()))
    after = store.read("sensor_trigger")
    assert 0 < after.count() <= before and after.filter("priority is null").isEmpty()
    for _ in range(2):
        runs.site_features(store, NOW)
        runs.site_priority(store)
        table = store.read("site_priority")
        assert table.count() == store.read("sites").count()
        assert {r[0] for r in table.select("site_priority").distinct().collect()} <= {"S1", "S2", "S3", "S4", "S5"}


def test_reports_and_dashboard(store, spark):
    runs.near_violation(store, NOW)
    assert store.read("ticket_class_counts").count() == 2 * store.read("sites").select("bank").distinct().count()
    runs.sla_daily(store, DAY)
    document = json.loads(runs.dashboard_document(store, NOW, hours=700).first()[0])
    assert list(document) == ["box1", "box2", "box3", "box4"]
    assert document["box1"]["total"] == store.read("motion_events").filter(
        "closed_on is null and opened_on >= timestamp_ntz'2023-12-31 20:00:00'").count() > 0
    by_tile = runs.dashboard_records(store, "motion_events", ">4", NOW, hours=700).count()
    assert by_tile == document["box1"]["sub-total"][">4"]
    yesterday = runs.dashboard_records(store, "sla_bankwise", "Yesterday", NOW)
    assert (yesterday.agg(F.sum("total_violations")).first()[0] or 0) == document["box4"]["sub-total"]["Yesterday"]
    assert runs.dashboard_records(store, "near_violation", "All", NOW).count() == document["box3"]["total"]
    runs.vod_daily(store, DAY)
    runs.vod_report(store, DAY, {DAY: "d29"})
    lobby = spark.read.option("header", "true").csv(store.path(f"reports/vod-{DAY}/Lobby"))
    assert lobby.columns == ["site_id", "d29"] and lobby.count() == store.read("sites").count()
    runs.penalty_tickets(store, "2024-01-01")
    feeds = b.penalties(spark, SF)
    runs.penalty_consolidation(store, {"mcu": feeds.filter("item = '1-URGENT'"), "pm": feeds.filter("item = '5-LOW'")})
    csv = spark.read.option("header", "true").csv(store.path("reports/penalty-consolidated"))
    assert csv.columns == ["site", "month", "mcu", "pm", "total"] and not csv.isEmpty()


def test_old_versions_are_forgotten(spark, tmp_path):
    import os
    path = str(tmp_path / "t")
    for i in range(6):
        replace_table(spark.range(i).toDF("a"), path, keep=3)
    assert sorted(os.listdir(path)) == ["v=4", "v=5", "v=6"]


def test_sites_out_of_service_are_left_out(spark, tmp_path):
    store = runs.Store(spark, str(tmp_path / "s"))
    spark.createDataFrame(
        [("1", "A", "True", 1, "X"), ("2", "B", "False", 1, "X"), ("3", "C", "True", 0, "X"), ("4", "Test", "True", 1, "X"),
         ("5", "D", "True", 1, "TEST BED")],
        "McuID string, SiteName string, qStatus string, status int, BankName string").write.parquet(store.path("sites"))
    assert rows(store.sites(), "site_id") == [("1",)]
    spark.createDataFrame([("9", "A", "X")], "site_id string, site_name string, bank string").write.mode("overwrite").parquet(store.path("sites"))
    assert rows(store.sites(), "site_id") == [("9",)]


def test_polls_read_new_signals_only(spark, frame, tmp_path):
    """A camera silent for months keeps its ticket, and the scan gets a time filter."""
    from tests.test_jobs import cam, signal, site
    store = runs.Store(spark, str(tmp_path / "s"))
    frame("sites", [site(1)]).write.parquet(store.path("sites"))
    frame("cameras", [cam(1, "0701"), cam(1, "0702")]).write.parquet(store.path("cameras"))
    frame("recorder_signals", [signal(1, "0701", "2023-10-01 00:00"), signal(1, "0702", "30 23:00")]
          ).write.parquet(store.path("recorder_signals"))
    runs.camera_lag_tickets(store, NOW)
    first = rows(store.read("camera_lag_tickets"), "camera_id", "closed_on")
    assert first == [("0701", None)]
    frame("recorder_signals", [signal(1, "0702", "31 10:00")]).write.mode("append").parquet(store.path("recorder_signals"))
    plan = runs.new_signals(store)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at_time,2024-01-30T22:00)" in plan
    runs.camera_lag_tickets(store, "2024-01-31 12:00:00")
    assert rows(store.read("camera_lag_tickets"), "camera_id", "closed_on") == first
    assert store.read("latest_signals").count() == 2


def test_late_uploads_and_fast_clocks(spark, frame, tmp_path):
    """Signals count by arrival: neither an old time nor a clock ahead hides them."""
    from tests.test_jobs import signal
    store = runs.Store(spark, str(tmp_path / "with blank"))

    def poll(*signals):
        frame("recorder_signals", list(signals)).write.mode("append").parquet(store.path("recorder_signals"))
        return {(r["box_id"], r["device_id"]): str(r["at_time"]) for r in runs.latest_signals(store).collect()}

    keys = sorted(poll(signal(1, "0701", "29 10:00"), signal(2, "0701", "30 10:00")))
    assert len(keys) == 2
    # A site back from an outage uploads its buffer, and another clock is a year ahead.
    got = poll(signal(1, "0701", "29 20:00"), signal(2, "0701", "2025-01-30 10:00"))
    assert [got[k] for k in keys] == ["2024-01-29 20:00:00", "2025-01-30 10:00:00"]
    got = poll(signal(1, "0701", "30 12:00"))
    assert [got[k] for k in keys] == ["2024-01-30 12:00:00", "2025-01-30 10:00:00"]
    assert runs._unread_files(store).count() == 0


def test_footage_answers_use_the_kept_tickets(spark, frame, tmp_path):
    from tests.test_jobs import cam, signal, site
    store = runs.Store(spark, str(tmp_path / "s"))
    frame("sites", [site(1), site(2)]).write.parquet(store.path("sites"))
    frame("tickets", [{"event_id": 1, "site_id": "1", "msg": "NC-30", "at_time": "29 08:00",
                       "closed_on": "29 09:00"}]).write.parquet(store.path("tickets"))
    frame("recording_counts", []).write.parquet(store.path("recording_counts"))
    frame("recorder_signals", [signal(2, "0702", "28 10:00")]).write.parquet(store.path("recorder_signals"))
    runs.lobby_tickets(store, "2024-01-29 00:00:00")
    spark.sql("""select * from values (1L, '1', 'b1', timestamp_ntz'2024-01-29 08:30:00'),
        (2L, '1', 'b1', timestamp_ntz'2024-01-29 09:30:00'), (3L, '2', 'b2', timestamp_ntz'2024-01-29 12:00:00'),
        (4L, '2', 'b2', timestamp_ntz'2024-01-27 12:00:00')
        as t(ticket_id, site_id, box_id, asked_at)""").write.parquet(store.path("footage_requests"))
    for _ in range(2):
        runs.footage_answers(store, NOW)
    site_of = {r["site_id"] for r in store.read("lobby_tickets").collect()}
    assert len(site_of) == 1
    answers = {r["ticket_id"]: r["reason"] for r in store.read("footage_answers").collect()}
    assert answers[1] == "Offline" and answers[2] == "Online - No HDD Issue" and len(answers) == 4
