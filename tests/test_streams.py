"""Several micro-batches, late rows, repeats and replays."""

import pytest
from pyspark.sql import functions as F

from sitepulse import streaming as st
from sitepulse.plans import sla
from sitepulse.sources import current_version, replace_table
from tests.conftest import rows, t
from tests.test_jobs import NOW, disk, open_ticket, signal, site, ticket


def feed(spark, folder, *batches, schema="k string, ts timestamp_ntz"):
    """One file per micro-batch, in order."""
    import os
    import time
    for i, batch in enumerate(batches):
        spark.createDataFrame([(*r[:-1], t(r[-1])) for r in batch], schema).coalesce(1).write.mode(
            "append").parquet(str(folder))
        for name in os.listdir(folder):
            path = os.path.join(folder, name)
            if name.startswith("part") and os.stat(path).st_mtime > time.time() - 3600:
                os.utime(path, (1_000_000 + i, 1_000_000 + i))
    return st.event_stream(spark, str(folder), files_per_batch=1)


def test_slots_over_batches_with_late_rows(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [("a", "01 01:00"), ("a", "01 03:59:59")],
                  [("a", "01 09:30"), ("b", "01 04:00")],
                  # The first slot is written with this batch; a row for it is late after that.
                  [("b", "01 09:31")], [("a", "01 02:00"), ("a", "01 20:00")])
    out = st.run_available(st.slot_counts(stream, "ts", ["k"]), str(tmp_path / "out"))
    got = rows(out.select("k", F.date_format("slot_start", "HH"), "signals"))
    assert got == [("a", "00", 2), ("a", "08", 1), ("b", "04", 1), ("b", "08", 1)]


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    for spread in (None, 4):
        folder = tmp_path / f"in{spread}"
        stream = feed(spark, folder, [("a", "01 01:00"), ("a", "01 01:00"), ("b", "01 01:10")],
                      [("a", "01 01:05"), ("c", "01 01:30")])
        out = st.run_available(st.distinct_tickets(stream, "ts", ["k"], "2 hours", spread=spread).select("k"),
                               str(tmp_path / f"out{spread}"))
        assert rows(out) == [("a",), ("b",), ("c",)]


def test_tickets_without_acknowledgement_follow_the_watermark(spark, tmp_path):
    opened = feed(spark, tmp_path / "t", [(1, "01 01:00"), (1, "01 01:00"), (2, "01 01:00")], [(3, "01 09:00")], [(4, "01 20:00")],
                  schema="event_id long, ts timestamp_ntz").withColumnRenamed("ts", "opened_on")
    acks = feed(spark, tmp_path / "a", [(1, "01 01:10"), (1, "01 01:12")], [(2, "01 08:00")], [(3, "01 20:00")],
                schema="event_id long, ts timestamp_ntz").withColumnRenamed("ts", "ack_on")
    out = st.run_available(st.acknowledged_tickets(opened, acks), str(tmp_path / "out"))
    got = rows(out.select("event_id", F.date_format("ack_on", "HH:mm")))
    assert got[:3] == [(1, "01:10"), (2, None), (3, None)]


def test_sessions_and_alarms(spark, tmp_path):
    batches = ([("a", "01 01:00"), ("a", "01 01:20"), ("b", "01 01:00")], [("a", "01 01:40"), ("a", "01 04:00")],
               [("a", "01 09:00")])
    sessions = st.run_available(
        st.offline_sessions(feed(spark, tmp_path / "s", *batches), "ts", "k", gap="30 minutes"), str(tmp_path / "o1"))
    assert rows(sessions.select("k", F.date_format("session_start", "HH:mm"), F.date_format("last_signal", "HH:mm"), "signals")) == [
        ("a", "01:00", "01:40", 3), ("a", "04:00", "04:00", 1), ("b", "01:00", "01:00", 1)]
    alarms = st.run_available(
        st.silent_sites(feed(spark, tmp_path / "q", *batches), "ts", "k", silence="2 hours"), str(tmp_path / "o2"))
    assert rows(alarms.select("k", F.date_format("alarm_at", "HH:mm"))) == [("a", "03:40"), ("a", "06:00"), ("b", "03:00")]


def test_near_violation_feed_follows_closures_and_replays(spark, frame, tmp_path):
    handler = st.near_violation_feed(
        spark, str(tmp_path / "t"), str(tmp_path / "f"), lambda: frame("sites", [site(1)]), lambda: NOW)
    first = frame("tickets", [ticket(1, "30 23:56", None), ticket(2, "30 23:33", None), ticket(3, "29 10:00", None)])
    second = frame("tickets", [ticket(2, "30 23:33", "30 23:59"), ticket(4, "30 23:32", None)])
    handler(first, 0)
    assert rows(current_version(spark, str(tmp_path / "f")), "event_id") == [(1,), (2,)]
    for _ in range(2):
        handler(second, 1)
        assert rows(current_version(spark, str(tmp_path / "f")), "event_id", "required_action") == [
            (1, "TicketToAck"), (4, "TicketToClose")]
    # The same list as the batch job over all tickets at once.
    whole = first.filter("event_id != 2").unionByName(second)
    batch = sla.near_violation(sla.open_tickets(whole, frame("remarks", []), frame("sites", [site(1)]), NOW))
    assert rows(batch, "event_id") == [(1,), (4,)]


def test_fault_lifecycle_replay(spark, frame, tmp_path):
    open_path, archive = str(tmp_path / "open"), str(tmp_path / "archive")
    start = frame("fault_tickets", [open_ticket(7, "2"), open_ticket(9, "3")])
    replace_table(start, open_path, version=-1)
    handler = st.fault_lifecycle(
        spark, open_path, archive, lambda: frame("sites", [site(i) for i in (1, 2, 3)]),
        lambda: frame("recorder_signals", [signal(3, "0701", "30 23:00", code="REMOTERECORD")]), lambda: NOW, minutes=90)
    handler(frame("disk_status", [disk("1", "0", "30 10:00"), disk("2", "1", "30 10:00")]), 0)
    for _ in range(2):
        handler(frame("disk_status", [disk("1", "1", "30 11:00"), disk("2", "0", "30 11:00"), disk("3", "0", "30 11:00")]), 1)
        now_open = current_version(spark, open_path)
        assert rows(now_open, "box_id", "latest_remote_recording") == [("b2", None), ("b3", t("30 23:00"))]
        closed = spark.read.parquet(archive)
        assert rows(closed, "box_id", "batch") == [("b1", 1), ("b2", 0)]
        ids = [r[0] for r in now_open.select("ticket_id").union(closed.select("ticket_id")).collect()]
        assert len(set(ids)) == 4 and {7, 9} <= set(ids)


def test_stream_sees_sites_and_recordings_that_arrive_between_batches(spark, frame, tmp_path):
    """Dimension tables are read in every batch, and signals only back to the look-back."""
    open_path, archive = str(tmp_path / "open"), str(tmp_path / "archive")
    sites, signals = str(tmp_path / "sites"), str(tmp_path / "signals")
    frame("sites", [site(1)]).write.parquet(sites)
    frame("recorder_signals", [signal(1, "0701", "30 23:55", code="REMOTERECORD")]).write.parquet(signals)
    replace_table(frame("fault_tickets", []), open_path, version=-1)
    handler = st.fault_lifecycle(spark, open_path, archive, lambda: spark.read.parquet(sites),
                                 lambda: spark.read.parquet(signals), lambda: NOW)
    handler(frame("disk_status", [disk("1", "0", "30 10:00"), disk("2", "0", "30 10:00")]), 0)
    assert rows(current_version(spark, open_path), "box_id") == [("b1",)]
    frame("sites", [site(2)]).write.mode("append").parquet(sites)
    frame("recorder_signals", [signal(1, "0701", "30 23:58", code="REMOTERECORD"),
                               signal(2, "0701", "30 22:00", code="REMOTERECORD")]).write.mode("append").parquet(signals)
    handler(frame("disk_status", [disk("1", "0", "30 11:00"), disk("2", "0", "30 11:00")]), 1)
    handler(frame("disk_status", [disk("1", "0", "30 11:05"), disk("2", "0", "30 11:05")]), 2)
    assert rows(current_version(spark, open_path), "box_id", "latest_remote_recording") == [
        ("b1", t("30 23:58")), ("b2", None)]
    ids = [r[0] for r in current_version(spark, open_path).select("ticket_id").collect()]
    assert sorted(ids) == [1, 2]


def test_a_new_checkpoint_does_not_forget_the_table(spark, frame, tmp_path):
    def handler(**options):
        return st.near_violation_feed(
            spark, str(tmp_path / "t"), str(tmp_path / "f"), lambda: frame("sites", [site(1)]), lambda: NOW,
            **options)

    handler()(frame("tickets", [ticket(1, "30 23:56", None)]), 0)
    handler()(frame("tickets", [ticket(2, "30 23:33", None)]), 1)
    with pytest.raises(ValueError, match="start=2"):
        handler()(frame("tickets", [ticket(4, "30 23:32", None)]), 0)
    handler(start=2)(frame("tickets", [ticket(4, "30 23:32", None)]), 0)
    assert rows(current_version(spark, str(tmp_path / "f")), "event_id") == [(1,), (2,), (4,)]


def _watched(spark, *rows):
    return spark.createDataFrame([(k, t(since)) for k, since in rows], "k string, since timestamp")


def _alarms(out):
    return rows(out.select("k", "kind", F.date_format("last_signal", "dd HH:mm"),
                           F.date_format("at", "dd HH:mm")))


def test_sites_that_never_sent_and_sites_that_return(spark, tmp_path):
    """Over several batches and a restart: the state of each site goes on."""
    sites = _watched(spark, ("never", "01 00:00"), ("late", "01 00:00"), ("a", "01 00:00"),
                     ("new", "01 20:00"), (None, "01 00:00"), ("a", "01 05:00"))
    folder = str(tmp_path / "in")

    def run(*batches):
        stream = feed(spark, folder, *batches)
        return _alarms(st.run_available(st.site_alarms(
            stream, sites, "ts", "k", silence="2 hours", delay="30 minutes"), str(tmp_path / "out")))

    first = run([("a", "01 00:30"), ("a", "01 01:10")], [("a", "01 03:00"), (None, "01 01:00")],
                [("other", "01 04:00")])
    assert first == [("late", "silent", None, "01 02:00"), ("never", "silent", None, "01 02:00")]
    # An hour of out-of-order rows fills a pause that was still open; then everybody is silent.
    second = run([("late", "01 05:00"), ("a", "01 04:40")], [("other", "01 12:00")])
    assert sorted(second, key=str) == sorted(first + [
        ("late", "back", None, "01 05:00"), ("late", "silent", "01 05:00", "01 07:00"),
        ("a", "silent", "01 04:40", "01 06:40"), ("other", "silent", "01 04:00", "01 06:00")], key=str)
    third = run([("a", "01 13:00"), ("new", "02 03:00")])
    new = [r for r in third if r not in second]
    assert sorted(new, key=str) == [
        ("a", "back", None, "01 13:00"), ("a", "silent", "01 13:00", "01 15:00"),
        ("new", "silent", None, "01 22:00"), ("other", "back", None, "01 12:00"),
        ("other", "silent", "01 12:00", "01 14:00")]


def test_busy_site_is_reduced_before_its_rows_meet(spark, tmp_path):
    from sitepulse.streaming.state import _micros, _runs_of
    many = spark.range(30_000).selectExpr(
        "'busy' as k", "timestamp_micros(id * 1000000 + if(id > 20000, 90000000000, 0)) as ts")
    runs = _runs_of(many, "ts", "k", _micros("2 hours"))
    assert runs.count() < 30 and runs.agg(F.max("last") - F.min("first")).first()[0] == (
        29_999 + 90_000) * 1_000_000


def _status(spark, folder, *batches):
    schema = "box_id string, hdd string, error string, ts timestamp_ntz"
    return feed(spark, folder, *batches, schema=schema).withColumnRenamed("ts", "at_time")


def test_fault_states_over_batches_and_a_restart(spark, frame, tmp_path):
    known = frame("fault_tickets", [
        {"ticket_id": 1, "box_id": "b2", "error": "E", "opened_on": "01 00:00"},
        {"ticket_id": 2, "box_id": "b2", "error": "old", "opened_on": "01 00:00"},
        {"ticket_id": 3, "box_id": "b4", "error": "E", "opened_on": "01 09:00"},
        {"ticket_id": 4, "box_id": "b5", "error": "E", "opened_on": "01 00:00", "closed_on": "01 01:00"}])
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(*batches):
        closed = st.run_available(st.fault_states(_status(spark, folder, *batches), known), out)
        return (rows(closed.select("box_id", "error", F.date_format("opened_on", "HH:mm"),
                                   F.date_format("closed_on", "HH:mm"))),
                rows(st.open_faults(spark, f"{out}/state").select(
                    "box_id", "error", F.date_format("opened_on", "HH:mm"))))

    closed, still = run(
        [("b1", "0", "E", "01 10:00"), ("b1", "0", "E", "01 10:00"), ("b1", "0", "E", "01 10:05"),
         ("b3", "1", None, "01 10:00"), (None, "0", "E", "01 10:00")],
        [("b1", "0", "F", "01 10:10"), ("b2", "0", "old", "01 08:00"), ("b3", "0", None, "01 11:00")],
        [("b4", "1", "E", "01 08:00")])  # older than the ticket of b4: changes nothing
    assert closed == [("b1", "E", "10:00", "10:10")]
    assert still == [("b1", "F", "10:10"), ("b2", "old", "00:00"), ("b3", None, "11:00"), ("b4", "E", "09:00")]
    # The restart reads new files only and knows what is open; out-of-order rows are sorted.
    closed, still = run([("b1", "0", "E", "01 13:00"), ("b1", "1", "E", "01 12:00"), ("b4", "1", "x", "01 12:30")])
    assert closed == [("b1", "E", "10:00", "10:10"), ("b1", "F", "10:10", "12:00"), ("b4", "E", "09:00", "12:30")]
    assert still == [("b1", "E", "13:00"), ("b2", "old", "00:00"), ("b3", None, "11:00")]


def test_open_tickets_are_not_written_again(spark, frame, tmp_path):
    """A batch with one box writes that box's change only; the output holds closed tickets."""
    known = frame("fault_tickets", [{"ticket_id": i, "box_id": f"b{i}", "error": "E", "opened_on": "01 00:00"}
                                    for i in range(500)])
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in ([("b1", "1", "E", "01 10:00")], [("b2", "1", "E", "01 11:00")]):
        closed = st.run_available(st.fault_states(_status(spark, folder, batch), known), out)
    assert closed.count() == 2 and st.open_faults(spark, f"{out}/state").count() == 498
