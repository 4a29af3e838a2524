"""Rule boundaries of the jobs on small hand-made frames."""

import pytest
from pyspark.sql import functions as F

from sitepulse.plans import (
    availability, dashboard, footage, outages, penalties, portfolio, priority, recordings, repeats,
    sensors, sla, slots, tickets,
)
from sitepulse.sources import apply_ticket_changes
from tests.conftest import rows, t

NOW = "2024-01-31 00:00:00"


def site(i, **more):
    return {"site_id": str(i), "box_id": f"b{i}", "site_name": f"S{i}", "bank": "B", "status": 1,
            "active": True, "on_site": 1, **more}


def ticket(i, opened, closed=None, kind="SOS", **more):
    return {"event_id": i, "site_id": "1", "event_type": kind, "msg": f"m{i}", "at_time": opened,
            "opened_on": opened, "closed_on": closed, "closed_by": "op", "active": True, **more}


def ack(i, at, status=1, text="working"):
    return {"event_id": i, "updated_on": at, "tkt_status": status, "remarks": text, "updated_by": "u"}


def test_sla_limits_are_inclusive(frame):
    rated = sla.rated_tickets(frame("tickets", [
        ticket(1, "30 10:00", "30 10:30"), ticket(2, "30 10:00", "30 10:29:59"),
        ticket(3, "30 10:00", "30 11:00", "Critical"), ticket(4, "30 10:00", "30 10:04:59"),
        ticket(5, "30 10:00", "30 10:10", "Critical"),
        ticket(6, "30 10:00", "30 12:00", msg="NC-30"),
        ticket(7, "30 10:00", "30 12:00", closed_by="System"),
        ticket(8, "30 10:00", "30 12:00", closed_by=None),
        ticket(9, "30 10:00", "30 12:00", msg="m1"), ticket(10, "30 10:00", "30 12:00", "Info"),
    ]), frame("remarks", [ack(1, "30 10:05"), ack(2, "30 10:04:59"), ack(2, "30 10:20"),
                          ack(3, "30 10:09"), ack(5, "30 10:00", status=2)]), NOW)
    got = {r["event_id"]: (r["ack_penalty"], r["close_penalty"]) for r in rated.collect()}
    assert got == {
        1: ("SOSAckViolations", "SOSCloseViolations"), 2: (None, None),
        3: (None, "CriticalCloseViolations"), 4: (None, None), 5: ("CriticalNoAckVio", None)}


def test_sla_tables_add_up(frame):
    sites = frame("sites", [site(1), site(2)])
    rated = sla.rated_tickets(frame("tickets", [
        ticket(1, "29 10:00", "29 11:00"), ticket(2, "30 10:00", "30 12:00", "Critical"),
        ticket(3, "30 10:00", "30 10:01", site_id="9")]), frame("remarks", []), NOW)
    per_site = sla.site_violations(rated, sites, "2024-01-29", "2024-01-30")
    assert rows(per_site, "date", "site_id", "total_tickets", "sos_close", "critical_close") == sorted([
        (t("29 00:00").date(), "1", 1, 1, 0), (t("29 00:00").date(), "2", 0, 0, 0),
        (t("30 00:00").date(), "1", 1, 0, 1), (t("30 00:00").date(), "2", 0, 0, 0)], key=str)
    per_bank = sla.bank_violations(rated, sites)
    for measure in sla.MEASURES:
        total = sum(r[0] for r in per_site.select(measure).collect())
        assert total == sum(r[0] for r in per_bank.select(measure).collect())
    late = sla.violated_tickets(rated, sites)
    assert rows(late, "event_id", "ack_penalty", "close_penalty") == [
        (1, "SOSNoAckVio", "SOSCloseViolations"), (2, "CriticalNoAckVio", "CriticalCloseViolations")]


def test_near_violation_bands(frame):
    now = "2024-01-30 12:00:00"
    made = [("30 11:56", "SOS"), ("30 11:55", "SOS"), ("30 11:36", "SOS"), ("30 11:30", "SOS"),
            ("30 11:52", "Critical"), ("30 11:50", "Critical"), ("30 11:12", "Critical"),
            ("29 11:59", "SOS")]
    open_ = sla.open_tickets(
        frame("tickets", [ticket(i, at, None, kind, closed_by=None) for i, (at, kind) in enumerate(made)]
              + [ticket(50, "30 11:56", "30 11:57")]),
        frame("remarks", [ack(1, "30 11:59"), ack(2, "30 11:41"), ack(2, "30 11:40")]),
        frame("sites", [site(1), site(2, bank="C")]), now)
    assert rows(sla.near_violation(open_), "event_id", "required_action") == [
        (0, "TicketToAck"), (2, "TicketToClose"), (4, "TicketToAck"), (6, "TicketToClose")]
    summary = {(r["bank"], r["event_type"]): tuple(r)[2:] for r in
               sla.class_summary(open_, frame("sites", [site(1), site(2, bank="C")])).collect()}
    assert summary[("B", "SOS")] == (4, 2, 2, 0, 1, 1)
    assert summary[("B", "Critical")] == (3, 0, 3, 0, 1, 1)
    assert summary[("C", "SOS")] == summary[("C", "Critical")] == (0,) * 6


def test_penalty_tickets_are_strict(frame):
    out = penalties.penalty_tickets(
        frame("tickets", [ticket(1, "10 10:00", "10 10:30"), ticket(2, "10 10:00", "10 10:31"),
                          ticket(3, "10 10:00", "10 10:31", closed_by="SYSTEM"),
                          ticket(4, "10 10:00", "10 10:31", active=False),
                          ticket(5, "10 10:00", None, closed_by=None),
                          ticket(6, "2023-12-31 23:59:59", "10 10:31")]),
        frame("remarks", [ack(1, "10 10:05:59"), ack(2, "10 10:01", text="Working"),
                          ack(2, "10 10:01", text="working, closed"), ack(3, "10 10:01"),
                          ack(4, "10 10:01"), ack(5, "10 10:06"), ack(6, "10 10:06")]),
        frame("sites", [site(1)]), "2024-01-01")
    assert rows(out, "event_id", "remarks") == [(2, "working"), (5, "working")]


def test_penalty_trend_labels(spark):
    def line(site_name, *amounts):
        return [(site_name, m, a) for m, a in zip((4, 5, 6, 7), amounts)]

    data = (line("flat", "100", "100", "100", "100") + line("up", "100", "110", "120", "130")
            + line("down", "130", "120", "110", "100") + line("jump", "-", "--", "NA ", "400")
            + line("drop", "400", "-", "-", "-") + line("none", "-", "0", "--", "")
            + [("up", 8, "9999")])
    out = penalties.penalty_trend(spark.createDataFrame(data, "site string, month int, amount string"))
    got = {r["site"]: (r["trend"], r["regularity"], r["bucket"], r["slope"]) for r in out.collect()}
    assert got == {
        "flat": ("Stable", "Very Regular", "100-200", 0.0),
        "up": ("Increasing", "Regular", "100-200", 10.0),
        "down": ("Decreasing", "Regular", "100-200", -10.0),
        "jump": ("Agg Increasing", "Very Irregular", "100-200", 120.0),
        "drop": ("Agg Decreasing", "Very Irregular", "100-200", -120.0)}


def test_consolidation_invariants(spark):
    def feed(*lines):
        return spark.createDataFrame(list(lines), "site string, month int, amount double")

    out = penalties.consolidate({
        "mcu": feed(("a", 4, 10.0), ("a", 4, 5.0), ("a", 8, 1.0)), "pm": feed(("a", 4, 2.0), ("b", 6, 3.0)),
        "footage": feed((None, 4, 9.0))}, drop_months=(8, 9))
    assert rows(penalties.month_names(out)) == [("a", "Apr", 15.0, 2.0, 0.0, 17.0),
                                                ("b", "June", 0.0, 3.0, 0.0, 3.0)]


def test_slot_counts_keep_all_events(frame):
    sites = frame("sites", [site(1), site(2), site(3)])
    items = frame("installed_items", [
        {"site_id": s, "group_no": "01", "unit_no": "36", "item_name": n, "active": True, "enabled": e}
        for s, n, e in (("1", "x", True), ("2", "x", True), ("2", "x", True), ("3", "x", False), ("1", None, True))])
    events = frame("tickets", [
        ticket(i, at, group_no="01", unit_no="36", msg="m") for i, at in enumerate(
            ("30 03:59:59", "30 04:00:00", "30 04:00:00", "30 23:59:59"))])
    out = slots.slot_counts(slots.motion_events(events), "opened_on", sites,
                            slots.installed_sites(items, "36"), "2024-01-30", "2024-01-30")
    got = {r["site_id"]: [r[s] for s in slots.SLOT_NAMES] for r in out.collect()}
    assert got == {"1": [1, 1, 0, 0, 0, 1], "2": [0] * 6}


def episode(i, start, end, s="1"):
    return {"event_id": i, "site_id": s, "event_type": "x", "msg": "NC-30", "at_time": start,
            "opened_on": start, "closed_on": end}


def test_site_online(frame):
    sites = frame("sites", [site(1), site(2), site(3)])
    eps = frame("tickets", [
        episode(1, "2023-12-31 12:00", "01 12:00"), episode(2, "10 00:00", "10 12:00"),
        episode(3, "10 00:00", "10 12:00"), episode(4, "30 12:00", None), episode(5, "31 01:00", None),
        episode(6, "20 00:00", None, "2")])
    beats = frame("heartbeats", [{"site_id": "2", "received": "21 00:00"}, {"site_id": "1", "received": "30 12:00"}])
    out = availability.site_online_pct(sites, eps, beats, NOW)
    # Site 1: 12 h on the first day, 12 h on the 10th, 12 h from the 30th on; site 2 was heard of.
    assert rows(out, "site_id", "online_pct") == [("1", 95.0), ("2", 100.0), ("3", 100.0)]
    assert rows(availability.reported_alive(eps, beats), "event_id") == [(6,)]
    daily = availability.daily_offline_pct(eps, beats, "2024-01-01", "2024-01-30")
    assert rows(daily, "date", "offline_pct") == [(t(f"{d} 00:00").date(), 50.0) for d in ("01", "10", "30")]


def test_video_status(frame):
    sites = frame("sites", [site(i) for i in range(1, 6)])
    cams = frame("cameras", [{"box_id": f"b{i}", "camera_id": c, "camera_name": n, "active": True}
                             for i in range(1, 6) for c, n in (("0701", "Outdoor Camera"), ("0702", "Lobby Camera"))])
    counts = {1: (1000, 1000), 2: (700, 900), 3: (600, 1000), 4: (None, 400), 5: (780, 800)}
    recs = frame("recording_counts", [
        {"box_id": f"b{i}", "camera_id": c, "file_count": n, "at_time": at}
        for i, (a, z) in counts.items() for c, n, at in (
            ("0701", a, "30 01:00"), ("0702", z, "30 01:00"), ("0702", 5, "30 02:00"))])
    out = availability.video_availability(
        sites, cams, recs, frame("tickets", []), frame("heartbeats", []), "2024-01-30", "2024-01-30",
        {"OutdoorCamera": "outdoor", "LobbyCamera": "lobby"})
    got = {r["site_id"]: (r["video_pct"], r["remark"]) for r in out.collect()}
    assert got == {"1": (100.0, "No Issue"), "2": (80.0, "Site Level Video Recording Issue"),
                   "3": (80.0, "OutdoorCamera Issue"), "4": (20.0, "Site Level Video Recording Issue"),
                   "5": (79.0, "Site Level Video Recording Issue")}


def test_vod_labels(frame):
    sites = frame("sites", [site(i) for i in range(1, 5)])
    cams = frame("cameras", [{"box_id": f"b{i}", "camera_id": "0702", "camera_name": "Lobby Camera", "active": True}
                             for i in range(1, 5)])
    recs = frame("recording_counts", [
        {"box_id": b, "camera_id": c, "file_count": n, "remote_file_count": m, "at_time": "30 05:00"}
        for b, c, n, m in (("b1", "0702", 859, None), ("b1", "0702R", None, 1), ("b2", "0702", 859, None),
                           ("b2", "0702", 3, None), ("b3", "0702", 0, 0))])
    matrix = recordings.camera_matrix(cams, recordings.daily_totals(recs), "2024-01-30", "2024-01-30")
    daily = recordings.vod_daily(sites, matrix)
    assert rows(daily, "site_id", "lobby", "outdoor", "status") == [
        ("1", "YES", None, "YES"), ("2", "PR", None, "PR"), ("3", "NO", None, "NO"), ("4", "NO", None, "NO")]
    assert tuple(recordings.vod_summary(daily).first())[2:] == (4, 1, 1, 2, 2)
    shares = recordings.vod_counts(sites, matrix)
    assert rows(shares, "site_id", "lobby_pct") == [("1", 100.0), ("2", 99.88), ("3", 0.0), ("4", 0.0)]
    sheets = recordings.vod_report(daily, shares, {"2024-01-30": "d30"}, "2024-01-30")
    assert list(sheets) == ["Summary", "Lobby", "Outdoor", "Backroom", "Pinhole", "LobbyShare"]
    assert rows(sheets["Outdoor"]) == [(str(i), "0") for i in range(1, 5)]


def test_footage_order_of_reasons(frame, spark):
    asked = spark.createDataFrame(
        [(i, s, f"b{s}", t("10 12:00")) for i, s in enumerate("1234567")],
        "ticket_id int, site_id string, box_id string, asked_at timestamp_ntz")
    share = spark.createDataFrame([(f"b{s}", t("10 00:00").date(), v) for s, v in
                                   (("1", 99.5), ("2", 99.0), ("3", 50.0), ("4", 50.0), ("5", 1.0), ("6", 1.01))],
                                  "box_id string, date date, availability double")
    out = footage.footage_status(
        asked, share, frame("tickets", [episode(1, "10 11:00", "10 12:00", s) for s in "12"] + [episode(9, "20 00:00", None, "6")]),
        frame("fault_tickets", [{"site_id": s, "camera_id": c, "opened_on": "10 12:00"} for s, c in
                                (("2", "0702"), ("3", "0702"), ("4", "0703"))]),
        frame("fault_tickets", [{"site_id": s, "opened_on": "01 00:00"} for s in "345"]))
    assert rows(out, "site_id", "video_status", "reason", "current_status") == [
        ("1", "Available", None, "Online"), ("2", "Not Available", "Offline", "Online"),
        ("3", "Not Available", "Camera Issue", "Online"), ("4", "Available", "HDD Issue", "Online"),
        ("5", "Not Available", "HDD Issue", "Online"), ("6", "Available", "No HDD Issue", "Offline"),
        ("7", "Not Available", "Online - No HDD Issue", "Online")]


def _outages(frame, plan, first_id=0):
    """plan: site -> list of (start, end) clock times, on each of the 15 days before NOW."""
    out = []
    for s, pairs in plan.items():
        for day in range(16, 31):
            for start, end in pairs:
                if end < start:
                    if day == 30:
                        continue
                    close = f"{day + 1} {end}"
                else:
                    close = f"{day} {end}"
                out.append(episode(first_id + len(out), f"{day} {start}", close, s))
    return frame("tickets", out)


def test_outage_precedence(frame):
    base = outages.outage_base(_outages(frame, {
        "1": [("10:15", "11:20")], "2": [("18:05", "07:30")],
        "3": [("01:0%d" % i, "02:0%d" % i) for i in range(2)]}), NOW)
    got = outages.all_patterns(base, NOW)
    assert rows(got, "site_id", "time_offline", "time_online", "count_15days", "remark") == [
        ("1", "10:15", "11:20", 15, "Offline-Online"), ("2", "18:05", "07:30", 14, "Offline-Online"),
        # 30 tickets in all: only the total is reported.
        ("3", None, None, 30, "TotalTickets")]
    sites = frame("sites", [site(1), site(2), site(3)])
    assert rows(outages.recurring_patterns(got, sites, NOW), "site_id") == [("1",), ("2",)]
    assert rows(outages.frequent_sites(got, sites, NOW), "site_id", "count_3days") == [("3", 6)]


def test_outage_hour_pattern_and_night_rule(frame):
    minutes = ["18:%02d" % m for m in range(15)]
    moving = [episode(i, f"{16 + i} {minutes[i]}", f"{17 + i} 07:{i:02d}") for i in range(14)]
    base = outages.outage_base(frame("tickets", moving), NOW)
    got = outages.all_patterns(base, NOW)
    assert rows(got, "time_offline", "time_online", "remark") == [("18", "07", "Offline-Online")]
    sites = frame("sites", [site(1)])
    assert outages.business_hour_outages(base, got, sites, NOW).isEmpty()
    none = got.filter("false")
    night = outages.business_hour_outages(base, none, sites, NOW)
    assert rows(night, "count_3days", "count_7days", "count_15days") == [(2, 6, 14)]
    off_site = frame("sites", [site(1, on_site=0)])
    assert outages.business_hour_outages(base, none, off_site, NOW).isEmpty()
    strict = outages.business_hour_outages(base, none, off_site, NOW, outages.STRICT_NIGHT,
                                           on_site_only=False)
    assert strict.count() == 1


def faults(frame, *groups):
    out = []
    for site_name, field, value, count in groups:
        out += [{"bank": "B", "site_name": site_name, field: value, "opened_on": "29 10:00"} for _ in range(count)]
    return frame("fault_tickets", out)


def test_repeated_faults(frame):
    got = repeats.repeated_camera_faults(faults(
        frame, ("a", "camera_name", "Lobby Camera", 3), ("a", "camera_name", "Pinhole Camera", 2),
        ("b", "camera_name", "Garden Camera", 5)), NOW)
    assert rows(got, "site_name", "count_7days", "remark") == [("a", 3, "Lobby Camera")]
    disks = repeats.repeated_disk_faults(faults(
        frame, ("a", "error", "ENOENT", 3), ("b", "error", "ENODR", 4), ("c", "error", "ENOENT", 2),
        ("c", "error", "ENODR", 1), ("d", "error", "ENOENT", 3), ("d", "error", "EIO", 1),
        ("e", "error", "EIO", 2), ("e", "error", "ENODR", 1), ("f", "error", "ENOENT", 2)), NOW)
    assert rows(disks, "site_name", "count_7days", "remark") == [
        ("a", 3, "ENOENT"), ("b", 4, "ENODR"), ("c", 3, "ENOENT+ENODR"), ("d", 3, "ENOENT+ENODR"),
        ("e", 3, "Others")]


def disk(box, hdd, at, error="E"):
    return {"site_id": box, "box_id": f"b{box}", "hdd": hdd, "error": error, "at_time": at}


def open_ticket(i, box, error="E", at="29 00:00", **more):
    return {"ticket_id": i, "box_id": f"b{box}", "site_id": box, "site_name": f"S{box}", "error": error, "opened_on": at, **more}


def test_disk_ticket_lifecycle(frame):
    sites = frame("sites", [site(i) for i in range(1, 7)])
    status = frame("disk_status", [
        disk("1", "0", "30 23:55"), disk("2", "1", "30 23:55"), disk("2", "0", "30 23:54"),
        disk("3", "0", "30 23:40"), disk("4", "0", "30 23:55"), disk("5", "0", "30 23:50"), disk("9", "0", "30 23:55")])
    open_ = frame("fault_tickets", [open_ticket(1, "2"), open_ticket(2, "4"), open_ticket(3, "6"),
                                    open_ticket(4, "6", "F", "28 00:00")])
    signals = frame("recorder_signals", [
        {"box_id": b, "event_code": "REMOTERECORD", "at_time": at} for b, at in
        (("b4", "30 23:51"), ("b4", "30 23:56"), ("b1", "30 23:52"), ("b2", "30 23:52"), ("b6", "30 23:52"))])
    change = tickets.disk_tickets(sites, status, signals, open_, NOW)
    assert rows(change.opened, "box_id", "latest_remote_recording") == [("b1", None), ("b5", None)]
    assert rows(change.closed) == [(1,), (4,)]
    assert rows(change.touched) == [(2, t("30 23:56"))]
    after = apply_ticket_changes(open_, NOW, closed=change.closed, touched=change.touched, opened=change.opened)
    assert after.count() == 6 and after.select("ticket_id").distinct().count() == 6
    assert rows(after.filter("closed_on is not null"), "ticket_id", "closed_on") == [(1, t("31 00:00")), (4, t("31 00:00"))]
    # The same signals again open and close nothing.
    again = tickets.disk_tickets(sites, status, signals, after.filter("closed_on is null"), NOW)
    assert again.opened.isEmpty() and again.closed.isEmpty()
    by_error = tickets.disk_tickets(sites, status, signals, open_, close_on="box_error")
    assert rows(by_error.closed) == [(1,)]
    absent = tickets.disk_tickets(sites, status, signals, open_, close_on="absence")
    assert rows(absent.closed) == [(1,), (3,), (4,)]
    assert rows(absent.opened, "box_id") == [("b1",), ("b3",), ("b5",)]
    with pytest.raises(ValueError):
        tickets.disk_tickets(sites, status, signals, open_, close_on="?")


def cam(box, c, active=True):
    return {"box_id": f"b{box}", "camera_id": c, "camera_name": f"n{c}", "active": active}


def signal(box, c, at, status="1", code="RECORD"):
    return {"box_id": f"b{box}", "device_id": c, "event_code": code, "status": status, "at_time": at}


def test_camera_lag(frame):
    sites = frame("sites", [site(1), site(2)])
    cams = frame("cameras", [cam(1, "0701"), cam(1, "0702"), cam(1, "0703"), cam(2, "0701"), cam(2, "0702", False)])
    sig = frame("recorder_signals", [signal(1, "0701", "30 12:00"), signal(1, "0702", "30 11:00"),
                                     signal(1, "0703", "30 11:00:01"), signal(2, "0701", "30 01:00"), signal(2, "0702", "30 12:00")])
    open_ = frame("fault_tickets", [open_ticket(1, "1", camera_id="0703"), open_ticket(2, "1", camera_id="0702")])
    change = tickets.camera_lag_tickets(sites, cams, sig, open_.filter("ticket_id = 1"))
    assert rows(change.opened, "box_id", "camera_id") == [("b1", "0702")]
    assert rows(change.closed) == [(1,)]
    assert tickets.camera_lag_tickets(sites, cams, sig, open_).opened.isEmpty()


def test_camera_absent(frame):
    sites = frame("sites", [site(1), site(2)])
    cams = frame("cameras", [cam(1, "0701"), cam(1, "0702"), cam(1, "0703"), cam(2, "0701")])
    sig = frame("recorder_signals", [signal(1, "0701", "30 23:30"), signal(1, "0702", "30 23:29:59"), signal(2, "0701", "30 23:00")])
    open_ = frame("fault_tickets", [open_ticket(1, "1", camera_id="0701"), open_ticket(2, "1", camera_id="0703", camera_name="n0703")])
    change = tickets.camera_absent_tickets(sites, cams, sig, open_, NOW)
    assert rows(change.opened, "box_id", "camera_id", "opened_on") == [("b1", "0702", t("31 00:00"))]
    assert rows(change.closed) == [(1,)]


def test_lobby_exactly_five_minutes_decides_nothing(frame):
    sites = frame("sites", [site(i) for i in range(1, 5)])
    sig = frame("recorder_signals", [
        signal(1, "0702", "30 23:55:00"), signal(2, "0702", "30 23:53:59"), signal(3, "0702R", "30 23:56", "-1"),
        signal(4, "0702", "30 23:56"), signal(4, "0703", "30 23:59", "-1")])
    open_ = frame("fault_tickets", [open_ticket(i, str(i)) for i in (1, 3, 4)])
    plain = tickets.lobby_stale_tickets(sites, sig, open_, NOW)
    assert (rows(plain.opened, "site_id"), rows(plain.closed)) == ([("2",)], [(3,), (4,)])
    nothing_open = open_.filter("false")
    strict = tickets.lobby_stale_tickets(sites, sig, nothing_open, NOW, use_status=True)
    assert rows(strict.opened, "site_id") == [("2",), ("3",)]
    assert rows(tickets.lobby_stale_tickets(sites, sig, open_, NOW, use_status=True).closed) == [(4,)]


def test_ticket_day_report(frame):
    spans = [("14 10:00", "14 12:00"), ("14 10:00", "15 00:00"), ("15 10:00", None), ("16 00:00", None),
             ("01 10:00", None), ("14 10:00", "20 10:00")]
    out = tickets.ticket_day_report(frame("fault_tickets", [
        {"ticket_id": i, "opened_on": a, "closed_on": z} for i, (a, z) in enumerate(spans)]), "2024-01-15")
    assert rows(out, "ticket_id") == [(1,), (2,), (4,), (5,)]


def test_dashboard_bands(frame):
    def door(i, opens, sensor=1, status="Closed", at="30 23:00", closed=None, bank="B"):
        return {"ticket_id": i, "bank": bank, "site_name": "S", "opened_on": at, "closed_on": closed,
                "main_door_open": opens, "main_door_status": status, "main_door_sensor": sensor}

    doors = frame("door_events", [
        door(1, 12), door(2, 11), door(3, 8), door(4, 7), door(5, 4), door(6, 3), door(7, 0, 0),
        door(8, 0, 1, "Opened"), door(9, 20, at="30 21:59"), door(10, 20, closed="30 23:30"), door(11, 12, bank="C")])
    near = frame("near_violation", [{"bank": "B", "event_type": "SOS", "required_action": "TicketToAck"}])
    daily = frame("video_daily", []).select(
        "date", "bank", *[F.lit(1).alias(m) for m in dashboard.VIOLATIONS])
    row = dashboard.dashboard_counts(doors, doors, near, daily, NOW, banks=["B"]).first().asDict()
    assert [row[f"motion_{k}"] for k in ("all", ">12", ">8", ">4", "DoorOff", "DoorOpened")] == [8, 1, 2, 2, 1, 1]
    assert (row["near_SOSAck"], row["near_CriticalClose"], row["violated_All"]) == (1, 0, 0)
    assert dashboard.dashboard_counts(doors, doors, near, daily, NOW).first()["door_all"] == 9
    assert rows(dashboard.door_records(doors, NOW, ">12"), "ticket_id", "site_tickets") == [(1, 2), (11, 2)]


def test_violation_ranges(spark):
    days = ["2023-12-31", "2024-01-01", "2024-01-24", "2024-01-30", "2024-01-31"]
    daily = spark.createDataFrame([(d, "B", 1, 0, 0, 0) for d in days],
                                  "date string, bank string, sos_ack int, sos_close int, critical_ack int, critical_close int"
                                  ).withColumn("date", F.to_date("date"))
    got = {tile: dashboard.violation_records(daily, "2024-01-31 09:00:00", tile).first()["total_violations"]
           for tile in ("All", "Yesterday", "Last7Days", "Last30Days")}
    assert got == {"All": 4, "Yesterday": 1, "Last7Days": 2, "Last30Days": 3}


def test_sensor_labels_and_risk(frame):
    sites = frame("sites", [site(1), site(2)])
    items = frame("installed_items", [
        {"site_id": s, "group_no": "01", "unit_no": u, "item_name": n, "active": True, "enabled": True}
        for s, u, n in (("1", "36", "Lobby Motion Detector"), ("1", "33", "Main Door Sensor"), ("2", "33", None), ("1", "99", "x"))])
    words = frame("event_dictionary", [{"group_no": "01", "unit_no": u, "event_code": c} for u in ("33", "36") for c in ("20", "40")])
    sig = frame("sensor_signals", [{"site_id": s, "group_no": "01", "unit_no": u, "event_code": c, "at_time": at} for s, u, c, at in (
        ("1", "36", "40", "16 00:00:01"), ("1", "36", "20", "01 00:00:01"), ("1", "33", "59", "30 00:00"), ("2", "33", "40", "01 00:00"))])
    recency = sensors.sensor_recency(items, sig, words, NOW)
    assert rows(recency, "site_id", "unit_no", "trigger_label", "heartbeat_label") == [
        ("1", "33", sensors.NO_TRIGGER, sensors.NO_TRIGGER), ("1", "36", "<15days", "15-30days"),
        ("2", "33", "1-3months", sensors.NO_TRIGGER)]
    columns = {"Lobby Movement Sensor": "motion", "Main Door Sensor": "door"}
    matrix = sensors.sensor_matrix(recency, sites, columns, NOW, "heartbeat")
    assert rows(matrix, "site_id", "motion", "door") == [
        ("1", "15-30days", sensors.NO_TRIGGER), ("2", None, sensors.NO_TRIGGER)]
    video = frame("video_daily", [{"site_id": "1", "site_availability": 0.0}, {"site_id": "1", "site_availability": 5.0},
                                  {"site_id": "2", "site_availability": 0.0}])
    risk = sensors.sensor_risk(matrix, ["motion", "door"], video)
    assert rows(risk, "site_id", "risk_score") == [("1", 14)]
    assert rows(sensors.sensor_risk(matrix, ["motion", "door"], video, weighted=False), "risk_score") == [(7,)]
    assert rows(sensors.sensor_priority(risk), "priority") == [("P1",)]


def test_site_priority(frame):
    sites = frame("sites", [site(i) for i in range(1, 6)])
    made = [ticket(i, "30 23:00", "30 23:30", unit_no="01", group_no="36", site_id="1", msg=f"v{i}") for i in range(3)]
    made += [ticket(10, "29 12:00", "29 12:30", unit_no="01", group_no="36", site_id="2"),
             ticket(11, "29 12:00", "29 13:00", unit_no="01", group_no="32", site_id="3", closing_reason="SECURITY came"),
             ticket(12, "20 12:00", "20 13:00", unit_no="01", group_no="36", site_id="4")]
    got = priority.site_features(sites, frame("tickets", made), NOW)
    assert rows(got, "site_id", "security", "manual_closure", "footfall", "night_visit") == [
        ("1", 0, 4, 5, 5), ("2", 0, 1, 4, 3), ("3", 1, 2, 2, 3), ("4", 0, 1, 2, 3), ("5", 0, 1, 2, 3)]
    quiet = priority.site_features(sites, frame("tickets", []), NOW)
    assert rows(quiet.select("manual_closure", "footfall", "night_visit").distinct()) == [(1, 0, 0)]
    ranked = {r["site_id"]: r["site_priority"] for r in priority.site_priority(got).collect()}
    assert ranked["1"] == "S5" and ranked["4"] == ranked["5"]


def test_portfolio_title_case(frame):
    data = frame("portfolio", [{"site_id": str(i), "state": s, "bank_name": "b", "customer": "c", "city": "x"}
                               for i, s in enumerate(("Tamil NAdu", "tamil nadu ", "Kerala", None))])
    shares = portfolio.portfolio_shares(data)
    assert rows(shares["state"]) == [("Kerala", 1, 25.0), ("Tamil Nadu", 2, 50.0)]
    assert rows(shares["bank"]) == [("b", 4, 100.0)]
    assert rows(shares["customer_state"], "percentage") == [(0.25,), (0.5,)]


def test_earliest_record_per_camera_name(frame):
    """Two ids of one camera: the first record of the day counts, not the sum of both."""
    cams = frame("cameras", [{"box_id": "b1", "camera_id": c, "camera_name": "Lobby Camera", "active": True}
                             for c in ("0702", "0702R")])
    records = frame("recording_counts", [
        {"box_id": "b1", "camera_id": "0702", "file_count": 500, "at_time": "29 01:00"},
        {"box_id": "b1", "camera_id": "0702R", "file_count": 400, "at_time": "29 02:00"},
        {"box_id": "b1", "camera_id": "0702", "file_count": 900, "at_time": "29 03:00"}])
    out = availability.video_availability(
        frame("sites", [site(1)]), cams, records, frame("tickets", []), frame("heartbeats", []),
        "2024-01-29", "2024-01-29", {"LobbyCamera": "lobby"})
    assert rows(out, "lobby", "video_pct") == [(50.0, 50.0)]


def test_months_are_dropped_on_request_only(spark):
    feed = spark.createDataFrame([("s", m, 1.0) for m in (7, 8, 9)], "site string, month int, amount double")
    assert penalties.consolidate({"a": feed}).count() == 3
    assert penalties.consolidate({"a": feed}, drop_months=(8, 9)).count() == 1


def test_last_bands_are_open(spark, frame):
    paid = spark.createDataFrame([("s", 4, 120_000.0)], "site string, month int, amount double")
    assert penalties.penalty_trend(paid).first()["bucket"] == ">20000"
    items = frame("installed_items", [{"site_id": "1", "group_no": "01", "unit_no": "33", "item_name": "n", "active": True}])
    words = frame("event_dictionary", [{"group_no": "01", "unit_no": "33", "event_code": "40"}])
    old = frame("sensor_signals", [{"site_id": "1", "group_no": "01", "unit_no": "33", "event_code": "40",
                                    "at_time": "1800-01-01 00:00"}])
    assert sensors.sensor_recency(items, old, words, NOW).first()["trigger_label"] == ">1year"
