"""One call per job: read the stored tables, compute, store the result the way reports expect.

Daily tables are cut by date and a run covers the customers in ``sites``, so running a day again
replaces it. Tables that are replaced by customer, and ticket tables, are cut into buckets, and a run
writes the buckets it changes. Tables that are rewritten as a whole are versioned folders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.functions import as_of, days_before
from sitepulse.operators import active_sites, latest_per_key
from sitepulse.plans import (
    availability, dashboard, footage, outages, penalties, portfolio, priority, recordings, repeats,
    sensors, sla, slots, tickets,
)
from sitepulse.schemas import schema
from sitepulse.session import reuse
from sitepulse.sources import (
    canonical_names, current_version, day_slice, replace_table, scope, write_csv, write_sheets,
)
from sitepulse.sources.files import FileIndex
from sitepulse.sources.parts import KeyedTable, PartTable, TicketTable, read_parts
from sitepulse.sources.writers import finished_versions


# Hours for which a replaced version stays for its readers.
KEEP_HOURS = 24.0


@dataclass(frozen=True)
class Store:
    """Tables by name under one folder that all executors can reach."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """A plain table, or the newest state of a versioned one, with the names used here."""
        parts = read_parts(self.spark, self.path(name))
        if parts is not None:
            return canonical_names(parts)
        if finished_versions(self.spark, self.path(name)):
            return canonical_names(current_version(self.spark, self.path(name)))
        return canonical_names(self.spark.read.parquet(self.path(name)))

    def sites(self) -> DataFrame:
        """Sites in service, without test tenants; customers out of service drop theirs.

        A site table without the flags, or a store without a customer table, is taken as clean.
        """
        sites = self.read("sites")
        customers = self.read("customers") if self._has("customers") else None
        if "active" not in sites.columns:
            sites = sites.withColumn("active", F.lit(True))
        known = "status" in sites.columns
        return active_sites(sites, customers, require_status=known, drop_test=True)

    def _has(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def ticket_table(self, name: str) -> TicketTable:
        """Fault tickets; empty before the first run. A table of whole versions is taken over."""
        table = TicketTable(self.spark, self.path(name), schema("fault_tickets"))
        if not table.exists() and finished_versions(self.spark, self.path(name)):
            table.begin(self.read(name))
        return table

    def daily(self, df: DataFrame, name: str, day: str) -> None:
        """Replace one day; the others are not touched."""
        PartTable(self.spark, self.path(name), "date").replace(
            df.withColumn("date", F.lit(day).cast("date")), [day])

    def customers(self, df: DataFrame, name: str, sites: DataFrame) -> None:
        """Replace the rows of the customers in ``sites``, also by nothing."""
        KeyedTable(self.spark, self.path(name), ["bank"]).replace_keys(df, sites)

    def whole(self, df: DataFrame, name: str) -> None:
        """Replace all rows of a table that is otherwise replaced by customer."""
        KeyedTable(self.spark, self.path(name), ["bank"]).replace_all(df)


def sla_daily(store: Store, day: str, asof: str | None = None) -> None:
    """Violations of one day per customer and site, and the list of late tickets."""
    end = as_of(day) + F.make_dt_interval(F.lit(1))
    kept = store.read("tickets").filter(
        (F.col("opened_on") >= as_of(day)) & (F.col("opened_on") < end))
    notes = store.read("remarks").filter(
        (F.col("updated_on") >= as_of(day)) & (F.col("updated_on") < end))
    sites = store.sites()
    rated = reuse(sla.rated_tickets(kept, notes, as_of(asof) if asof else end))
    store.daily(sla.bank_violations(rated, sites), "sla_bankwise", day)
    store.daily(sla.site_violations(rated, sites, day, day), "sla_sitewise", day)
    store.daily(sla.violated_tickets(rated, sites), "tickets_violated", day)


def near_violation(store: Store, asof: str) -> None:
    """The current list of urgent tickets and the counts per class, for all customers."""
    sites = store.sites()
    due = reuse(sla.open_tickets(store.read("tickets"), store.read("remarks"), sites, asof))
    store.customers(sla.near_violation(due), "near_violation", sites)
    store.customers(sla.class_summary(due, sites), "ticket_class_counts", sites)


def slot_counts(store: Store, kind: str, day: str) -> None:
    """``kind``: critical, door or motion."""
    at, unit, pick = {
        "critical": ("opened_on", None, slots.critical_sensor_events),
        "door": ("at_time", slots.DOOR_UNIT, slots.door_events),
        "motion": ("opened_on", slots.MOTION_UNIT, slots.motion_events)}[kind]
    end = as_of(day) + F.make_dt_interval(F.lit(1))
    events = store.read("tickets").filter((F.col(at) >= as_of(day)) & (F.col(at) < end))
    sites = store.sites()
    installed = slots.installed_sites(store.read("installed_items"), unit)
    store.daily(slots.slot_counts(pick(events), at, sites, installed, day, day),
                f"slots_{kind}", day)
    if kind == "door":
        portfolio.publish_site_master(sites, store.path("site_master"))


def _apply(table: TicketTable, change: tickets.Changes, asof: str) -> None:
    table.apply(asof, closed=change.closed, touched=change.touched, opened=change.opened)


def disk_tickets(store: Store, asof: str, **options) -> None:
    current = store.ticket_table("disk_tickets")
    change = tickets.disk_tickets(
        store.sites(), store.read("disk_status"), store.read("recorder_signals"),
        current.open(), asof, **options)
    _apply(current, change, asof)


def camera_tickets(store: Store, asof: str, **options) -> None:
    current = store.ticket_table("camera_tickets")
    change = tickets.camera_absent_tickets(
        store.sites(), store.read("cameras"), store.read("recorder_signals"),
        current.open(), asof, **options)
    _apply(current, change, asof)


def _signal_files(store: Store) -> tuple[FileIndex, int]:
    """The index of signal files, and the version up to which the stored signals have read them."""
    done = finished_versions(store.spark, store.path("latest_signals"))
    return FileIndex(store.spark, store.path("recorder_signals"), store.path("signals_read")), (
        done[-1] if done else 0)


def _unread_files(store: Store) -> DataFrame:
    """Files that the stored latest signals don't contain."""
    index, version = _signal_files(store)
    return index.unread(version)


def new_signals(store: Store, overlap_minutes: int = 60,
                files: DataFrame | None = None) -> DataFrame:
    """All signals in files that no poll has read, and the newest ones of the other files.

    Files are written once, so a file that was read has nothing new, whatever the times in it.
    """
    index, version = _signal_files(store)
    fresh = index.rows_of(_unread_files(store) if files is None else files).drop("_file")
    if not version:
        return fresh
    last = store.read("latest_signals").agg(F.max("at_time")).first()[0]
    again = None if last is None else index.recent(version, last, overlap_minutes)
    return fresh if again is None else again.unionByName(fresh)


def latest_signals(store: Store, overlap_minutes: int = 60) -> DataFrame:
    """The latest signal per box, device and code, brought up to date and stored.

    A poll reads the files that came since the last one only, so a late upload counts and a fast
    clock hides nothing, and a camera that has been silent for months keeps its last signal. The
    list of unread files is stored first: a file that comes meanwhile is for the next poll. The
    index gets them under the version they belong to, before that version is finished.
    """
    key = ["box_id", "device_id", "event_code"]
    index, done = _signal_files(store)
    files = reuse(index.unread(done))
    fresh = new_signals(store, overlap_minutes, files)
    columns = [c for c in (*key, "at_time", "status") if c in fresh.columns]
    fresh = fresh.select(*columns)
    if done:
        fresh = store.read("latest_signals").unionByName(fresh)
    latest = latest_per_key(fresh, key, [c for c in columns if c not in key])
    index.append(index.rows_of(files), files, done + 1)
    replace_table(latest, store.path("latest_signals"), version=done + 1, keep_hours=KEEP_HOURS)
    return store.read("latest_signals")


def camera_lag_tickets(store: Store, asof: str, **options) -> None:
    current = store.ticket_table("camera_lag_tickets")
    change = tickets.camera_lag_tickets(
        store.sites(), store.read("cameras"), latest_signals(store),
        current.open(), **options)
    _apply(current, change, asof)


def lobby_tickets(store: Store, asof: str, **options) -> None:
    current = store.ticket_table("lobby_tickets")
    change = tickets.lobby_stale_tickets(
        store.sites(), latest_signals(store), current.open(), asof, **options)
    _apply(current, change, asof)


def lobby_day_report(store: Store, day: str) -> None:
    report = tickets.ticket_day_report(store.ticket_table("lobby_tickets").read(), day)
    write_sheets({"lobby": report}, store.path(f"reports/lobby-{day}"))


def repeated_faults(store: Store, asof: str) -> None:
    """Both lists are replaced as a whole, and stay when the new list is empty."""
    for name, find in (("camera", repeats.repeated_camera_faults),
                       ("disk", repeats.repeated_disk_faults)):
        replace_table(find(store.ticket_table(f"{name}_tickets").read(), asof),
                      store.path(f"{name}_faults_repeated"), skip_empty=True,
                      keep_hours=KEEP_HOURS)


def outage_patterns(store: Store, asof: str,
                    messages: Sequence[str] = sla.OFFLINE_MESSAGES) -> None:
    """Patterns, frequent sites and night outages of the day, in one table."""
    sites = store.sites()
    base = reuse(outages.outage_base(
        store.read("tickets").filter(F.col("msg").isin(list(messages))), asof))
    found = reuse(outages.all_patterns(base, asof))
    rows = (outages.recurring_patterns(found, sites, asof)
            .unionByName(outages.frequent_sites(found, sites, asof), allowMissingColumns=True)
            .unionByName(outages.business_hour_outages(base, found, sites, asof),
                         allowMissingColumns=True))
    store.daily(rows, "outage_patterns", asof[:10])


def _counted_episodes(store: Store) -> PartTable:
    """Which episode counts from which day on, by that day and the day it began."""
    return PartTable(store.spark, store.path("outage_episodes"), "counts_from", ("at_day",))


def _clock_changes(store: Store) -> PartTable:
    return PartTable(store.spark, store.path("outage_clock"), "counts_from")


def outage_load(store: Store, first: str, last: str,
                messages: Sequence[str] = sla.OFFLINE_MESSAGES) -> None:
    """Begin the kept clock table with the days from ``first`` to ``last``, in one pass."""
    days = store.spark.sql(f"select explode(sequence(date'{first}', date'{last}')) as d")
    listed = [str(r["d"]) for r in days.collect()]  # one row a day
    rows = outages.counting_rows(store.read("tickets").filter(F.col("msg").isin(list(messages))))
    counted = reuse(outages.counted_once(rows.filter(
        F.col("counts_from").between(F.lit(first).cast("date"), F.lit(last).cast("date")))))
    _counted_episodes(store).replace(counted.drop("replaces"), listed)
    _clock_changes(store).replace(outages.clock_changes(counted), listed)


def outage_add_day(store: Store, day: str,
                   messages: Sequence[str] = sla.OFFLINE_MESSAGES) -> None:
    """Add the episodes that count from ``day`` on (they closed the day before).

    Reads their rows and the stored episodes that began on the same days, for repeats; the days of
    the look-back are not read again. Days are added in order; a day can be added again.
    """
    begins = F.date_sub(F.lit(day).cast("date"), outages.HORIZONS[-1])
    # Only what can still be in the look-back of a day from now on, and pushed to the scan.
    tickets = store.read("tickets").filter(F.col("msg").isin(list(messages)) & (
        F.col("at_time") >= begins.cast("timestamp_ntz")))
    new = reuse(outages.counting_rows(tickets).filter(
        F.col("counts_from") == F.lit(day).cast("date")))
    known = _counted_episodes(store)
    rows = new
    if known.exists():
        began = [r["at_day"] for r in new.select("at_day").distinct().collect()]  # 16 days or so
        rows = rows.unionByName(known.read().filter(
            F.col("at_day").isin(began) & (F.col("counts_from") < F.lit(day).cast("date"))))
    counted = reuse(outages.counted_once(rows).filter(
        F.col("counts_from") == F.lit(day).cast("date")))
    known.replace(counted.drop("replaces"), [day])
    _clock_changes(store).replace(outages.clock_changes(counted), [day])


def kept_outages(store: Store, asof: str, limits: outages.Thresholds = outages.Thresholds()
                 ) -> DataFrame:
    """Patterns, frequent sites and night outages of the day from the kept clock table."""
    sites = store.sites()
    clock = reuse(outages.kept_clock(_clock_changes(store).read(_days_back(
        store, asof, outages.HORIZONS[-1])), asof))
    found = reuse(outages.patterns_of(clock, limits))
    return (outages.recurring_patterns(found, sites, asof)
            .unionByName(outages.frequent_sites(found, sites, asof), allowMissingColumns=True)
            .unionByName(outages.night_outages(clock, found, sites, asof, limits.night),
                         allowMissingColumns=True))


def _days_back(store: Store, asof: str, days: int) -> list[str]:
    today = F.to_date(as_of(asof))
    row = store.spark.range(1).select(F.sequence(F.date_sub(today, days), today).alias("d")).first()
    return [str(d) for d in row["d"]]


def video_daily(store: Store, day: str, camera_names: Mapping[str, str],
                messages: Sequence[str] = sla.OFFLINE_MESSAGES) -> None:
    episodes = store.read("tickets").filter(F.col("msg").isin(list(messages)) & F.col("active"))
    store.daily(availability.video_availability(
        store.sites(), store.read("cameras"), store.read("recording_counts"), episodes,
        store.read("heartbeats"), day, day, camera_names), "video_daily", day)


def footage_answers(store: Store, asof: str, **options) -> None:
    """Answers to all stored requests, from the tickets the other jobs keep."""
    episodes = store.read("tickets").filter(F.col("msg").isin(list(sla.OFFLINE_MESSAGES)))
    answers = footage.footage_status(
        store.read("footage_requests"), footage.lobby_availability(store.read("recording_counts")),
        episodes, store.ticket_table("lobby_tickets").read(),
        store.ticket_table("disk_tickets").read(), **options)
    store.daily(answers, "footage_answers", asof[:10])


def vod_daily(store: Store, day: str) -> None:
    sites = store.sites()
    recorded = day_slice(store.read("recording_counts"), "at_time", day,
                         as_of(day) + F.make_dt_interval(F.lit(1)))
    matrix = reuse(recordings.camera_matrix(
        store.read("cameras"), recordings.daily_totals(recorded), day, day))
    daily = recordings.vod_daily(sites, matrix)
    store.daily(daily, "vod_daily", day)
    store.daily(recordings.vod_summary(daily), "vod_summary", day)
    store.daily(recordings.vod_counts(sites, matrix), "vod_counts", day)


def vod_report(store: Store, last_day: str, dates: Mapping[str, str],
               banks: Sequence[str] | str = "ALL") -> None:
    """Sheets over the listed dates (date text -> column name)."""
    listed = [F.lit(d).cast("date") for d in dates]
    daily = scope(store.read("vod_daily"), banks).filter(F.col("date").isin(listed))
    counts = scope(store.read("vod_counts"), banks)
    write_sheets(recordings.vod_report(daily, counts, dates, last_day),
                 store.path(f"reports/vod-{last_day}"))


def sensor_matrices(store: Store, asof: str, columns: Mapping[str, str]) -> None:
    """Last trigger and last heartbeat, replaced for the customers in ``sites``."""
    sites = store.sites()
    recency = reuse(sensors.sensor_recency(store.read("installed_items"),
                                           store.read("sensor_signals"),
                                           store.read("event_dictionary"), asof))
    for kind in ("trigger", "heartbeat"):
        matrix = sensors.sensor_matrix(recency, sites, columns, asof, kind)
        store.customers(matrix.withColumn("priority", F.lit(None).cast("string")),
                        f"sensor_{kind}", sites)


def sensor_priority(store: Store, asof: str, columns: Sequence[str], *, weighted: bool = True,
                    edges: Sequence[float] = sensors.RANK_EDGES, days: int = 15) -> None:
    """Both matrices with the priority of each site at risk, most urgent first."""
    first = F.to_date(days_before(asof, days, whole_days=True))
    online = store.read("video_daily").filter(F.col("date") >= first).select(
        "site_id", F.col("site_pct").alias("site_availability"))
    for kind in ("trigger", "heartbeat"):
        matrix = store.read(f"sensor_{kind}").drop("priority")
        risk = reuse(sensors.sensor_risk(matrix, columns, online, weighted=weighted))
        ranked = sensors.most_urgent_first(sensors.sensor_priority(risk, edges))
        store.whole(ranked.drop("risk_score"), f"sensor_{kind}")


def site_features(store: Store, asof: str) -> None:
    sites = store.sites()
    features = priority.site_features(sites, store.read("tickets"), asof)
    store.customers(features.withColumn("site_priority", F.lit(None).cast("string")),
                    "site_priority", sites)


def site_priority(store: Store) -> None:
    """Ranks all stored sites and rewrites the table it reads."""
    features = store.read("site_priority").drop("site_priority")
    store.whole(priority.site_priority(features), "site_priority")


def penalty_tickets(store: Store, month: str) -> None:
    found = penalties.penalty_tickets(store.read("tickets"), store.read("remarks"),
                                      store.sites(), month)
    write_csv(found, store.path(f"reports/penalty-{month}"))


def penalty_consolidation(store: Store, feeds: Mapping[str, DataFrame], *,
                          drop_months: Sequence[int] = ()) -> None:
    merged = penalties.month_names(penalties.consolidate(feeds, drop_months=drop_months))
    write_csv(merged.orderBy(F.desc("total"), "site", "month"),
              store.path("reports/penalty-consolidated"))


def dashboard_document(store: Store, asof: str, *, hours: int = 2,
                       banks: Sequence[str] | str = "ALL") -> DataFrame:
    """One JSON document with all tiles, from the stored tables."""
    return dashboard.dashboard_document(dashboard.dashboard_counts(
        store.read("motion_events"), store.read("door_events"), store.read("near_violation"),
        store.read("sla_bankwise"), asof, hours=hours, banks=banks))


def dashboard_records(store: Store, table: str, tile: str, asof: str, *, hours: int = 2,
                      banks: Sequence[str] | str = "ALL") -> DataFrame:
    """Rows behind a tile of ``motion_events``, ``door_events``, ``near_violation`` or
    ``sla_bankwise``."""
    df = store.read(table)
    if table == "near_violation":
        return dashboard.near_violation_records(df, tile, banks=banks)
    if table == "sla_bankwise":
        return dashboard.violation_records(df, asof, tile, banks=banks)
    return dashboard.door_records(df, asof, tile, hours=hours, banks=banks)
