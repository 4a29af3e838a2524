"""Dashboard tiles and their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse import bindings as b
from sitepulse.bindings import with_views
from sitepulse.catalog.jobs import _COUNTS, _OPEN, _RATED, _rated, open_due
from sitepulse.catalog.registry import query
from sitepulse.plans import dashboard, sla

ASOF_SQL = f"timestamp '{b.ASOF}'"
HOURS = 30 * 24
_OPEN_DOORS = f"closed_on is null and opened_on >= {ASOF_SQL} - interval {HOURS} hour"
_TESTS = {
    ">12": "main_door_open >= 12", ">8": "main_door_open >= 8 and main_door_open < 12",
    ">4": "main_door_open >= 4 and main_door_open < 8",
    "DoorOff": "main_door_open = 0 and main_door_sensor = 0",
    "DoorOpened": "main_door_open = 0 and main_door_status = 'Opened' and main_door_sensor <> 0",
}
_ACTIONS = {f"{c}{a}": f"event_type = '{c}' and required_action = 'TicketTo{a}'"
            for c in ("SOS", "Critical") for a in ("Ack", "Close")}
_RANGES = {"All": "date >= date '2024-01-01'", "Yesterday": "date = date '2024-01-30'",
           "Last7Days": "date >= date '2024-01-24' and date < date '2024-01-31'",
           "Last30Days": "date >= date '2024-01-01' and date < date '2024-01-31'"}
_VIOLATIONS = "sos_ack + sos_close + critical_ack + critical_close"
_DAILY = ("daily", f"select date, bank, count(*) as total_tickets, {_COUNTS} from rated "
                   "join sites using (site_id) group by date, bank")
_VIEWS = "doors tickets remarks sites"
_STEPS = (*_OPEN, *_RATED, _DAILY)


def _counts(spark: SparkSession, sf: str, banks="ALL") -> DataFrame:
    sites = b.sites(spark, sf)
    return dashboard.dashboard_counts(
        b.door_events(spark, sf, "purchase"), b.door_events(spark, sf, "click"),
        sla.near_violation(open_due(spark, sf)), sla.bank_violations(_rated(spark, sf), sites),
        b.ASOF, hours=HOURS, banks=banks)


def _cells(scope: str = "true") -> str:
    cells = []
    for prefix, event_type, names in (("motion", "purchase", list(_TESTS)),
                                      ("door", "click", [">12", ">8", ">4"])):
        base = f"from doors where event_type = '{event_type}' and {_OPEN_DOORS} and {scope}"
        cells.append(f"(select count(*) {base}) as {prefix}_all")
        cells += [f"(select count(*) {base} and {_TESTS[n]}) as \"{prefix}_{n}\"" for n in names]
    cells.append(f"(select count(*) from near where {scope}) as near_all")
    cells += [f"(select count(*) from near where {t} and {scope}) as \"near_{n}\""
              for n, t in _ACTIONS.items()]
    cells += [f"(select cast(coalesce(sum({_VIOLATIONS}), 0) as bigint) from daily where {t} and "
              f"{scope}) as \"violated_{n}\"" for n, t in _RANGES.items()]
    return "select " + ", ".join(cells)


@query("dashboard_counts", with_views(_VIEWS, _cells(), *_STEPS))
def _(spark, sf):
    return _counts(spark, sf)


@query("dashboard_counts_two_banks", with_views(
    _VIEWS, _cells("bank in ('BUILDING', 'FURNITURE')"), *_STEPS))
def _(spark, sf):
    return _counts(spark, sf, ["BUILDING", "FURNITURE"])


# Box -> (title, source table, subtitle, total, sub-totals) of the JSON document.
_BOXES = {
    "box1": (dashboard.MOTION_TITLE, dashboard.MOTION_TABLE, dashboard.OPENS_SUBTITLE, "motion_all",
             [f"motion_{n}" for n in (">12", ">8", ">4", "DoorOff", "DoorOpened")]),
    "box2": (dashboard.DOOR_TITLE, dashboard.DOOR_TABLE, dashboard.OPENS_SUBTITLE, "door_all",
             [f"door_{n}" for n in (">12", ">8", ">4")]),
    "box3": (dashboard.NEAR_TITLE, dashboard.NEAR_TABLE, dashboard.NEAR_SUBTITLE, "near_all",
             [f"near_{n}" for n in ("SOSAck", "SOSClose", "CriticalAck", "CriticalClose")]),
    "box4": (dashboard.VIOLATED_TITLE, dashboard.VIOLATED_TABLE, dashboard.VIOLATED_SUBTITLE,
             "violated_All", [f"violated_{n}" for n in ("Yesterday", "Last7Days", "Last30Days")]),
}


def _boxes_sql() -> str:
    rows = []
    for box, (title, source, subtitle, total, parts) in _BOXES.items():
        texts = {"title": f"'{title}'", "tablename": f"'{source}'", "subtitle": f"'{subtitle}'",
                 "total": f'cast("{total}" as varchar)',
                 **{"sub-total " + p.split("_", 1)[1]: f'cast("{p}" as varchar)' for p in parts}}
        rows += [f"select '{box}' as box, '{key}' as key, {value} as value from cells"
                 for key, value in texts.items()]
    return f"with cells as ({_cells()}) " + " union all ".join(rows)


@query("dashboard_document", with_views(_VIEWS, f"select * from ({_boxes_sql()})", *_STEPS))
def _(spark, sf):
    """Every value of the JSON document, one row each."""
    spots = []
    for box, (_, _, _, _, parts) in _BOXES.items():
        paths = {key: f"$.{box}.{key}" for key in ("title", "tablename", "subtitle", "total")}
        paths |= {"sub-total " + n: f"$.{box}['sub-total']['{n}']"
                  for n in (p.split("_", 1)[1] for p in parts)}
        spots += [F.struct(F.lit(box).alias("box"), F.lit(key).alias("key"),
                           F.get_json_object("document", path).alias("value"))
                  for key, path in paths.items()]
    document = dashboard.dashboard_document(_counts(spark, sf))
    return document.select(F.inline(F.array(*spots)))


def _door_records(tile: str) -> str:
    test = "true" if tile == "All" else _TESTS[tile]
    return with_views("doors", f"""
        select ticket_id, bank, site_name, opened_on, main_door_open,
          count(*) over (partition by site_name) as site_tickets, 'Site Link' as site_url
        from doors where event_type = 'purchase' and {_OPEN_DOORS} and {test}""")


for _tile, _name in (("All", "all"), (">12", "over_12"), ("DoorOff", "door_off"),
                     ("DoorOpened", "door_opened")):
    def _doors(spark, sf, tile=_tile):
        return dashboard.door_records(b.door_events(spark, sf, "purchase"), b.ASOF, tile,
                                      hours=HOURS)

    query(f"door_records_{_name}", _door_records(_tile))(_doors)


@query("near_violation_records", with_views("tickets remarks sites", f"""
    select bank, site_name, event_id, event_type, msg, opened_on, age_minutes, required_action,
      count(*) over (partition by site_name) as site_tickets
    from near where {_ACTIONS['SOSClose']} and bank in ('BUILDING', 'MACHINERY')""", *_OPEN))
def _(spark, sf):
    return dashboard.near_violation_records(sla.near_violation(open_due(spark, sf)), "SOSClose",
                                            banks=["BUILDING", "MACHINERY"])


@query("near_violation_list", with_views("tickets remarks sites", f"""
    select * from near where {_ACTIONS['CriticalAck']}""", *_OPEN))
def _(spark, sf):
    return dashboard.near_violation_records(sla.near_violation(open_due(spark, sf)),
                                            "CriticalAck", counted=False)


_SUMS = ", ".join(f"cast(sum({m}) as bigint) as {m}" for m in dashboard.VIOLATIONS)


@query("violation_records", with_views("tickets remarks sites", " union all ".join(
    f"select '{n}' as tile, bank, cast(sum({_VIOLATIONS}) as bigint) as total_violations, {_SUMS} "
    f"from daily where {t} group by bank" for n, t in _RANGES.items()), *_RATED, _DAILY))
def _(spark, sf):
    # Stands for the stored daily table; each tile is a query of its own.
    daily = sla.bank_violations(_rated(spark, sf), b.sites(spark, sf))
    parts = [dashboard.violation_records(daily, b.ASOF, tile).select(
        F.lit(tile).alias("tile"), "*") for tile in _RANGES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
