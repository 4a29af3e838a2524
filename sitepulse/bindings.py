"""The sample tables read as site-monitoring inputs.

Every view covers its whole table. The SQL twin of each view is in ``VIEW_SQL``; both are fixed
readings of the same columns (``k`` is the number stored in ``events.props``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitepulse.functions import recode

ASOF = "2024-01-31 00:00:00"
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-30"

# Event types read as ticket classes, sensor units, cameras.
CLASSES = {"error": "SOS", "signup": "Critical"}
UNITS = {"view": "36", "click": "33", "purchase": "32", "error": "08", "signup": "12"}
CAMERAS = {"view": "0701", "click": "0702", "signup": "0702R", "purchase": "0703",
           "error": "0704"}
CAMERA_NAMES = {"0701": "Outdoor Camera", "0702": "Lobby Camera", "0702R": "Lobby Camera",
                "0703": "Backroom Camera", "0704": "Pinhole Camera"}
SENSOR_NAMES = {"36": "Lobby Motion Detector", "33": "Main Door Sensor",
                "32": "Back Room Door Contact Sensor", "08": "ATM1 Hood Contact Sensor",
                "12": "ATM1 Chest Sensor"}
OFFLINE = ["error"]


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table; its schema is looked up once per application, not on every read."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _minutes(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), count.cast("int"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("int")).drop("props")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as sites; negative balances stand for sites without staff on site."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
              .join(region, nation.n_regionkey == region.r_regionkey))
    return joined.select(
        F.col("c_custkey").alias("site_id"), F.col("c_custkey").alias("box_id"),
        F.col("c_name").alias("site_name"), F.col("c_mktsegment").alias("bank"),
        F.col("n_name").alias("state"), F.col("r_name").alias("zone"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("on_site"))


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, ts = F.col("k"), F.col("ts")
    return events(spark, sf_dir).select(
        "event_id", F.col("user_id").alias("site_id"), F.lit("01").alias("group_no"),
        recode(F.col("event_type"), UNITS).alias("unit_no"),
        F.when(F.col("value") >= 10, "40").otherwise("20").alias("event_code"),
        F.coalesce(recode(F.col("event_type"), CLASSES, keep_unmapped=False),
                   F.lit("Info")).alias("event_type"),
        F.col("event_type").alias("msg"), ts.alias("at_time"), ts.alias("opened_on"),
        F.when(k >= 10, ts + _minutes(F.floor("value"))).alias("closed_on"),
        F.when(k < 10, None).when(k < 20, "System").otherwise("Operator").alias("closed_by"),
        F.when(k >= 10, F.when(k < 60, "done").otherwise("Security guard confirmed"))
        .alias("closing_reason"),
        (k < 95).alias("active"), F.when(k < 75, ts + _minutes(F.floor(k / 5))).alias("ack_on"),
        "k")


def visit_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets whose group holds the sensor code and whose unit is 01."""
    return tickets(spark, sf_dir).withColumns(
        {"group_no": F.col("unit_no"), "unit_no": F.lit("01")})


def remarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three remarks per ticket: acknowledged, still at it, closed."""
    def line(by: str, at: Column, text: str, status: int) -> Column:
        return F.struct(F.lit(by).alias("updated_by"), at.alias("updated_on"),
                        F.lit(text).alias("remarks"), F.lit(status).alias("tkt_status"))

    ack, k = F.col("ack_on"), F.col("k")
    lines = F.array(
        line("desk", ack, "Working on it", 1),
        line("field", F.when(k < 40, ack + _minutes(F.lit(7))), "still working", 1),
        line("desk", F.col("closed_on"), "Working again, closed", 2))
    return (tickets(spark, sf_dir).select("event_id", F.inline(lines))
            .filter("updated_on is not null"))


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets(spark, sf_dir).filter(F.col("msg").isin(OFFLINE)).drop("k", "ack_on")


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("event_type = 'view'").select(
        F.col("user_id").alias("site_id"), F.col("ts").alias("received"))


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").alias("box_id"), recode(F.col("event_type"), CAMERAS).alias("camera_id"),
        F.floor(F.col("value") * 10).cast("int").alias("file_count"),
        F.when(F.col("k") < 50, F.col("k") * 2).alias("remote_file_count"),
        F.col("ts").alias("at_time"))


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five cameras per site; sites without staff have no pinhole camera."""
    kinds = F.array(*[F.struct(F.lit(c).alias("camera_id"), F.lit(n).alias("camera_name"))
                      for c, n in CAMERA_NAMES.items()])
    return sites(spark, sf_dir).select("box_id", "on_site", F.inline(kinds)).select(
        "box_id", "camera_id", "camera_name",
        ((F.col("camera_id") != "0704") | (F.col("on_site") == 1)).alias("active"))


def recorder_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").alias("box_id"), recode(F.col("event_type"), CAMERAS).alias("device_id"),
        F.when(F.col("k") < 70, "RECORD").otherwise("REMOTERECORD").alias("event_code"),
        F.when(F.col("value") >= 10, "1").otherwise("-1").alias("status"),
        F.col("ts").alias("at_time"))


def disk_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors are faulty disks, clicks healthy ones."""
    kept = events(spark, sf_dir).filter("event_type in ('error', 'click')")
    return kept.select(
        F.col("user_id").alias("site_id"), F.col("user_id").alias("box_id"),
        F.when(F.col("event_type") == "error", "0").otherwise("1").alias("hdd"),
        _error(F.col("k")).alias("error"), F.col("ts").alias("at_time"))


def _error(k: Column) -> Column:
    return F.when(k < 40, "ENOENT").when(k < 80, "ENODR").otherwise("EIO")


def _fault_camera(k: Column) -> Column:
    return (F.when(k < 20, "Outdoor Camera").when(k < 40, "Lobby Camera")
            .when(k < 60, "Lobby2 Camera").when(k < 80, "Backroom Camera")
            .otherwise("Pinhole Camera"))


def fault_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a fault ticket, with the site's name and customer."""
    k, ts = F.col("k"), F.col("ts")
    faults = events(spark, sf_dir).select(
        F.col("event_id").alias("ticket_id"), F.col("user_id").alias("site_id"),
        F.col("user_id").alias("box_id"),
        recode(F.col("event_type"), CAMERAS).alias("camera_id"),
        _fault_camera(k).alias("camera_name"), _error(k).alias("error"), ts.alias("opened_on"),
        F.when(k >= 10, ts + _minutes(F.floor("value"))).alias("closed_on"))
    return faults.join(sites(spark, sf_dir).select("site_id", "site_name", "bank"), "site_id")


def sensor_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    code = (F.when(value < 10, "20").when(value < 40, "40").when(value < 80, "48")
            .when(value < 150, "58").otherwise("31"))
    return events(spark, sf_dir).select(
        F.col("user_id").alias("site_id"), F.lit("01").alias("group_no"),
        recode(F.col("event_type"), UNITS).alias("unit_no"), code.alias("event_code"),
        F.col("ts").alias("at_time"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known codes per unit; code 58 is known for some units only."""
    seen = sensor_signals(spark, sf_dir).select("group_no", "unit_no", "event_code").distinct()
    return seen.filter("event_code != '58' or unit_no in ('32', '33', '36')")


def installed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five sensors per site; sites without staff have no motion detector."""
    kinds = F.array(*[F.struct(F.lit(u).alias("unit_no"), F.lit(n).alias("item_name"))
                      for u, n in SENSOR_NAMES.items()])
    return sites(spark, sf_dir).select("site_id", "on_site", F.inline(kinds)).select(
        "site_id", F.lit("01").alias("group_no"), "unit_no", "item_name",
        ((F.col("unit_no") != "36") | (F.col("on_site") == 1)).alias("active"),
        F.lit(True).alias("enabled"))


def door_events(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    k, ts = F.col("k"), F.col("ts")
    rows = events(spark, sf_dir).filter(F.col("event_type") == event_type).select(
        F.col("event_id").alias("ticket_id"), F.col("user_id").alias("site_id"),
        ts.alias("opened_on"),
        F.when(k >= 10, ts + _minutes(F.floor("value"))).alias("closed_on"),
        F.floor(F.col("value") / 10).cast("int").alias("main_door_open"),
        F.when(k < 5, "Opened").otherwise("Closed").alias("main_door_status"),
        F.when(k < 3, 0).otherwise(1).alias("main_door_sensor"))
    return rows.join(sites(spark, sf_dir).select("site_id", "site_name", "bank"), "site_id")


def penalties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("site"), F.month("o_orderdate").alias("month"),
        F.col("o_orderpriority").alias("item"),
        F.floor(F.col("o_totalprice") / 100).cast("double").alias("amount"), "o_orderstatus")


def penalty_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as typed by hand, some of them placeholders."""
    typed = (F.when(F.col("o_orderstatus") == "P", "--")
             .otherwise(F.col("amount").cast("string")))
    return penalties(spark, sf_dir).select("site", "month", typed.alias("amount"))


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites(spark, sf_dir).select(
        "site_id", F.col("zone").alias("customer"), F.col("bank").alias("bank_name"), "state",
        F.col("zone").alias("city"), F.col("site_name").alias("address"))


def _case(column: str, mapping: dict[str, str], otherwise: str | None = None) -> str:
    arms = " ".join(f"when '{old}' then '{new}'" for old, new in mapping.items())
    tail = f" else '{otherwise}'" if otherwise is not None else ""
    return f"case {column} {arms}{tail} end"


def _rows(pairs: dict[str, str], first: str, second: str) -> str:
    return "(values " + ", ".join(f"('{a}', '{b}')" for a, b in pairs.items()) + \
        f") as kinds({first}, {second})"


_ERROR = "case when k < 40 then 'ENOENT' when k < 80 then 'ENODR' else 'EIO' end"
_CLOSED = "case when k >= 10 then ts + to_minutes(cast(floor(value) as bigint)) end"

# One entry per view, in the order of use: later views may refer to earlier ones.
VIEW_SQL = {
    "ev": "select event_id, ts, user_id, event_type, value, "
          "cast(json_extract_string(props, '$.k') as int) as k from events",
    "sites": "select c_custkey as site_id, c_custkey as box_id, c_name as site_name, "
             "c_mktsegment as bank, n_name as state, r_name as zone, "
             "case when c_acctbal >= 0 then 1 else 0 end as on_site from customer "
             "join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
    "tickets": "select event_id, user_id as site_id, '01' as group_no, "
               f"{_case('event_type', UNITS)} as unit_no, "
               "case when value >= 10 then '40' else '20' end as event_code, "
               f"{_case('event_type', CLASSES, 'Info')} as event_type, event_type as msg, "
               f"ts as at_time, ts as opened_on, {_CLOSED} as closed_on, "
               "case when k < 10 then null when k < 20 then 'System' else 'Operator' end "
               "as closed_by, case when k >= 10 then case when k < 60 then 'done' else "
               "'Security guard confirmed' end end as closing_reason, k < 95 as active, "
               "case when k < 75 then ts + to_minutes(cast(floor(k / 5.0) as bigint)) end "
               "as ack_on, k from ev",
    "remarks": "select event_id, 'desk' as updated_by, ack_on as updated_on, "
               "'Working on it' as remarks, 1 as tkt_status from tickets where ack_on is not null "
               "union all select event_id, 'field', ack_on + to_minutes(7), 'still working', 1 "
               "from tickets where k < 40 union all select event_id, 'desk', closed_on, "
               "'Working again, closed', 2 from tickets where closed_on is not null",
    "episodes": "select * from tickets where msg = 'error'",
    "heartbeats": "select user_id as site_id, ts as received from ev where event_type = 'view'",
    "recordings": f"select user_id as box_id, {_case('event_type', CAMERAS)} as camera_id, "
                  "cast(floor(value * 10) as int) as file_count, "
                  "case when k < 50 then k * 2 end as remote_file_count, ts as at_time from ev",
    "cameras": "select box_id, camera_id, camera_name, camera_id <> '0704' or on_site = 1 "
               f"as active from sites, {_rows(CAMERA_NAMES, 'camera_id', 'camera_name')}",
    "recorder_signals": f"select user_id as box_id, {_case('event_type', CAMERAS)} as device_id, "
                        "case when k < 70 then 'RECORD' else 'REMOTERECORD' end as event_code, "
                        "case when value >= 10 then '1' else '-1' end as status, ts as at_time "
                        "from ev",
    "disk_status": "select user_id as site_id, user_id as box_id, case event_type when 'error' "
                   f"then '0' else '1' end as hdd, {_ERROR} as error, ts as at_time from ev "
                   "where event_type in ('error', 'click')",
    "fault_tickets": "select event_id as ticket_id, user_id as site_id, user_id as box_id, "
                     f"{_case('event_type', CAMERAS)} as camera_id, case when k < 20 then "
                     "'Outdoor Camera' when k < 40 then 'Lobby Camera' when k < 60 then "
                     "'Lobby2 Camera' when k < 80 then 'Backroom Camera' else 'Pinhole Camera' "
                     f"end as camera_name, {_ERROR} as error, ts as opened_on, {_CLOSED} "
                     "as closed_on, site_name, bank from ev join sites on site_id = user_id",
    "sensor_signals": f"select user_id as site_id, '01' as group_no, "
                      f"{_case('event_type', UNITS)} as unit_no, case when value < 10 then '20' "
                      "when value < 40 then '40' when value < 80 then '48' when value < 150 "
                      "then '58' else '31' end as event_code, ts as at_time from ev",
    "dictionary": "select distinct group_no, unit_no, event_code from sensor_signals "
                  "where event_code <> '58' or unit_no in ('32', '33', '36')",
    "installed_items": "select site_id, '01' as group_no, unit_no, item_name, "
                       "unit_no <> '36' or on_site = 1 as active "
                       f"from sites, {_rows(SENSOR_NAMES, 'unit_no', 'item_name')}",
    "doors": "select event_type, event_id as ticket_id, user_id as site_id, ts as opened_on, "
             f"{_CLOSED} as closed_on, cast(floor(value / 10) as int) as main_door_open, "
             "case when k < 5 then 'Opened' else 'Closed' end as main_door_status, "
             "case when k < 3 then 0 else 1 end as main_door_sensor, site_name, bank "
             "from ev join sites on site_id = user_id",
    "penalties": "select o_custkey as site, cast(month(o_orderdate) as int) as month, o_orderpriority as item, "
                 "floor(o_totalprice / 100) as amount, o_orderstatus from orders",
}

# Views each view refers to.
_NEEDS = {
    "tickets": ["ev"], "remarks": ["tickets"], "episodes": ["tickets"], "heartbeats": ["ev"],
    "recordings": ["ev"], "cameras": ["sites"], "recorder_signals": ["ev"],
    "disk_status": ["ev"], "fault_tickets": ["ev", "sites"], "sensor_signals": ["ev"],
    "dictionary": ["sensor_signals"], "installed_items": ["sites"], "doors": ["ev", "sites"],
}


def half_up(value: str, digits: int) -> str:
    """SQL for rounding .5 away from zero by the decimal digits, as Spark does."""
    return f"cast(round(cast({value} as decimal(28, 12)), {digits}) as double)"


def with_views(names: str, body: str, *ctes: tuple[str, str]) -> str:
    """``body`` preceded by the named views, what they need, and further steps."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    parts = [f"{name} as ({VIEW_SQL[name]})" for name in wanted]
    parts += [f"{name} as ({text})" for name, text in ctes]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body
