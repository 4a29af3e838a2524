"""Column lists of the input tables, as Spark DDL."""

from __future__ import annotations

from pyspark.sql.types import StructType

DDL = {
    "sites": "site_id STRING, box_id STRING, site_name STRING, bank STRING, bank_code STRING, "
             "status INT, active BOOLEAN, on_site INT, state STRING, district STRING, "
             "street STRING, zone STRING, installed DATE",
    "customers": "bank_code STRING, bank STRING, active BOOLEAN",
    "tickets": "event_id BIGINT, site_id STRING, group_no STRING, unit_no STRING, "
               "event_code STRING, event_type STRING, msg STRING, at_time TIMESTAMP_NTZ, "
               "opened_on TIMESTAMP_NTZ, closed_on TIMESTAMP_NTZ, closed_by STRING, "
               "closing_reason STRING, active BOOLEAN",
    "remarks": "event_id BIGINT, updated_by STRING, updated_on TIMESTAMP_NTZ, remarks STRING, "
               "tkt_status INT",
    "sensor_signals": "site_id STRING, group_no STRING, unit_no STRING, event_code STRING, "
                      "at_time TIMESTAMP_NTZ",
    "event_dictionary": "group_no STRING, unit_no STRING, event_code STRING, event_name STRING",
    "installed_items": "site_id STRING, group_no STRING, unit_no STRING, item_name STRING, "
                       "active BOOLEAN, enabled BOOLEAN",
    "heartbeats": "site_id STRING, received TIMESTAMP_NTZ",
    "recorder_signals": "box_id STRING, device_id STRING, event_code STRING, status STRING, "
                        "at_time TIMESTAMP_NTZ",
    "disk_status": "site_id STRING, box_id STRING, hdd STRING, error STRING, "
                   "at_time TIMESTAMP_NTZ",
    "cameras": "box_id STRING, camera_id STRING, camera_name STRING, active BOOLEAN",
    "recording_counts": "box_id STRING, camera_id STRING, file_count INT, "
                        "remote_file_count INT, at_time TIMESTAMP_NTZ",
    "fault_tickets": "ticket_id BIGINT, bank STRING, site_name STRING, site_id STRING, "
                     "box_id STRING, camera_id STRING, camera_name STRING, error STRING, "
                     "opened_on TIMESTAMP_NTZ, closed_on TIMESTAMP_NTZ, "
                     "latest_remote_recording TIMESTAMP_NTZ",
    "video_daily": "date DATE, bank STRING, site_name STRING, site_id STRING, "
                   "site_availability DOUBLE",
    "door_events": "ticket_id BIGINT, bank STRING, site_name STRING, opened_on TIMESTAMP_NTZ, "
                   "closed_on TIMESTAMP_NTZ, main_door_open INT, main_door_status STRING, "
                   "main_door_sensor INT",
    "near_violation": "bank STRING, site_name STRING, site_id STRING, event_id BIGINT, "
                      "event_type STRING, msg STRING, opened_on TIMESTAMP_NTZ, "
                      "age_minutes DOUBLE, required_action STRING",
    "footage_requests": "ticket_id BIGINT, site_id STRING, transaction_date STRING, "
                        "transaction_time STRING",
    "penalties": "feed STRING, site STRING, month STRING, item STRING, amount STRING",
    "penalty_summary": "site STRING, month DOUBLE, mcu DOUBLE, equipment DOUBLE, "
                       "footage DOUBLE, pm DOUBLE, total DOUBLE",
    "portfolio": "site_id STRING, customer STRING, bank_name STRING, state STRING, city STRING, "
                 "address STRING",
    "site_features": "bank STRING, site_name STRING, site_id STRING, security INT, "
                     "manual_closure INT, footfall INT, night_visit INT",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(DDL[name])
