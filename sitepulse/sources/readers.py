"""Scans. Filters and column lists are plain expressions, so Spark pushes them to the source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitepulse.functions.text import text_flag
from sitepulse.functions.time import as_of

# Spellings met in the tenants' databases, lower case, and the name used here.
CANONICAL_NAMES = {
    "mcuid": "site_id", "vboxid": "box_id", "s_name": "site_name", "sitename": "site_name",
    "bankname": "bank", "bankcode": "bank_code", "s_status": "status", "qstatus": "active",
    "i_status": "enabled", "s_addr_state": "state", "s_addr_district": "district",
    "s_addr_street": "street", "s_addr_zone": "zone", "installed_date": "installed",
    "eventid": "event_id", "groupno": "group_no", "unitno": "unit_no", "eventcode": "event_code",
    "eventtype": "event_type", "eventname": "event_name", "attime": "at_time",
    "openedon": "opened_on", "closedon": "closed_on", "closedby": "closed_by",
    "closingreason": "closing_reason", "updatedon": "updated_on", "updatedby": "updated_by",
    "tktstatus": "tkt_status", "deviceid": "device_id", "cameraid": "camera_id",
    "cameraname": "camera_name", "filecount": "file_count", "remotefilecount":
    "remote_file_count", "itemname": "item_name", "getdate": "received",
    "receiveddate": "received", "ticketid": "ticket_id",
    "latestremoterecording": "latest_remote_recording",
}


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               where: Column | None = None, fmt: str = "parquet",
               schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def jdbc_options(url: str, table: str, *, split_on: str, low: str, high: str, parts: int,
                 fetch_size: int = 10_000, **connection: str) -> dict[str, str]:
    """Options for a scan split into ``parts`` ranges; logins come from the caller."""
    return {"url": url, "dbtable": table, "partitionColumn": split_on, "lowerBound": str(low),
            "upperBound": str(high), "numPartitions": str(parts), "fetchsize": str(fetch_size),
            **connection}


def read_jdbc(spark: SparkSession, options: Mapping[str, str],
              columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    df = spark.read.format("jdbc").options(**options).load()
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def canonical_names(df: DataFrame) -> DataFrame:
    """One spelling per column; flags stored as text become booleans."""
    renames = {c: CANONICAL_NAMES[c.lower()] for c in df.columns if c.lower() in CANONICAL_NAMES}
    out = df.withColumnsRenamed(renames)
    flags = [c for c, kind in out.dtypes if c in ("active", "enabled") and kind != "boolean"]
    return out.withColumns({c: text_flag(F.col(c)) for c in flags}) if flags else out


def day_slice(df: DataFrame, ts: str, start: str | date, end: str | date, *,
              closed: bool = False) -> DataFrame:
    """Rows from ``start`` to before ``end``. ``closed`` also takes rows exactly at ``end``,
    which two adjoining slices then both contain."""
    low, high = as_of(start), as_of(end)
    upper = F.col(ts) <= high if closed else F.col(ts) < high
    return df.filter((F.col(ts) >= low) & upper)


def month_slice(df: DataFrame, ts: str, first_day: str) -> DataFrame:
    low = as_of(first_day)
    return df.filter((F.col(ts) >= low) & (F.col(ts) < low + F.make_ym_interval(F.lit(0),
                                                                               F.lit(1))))


def look_back(df: DataFrame, ts: str, asof: str | datetime | Column, *, days: int = 0,
              hours: int = 0, minutes: int = 0) -> DataFrame:
    """Rows not older than the interval before ``asof``."""
    gap = F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes))
    return df.filter(F.col(ts) >= as_of(asof) - gap)


def scope(df: DataFrame, banks: Sequence[str] | str = "ALL", column: str = "bank") -> DataFrame:
    """Rows of the listed customers; ``ALL`` in any case keeps everything."""
    names = [banks] if isinstance(banks, str) else list(banks)
    if any(name.upper() == "ALL" for name in names):
        return df
    return df.filter(F.col(column).isin(names))


def read_sheets(spark: SparkSession, paths: Mapping[str, str],
                schemas: Mapping[str, str] | None = None, *,
                header: bool = True) -> dict[str, DataFrame]:
    """A workbook as one CSV per sheet; without a schema all columns are text."""
    out = {}
    for sheet, path in paths.items():
        reader = spark.read.option("header", str(header).lower()).option("enforceSchema", "false")
        if schemas and sheet in schemas:
            reader = reader.schema(schemas[sheet])
        out[sheet] = reader.csv(path)
    return out


def promote_header(df: DataFrame, marker: str) -> DataFrame:
    """Use a row whose first cell equals ``marker`` as the header and drop every copy of that row.

    One row travels to the driver. All other rows stay, also those with a blank first cell.
    """
    first = df.columns[0]
    head = df.filter(F.trim(F.col(first)) == marker).limit(1).first()
    if head is None:
        raise ValueError(f"no header row starts with {marker!r}")
    names = [str(cell).strip() if cell is not None else old for cell, old in zip(head, df.columns)]
    copy = reduce(and_, [F.col(c).eqNullSafe(F.lit(cell)) for c, cell in zip(df.columns, head)])
    return df.filter(~copy).toDF(*names)


def drop_header_rows(df: DataFrame, column: str, text: str | None = None) -> DataFrame:
    """Header lines repeated inside the body, and rows without a value there."""
    return df.filter(F.col(column) != F.lit(text if text is not None else column))
