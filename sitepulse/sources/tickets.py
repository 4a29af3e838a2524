"""The ticket table between two runs: close, touch and open in one set-based pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.functions.time import as_of


PARTS = 256


def number_rows(df: DataFrame, column: str, after: Column | int) -> DataFrame:
    """Numbers ``after`` + 1, + 2, ... in an order that depends on the rows only.

    Rows are dealt into parts by hash; the part sizes (one row per part) give each part its first
    number. A repeated task numbers its rows as before.
    """
    names = [c for c in df.columns if c != column]
    first = after if isinstance(after, Column) else F.lit(after)
    dealt = df.select(*names, F.xxhash64(*names).alias("_hash")).withColumn(
        "_part", F.pmod("_hash", F.lit(PARTS)))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_hash", *names))
    return dealt.withColumn("_place", place).join(F.broadcast(starts), "_part").select(
        *names, (first + F.col("_first") + F.col("_place")).alias(column))


def apply_ticket_changes(tickets: DataFrame, asof: str | datetime | Column, *,
                         closed: DataFrame | None = None, touched: DataFrame | None = None,
                         touch_column: str = "latest_remote_recording",
                         opened: DataFrame | None = None, id_column: str = "ticket_id",
                         highest: Column | int | None = None) -> DataFrame:
    """Next state of the ticket table; write it with ``replace_table``.

    ``closed`` lists ids to close at ``asof`` (a ticket closed before keeps its time),
    ``touched`` brings ids with a new ``touch_column``, ``opened`` brings new rows, whose ids
    follow the ``highest`` id in use (else the highest in ``tickets``). Running the same change
    again alters nothing in closed rows.
    """
    out = tickets
    changes = []
    if closed is not None:
        changes.append(closed.select(id_column, F.lit(True).alias("_close")).distinct())
    if touched is not None:
        changes.append(touched.groupBy(id_column).agg(F.max(touch_column).alias("_touch")))
    if changes:
        # One join for both kinds of change; ids are unique on either side of it.
        both = changes[0]
        for extra in changes[1:]:
            both = both.unionByName(extra, allowMissingColumns=True)
        aggs = [F.max(c).alias(c) for c in both.columns if c != id_column]
        out = out.join(both.groupBy(id_column).agg(*aggs), id_column, "left")
        if closed is not None:
            out = out.withColumn("closed_on", F.coalesce(
                F.col("closed_on"), F.when(F.col("_close"), as_of(asof))))
        if touched is not None:
            out = out.withColumn(touch_column, F.coalesce(F.col("_touch"), F.col(touch_column)))
        out = out.drop("_close", "_touch").select(*tickets.columns)
    if opened is None:
        return out
    if highest is None:
        highest = tickets.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    fresh = number_rows(opened, id_column, highest)
    return out.unionByName(fresh.select(*[c for c in tickets.columns if c in fresh.columns]),
                           allowMissingColumns=True)
