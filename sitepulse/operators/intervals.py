"""Time intervals: clipping, downtime, overlap, and point-in-interval tests without pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.functions.time import clamp, minutes_between

# A key's time bin with more rows than this is split into pieces.
BUSY_ROWS = 1_000_000


def _forever() -> Column:
    """Stands for "still open"; later than any stored time."""
    return F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")


def overlapping(df: DataFrame, start: str, end: str, low: Column, high: Column) -> DataFrame:
    """Intervals that touch [low, high); a missing end is open."""
    return df.filter((F.col(start) < high)
                     & ((F.col(end) >= low) | F.col(end).isNull()))


def clip_intervals(df: DataFrame, start: str, end: str, low: Column, high: Column) -> DataFrame:
    """Intervals cut to [low, high]; a missing end becomes ``high``."""
    return df.withColumns({start: clamp(start, low, high), end: clamp(end, low, high)})


def downtime_minutes(df: DataFrame, keys: Sequence[str], start: str, end: str,
                     name: str) -> DataFrame:
    """Whole minutes per interval, summed per key."""
    return df.groupBy(*keys).agg(F.sum(minutes_between(start, end)).alias(name))


def _reached_by(spans: DataFrame, key: str, ends: Sequence[str]) -> DataFrame:
    """One row per key and start: the latest end of each kind; spans that cover nothing go.

    That last filter needs all ends, and the bin is an aggregate, so every later use of the frame
    asks for the same columns and rows: Spark computes the exchange below it, and with it the scans
    of the interval tables, once.
    """
    latest = spans.groupBy(key, "_t").agg(F.max("_bin").alias("_bin"),
                                          *[F.max(e).alias(e) for e in ends])
    return latest.filter(F.greatest(*ends, F.lit(None)) >= F.col("_t"))


def dealt_rows(points: DataFrame, intervals: Mapping[str, DataFrame], key: str, at: str,
               start: str, end: str, *, bin_unit: str = "hour", piece_unit: str = "second",
               open_covers: bool = True, busy_rows: int = BUSY_ROWS
               ) -> tuple[DataFrame, list[str]]:
    """Points (``_kind`` 2), spans (1) and what was reached before (0), with the columns that hold
    the ends. ``key``, ``_piece`` and ``_part`` name the group a row is looked at in: a time bin, or a
    shorter piece of it where the bin is busy. See ``covered_points``."""
    ends = [f"_end{i}" for i in range(len(intervals))]
    nothing = F.lit(None).cast("timestamp_ntz")
    cell = [key, "_bin"]

    def start_of(unit: str, column: str = "_t") -> Column:
        return F.date_trunc(unit, F.col(column)).cast("timestamp_ntz")

    def spans_of(pos: int, df: DataFrame) -> DataFrame:
        finite = df if open_covers else df.filter(F.col(end).isNotNull())
        reach = F.coalesce(F.col(end).cast("timestamp_ntz"), _forever())
        return finite.filter(F.col(start).isNotNull() & F.col(key).isNotNull()).select(
            key, F.col(start).cast("timestamp_ntz").alias("_t"),
            start_of(bin_unit, start).alias("_bin"),
            *[(reach if i == pos else nothing).alias(name) for i, name in enumerate(ends)])

    spans = _reached_by(reduce(lambda a, b: a.unionByName(b), [
        spans_of(i, df) for i, df in enumerate(intervals.values())]), key, ends)
    # Points without time or key match nothing; they are spread instead of forming one group.
    blank = F.col(at).isNull() | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*points.columns) + F.spark_partition_id(), F.lit(1024))
    asked = points.withColumn("_t", F.col(at).cast("timestamp_ntz")).withColumns({
        "_bin": start_of(bin_unit), "_kind": F.lit(2),
        "_part": F.when(blank, spread).otherwise(0)})
    # All that matters for what is reached when: spans with their ends, points without.
    narrow = spans.unionByName(asked.dropna(subset=["_t", key]).select(key, "_t", "_bin"),
                               allowMissingColumns=True)

    # Latest end and rows per bin; the latest end goes to every later bin of the key.
    latest = [F.max(e).alias(e) for e in ends]
    per_bin = narrow.groupBy(*cell).agg(*latest, F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    handed = per_bin.select(*cell, "_n", *[F.max(e).over(earlier).alias(e) for e in ends])
    # One row per ``busy_rows`` rows of the input at most.
    busy = F.broadcast(per_bin.filter(F.col("_n") > busy_rows).select(*cell, F.lit(True).alias(
        "_busy")))

    def in_pieces(df: DataFrame) -> DataFrame:
        return df.join(busy, cell, "left").withColumn("_piece", F.when(
            F.col("_busy"), start_of(piece_unit)).otherwise(F.col("_bin"))).drop("_busy")

    # A busy bin does the same once more: each piece sends its latest end, and pieces take the
    # maximum of the bin's own start value and the pieces before them.
    sent = (narrow.join(busy, cell, "left_semi").groupBy(*cell, start_of(piece_unit).alias("_piece"))
            .agg(*latest).withColumn("_first", F.lit(1)))
    begin = handed.filter(F.col("_n") > busy_rows).drop("_n").withColumns(
        {"_piece": F.col("_bin"), "_first": F.lit(0)})
    before = (Window.partitionBy(*cell).orderBy("_piece", "_first")
              .rowsBetween(Window.unboundedPreceding, -1))
    passed = sent.unionByName(begin).select("_first", key, "_piece", *[
        F.max(e).over(before).alias(e) for e in ends]).filter("_first = 1").drop("_first")
    carried = passed.unionByName(handed.filter(F.col("_n") <= busy_rows).select(
        key, F.col("_bin").alias("_piece"), *ends)).dropna(how="all", subset=ends)

    none = F.lit(0).cast("long")
    rows = in_pieces(asked.unionByName(spans.withColumns({"_kind": F.lit(1), "_part": none}),
                                       allowMissingColumns=True))
    return rows.unionByName(carried.withColumns({
        "_t": F.col("_piece"), "_kind": F.lit(0), "_part": none}), allowMissingColumns=True), ends


def covered_points(points: DataFrame, intervals: Mapping[str, DataFrame], key: str, at: str,
                   start: str, end: str, *, bin_unit: str = "hour", piece_unit: str = "second",
                   open_covers: bool = True, busy_rows: int = BUSY_ROWS) -> DataFrame:
    """Adds one flag per named interval table: is ``at`` inside any of its [start, end]?

    Points and intervals are sorted together and the latest end so far is carried along, so no
    point meets an interval as a pair. Time bins split a busy key into many groups, and a bin of
    more than ``busy_rows`` rows is split once more into pieces of ``piece_unit``; what earlier bins
    and pieces hand over is one row per bin or piece. Each interval table is scanned once. A
    missing end covers everything after the start, unless ``open_covers`` is false (then such
    intervals cover nothing).
    """
    rows, ends = dealt_rows(points, intervals, key, at, start, end, bin_unit=bin_unit,
                            piece_unit=piece_unit, open_covers=open_covers, busy_rows=busy_rows)
    so_far = (Window.partitionBy(key, "_piece", "_part").orderBy("_t", "_kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reached = rows.withColumns({
        flag: F.coalesce(F.max(e).over(so_far) >= F.col("_t"), F.lit(False))
        for flag, e in zip(intervals, ends)})
    return reached.filter("_kind = 2").select(*points.columns, *intervals)
