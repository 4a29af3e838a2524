"""Streams that keep state per site with timers: alarms for silence, and open fault tickets.

Both use Spark's keyed state (``transformWithState``, RocksDB state store) and start from a table: the
sites that are expected to report, or the tickets that are open already. The state of a site is a
few numbers, whatever the number of its rows. Rows without a key or a time take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _keyed_state(spark: SparkSession) -> None:
    """Keyed state and timers need this store; other streams work with it as well."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _micros(text: str) -> int:
    """'12 hours' -> microseconds."""
    return int(pd.Timedelta(text).value // 1000)


# ---- silence ------------------------------------------------------------------------------------

class SilenceWatch(StatefulProcessor):
    """Runs of signals of one site that may still grow, and whether the site is silent now.

    A run ends when nothing came for ``silence`` after its last signal; that is certain once the
    watermark has passed that time, and a timer waits for it. The first run of an expected site
    begins with the time from which it is watched, without a signal.
    """

    def __init__(self, silence: int):
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getListState("runs", "first long, last long, seen boolean")
        self.down = handle.getValueState("down", "down boolean")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.runs.put([(initialState["since"], initialState["since"], False)])
        self._wait([(initialState["since"], initialState["since"], False)], False)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        runs = sorted(tuple(r) for r in self.runs.get())
        for row in rows:
            runs = self._merged(runs, (row["first"], row["last"], True))
        yield from self._advance(key, runs, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        runs = sorted(tuple(r) for r in self.runs.get())
        yield from self._advance(key, runs, timerValues.getCurrentWatermarkInMs() * 1000)

    def _merged(self, runs: list[tuple], new: tuple) -> list[tuple]:
        """``runs`` with ``new``; runs less than ``silence`` apart are one."""
        apart = []
        for run in runs:
            if run[0] < new[1] + self.silence and new[0] < run[1] + self.silence:
                new = (min(run[0], new[0]), max(run[1], new[1]), run[2] or new[2])
            else:
                apart.append(run)
        return sorted([*apart, new])

    def _advance(self, key, runs: list[tuple], watermark: int) -> Iterator[Row]:
        down = self.down.exists() and self.down.get()[0]
        while runs:
            first, last, seen = runs[0]
            if down:
                if first > watermark:
                    break
                down = False
                yield Row(key=key[0], kind="back", last_signal=None, at=first)
            if last + self.silence > watermark:
                break
            down = True
            runs = runs[1:]
            yield Row(key=key[0], kind="silent", last_signal=last if seen else None,
                      at=last + self.silence)
        self.runs.put(runs) if runs else self.runs.clear()
        self.down.update((down,))
        self._wait(runs, down)

    def _wait(self, runs: list[tuple], down: bool) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if runs:
            due = runs[0][0] if down else runs[0][1] + self.silence
            self.handle.registerTimer(-(-due // 1000))

    def close(self) -> None:
        pass


def _runs_of(signals: DataFrame, at: str, key: str, silence: int) -> DataFrame:
    """key, first, last and a time: signals of one input batch that are less than ``silence`` apart
    become one row."""
    kind = dict(signals.dtypes)[key]

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            df = df.sort_values([key, "_at"], kind="stable")
            apart = (df[key] != df[key].shift()) | (df["_at"] - df["_at"].shift() >= silence)
            found = df.groupby(apart.cumsum()).agg(
                **{key: (key, "first"), "first": ("_at", "min"), "last": ("_at", "max")})
            yield found[[key, "first", "last"]]

    rows = signals.select(key, F.unix_micros(at).alias("_at")).dropna()
    return rows.mapInPandas(reduced, f"`{key}` {kind}, first long, last long").withColumn(
        "_time", F.timestamp_micros("last"))


def site_alarms(signals: DataFrame, sites: DataFrame, at: str, key: str, *, silence: str,
                since: str = "since", delay: str = "1 hour") -> DataFrame:
    """Rows (key, kind, last_signal, at): ``silent`` when a site has sent nothing for ``silence``, and
    ``back`` with its first signal after that.

    ``sites`` (key and the time ``since`` which the site is watched) is the state the stream starts
    with, so a site that never sends anything gives an alarm as well (without a last signal).
    Signals of other sites are followed from their first one on. Rows later than ``delay`` are
    dropped.
    """
    _keyed_state(signals.sparkSession)
    length = _micros(silence)
    start = sites.select(key, F.unix_micros(F.col(since).cast("timestamp")).alias("since")).dropna()
    kind = dict(signals.dtypes)[key]
    found = (_runs_of(signals, at, key, length).withWatermark("_time", delay)
             .groupBy(key).transformWithState(
                 SilenceWatch(length), f"key {kind}, kind string, last_signal long, at long",
                 "Append", "EventTime",
                 initialState=start.groupBy(key).agg(F.min("since").alias("since")).groupBy(key)))
    return found.select(F.col("key").alias(key), "kind",
                        F.timestamp_micros("last_signal").alias("last_signal"),
                        F.timestamp_micros("at").alias("at"))


# ---- fault tickets ------------------------------------------------------------------------------

class FaultState(StatefulProcessor):
    """The open ticket of one box. A fault opens one, another fault replaces it, a healthy status
    closes it. Status rows older than the last one that counted change nothing."""

    def __init__(self, fault: str):
        self.fault = fault

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "error string, opened long")
        self.until = handle.getValueState("until", "until long")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.open.update((initialState["error"], initialState["opened"]))
        self.until.update((initialState["opened"],))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = tuple(self.open.get()) if self.open.exists() else None
        until = self.until.get()[0] if self.until.exists() else None
        once = {(r["at"], r["hdd"] or "", r["error"] or ""): r for r in rows}
        for _, row in sorted(once.items()):
            if until is not None and row["at"] < until:
                continue
            until = row["at"]
            faulty = row["hdd"] == self.fault
            if now is not None and not (faulty and now[0] == row["error"]):
                yield Row(box_id=key[0], error=now[0], opened=now[1], closed=row["at"])
                now = None
            if faulty and now is None:
                now = (row["error"], row["at"])
        self.until.update((until,))
        self.open.update(now) if now is not None else self.open.clear()

    def close(self) -> None:
        pass


def fault_states(status: DataFrame, open_tickets: DataFrame, *, fault: str = "0") -> DataFrame:
    """Closed tickets (box_id, error, opened_on, closed_on) of a stream of disk status rows.

    Open tickets are never written by the stream: they are its state, begin with ``open_tickets``
    (the newest of a box counts) and are published by ``open_faults`` from the state store. A batch
    touches the state of its own boxes only, and a restart goes on where the stream stopped.
    """
    _keyed_state(status.sparkSession)
    kind = dict(status.dtypes)["box_id"]
    rows = status.select("box_id", "hdd", "error", F.unix_micros("at_time").alias("at")).dropna(
        subset=["box_id", "at"])

    start = (open_tickets.filter("closed_on is null and box_id is not null")
             .select("box_id", F.struct(F.unix_micros(F.col("opened_on").cast("timestamp"))
                                        .alias("opened"), "error").alias("_t"))
             .groupBy("box_id").agg(F.max("_t").alias("_t")).select("box_id", "_t.*"))
    # Repeated rows say nothing new; what is left of a box in one batch is put in order in its task.
    found = rows.groupBy("box_id").transformWithState(
        FaultState(fault), f"box_id {kind}, error string, opened long, closed long", "Append",
        "None", initialState=start.groupBy("box_id"))
    return found.select("box_id", "error", F.timestamp_micros("opened").alias("opened_on"),
                        F.timestamp_micros("closed").alias("closed_on"))


def open_faults(spark: SparkSession, checkpoint: str) -> DataFrame:
    """box_id, error, opened_on of the tickets that are open in the state of a stream."""
    _keyed_state(spark)
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    return state.select(F.col("key.*"), F.col("value.error").alias("error"),
                        F.timestamp_micros(F.col("value.opened")).alias("opened_on"))
