"""Tables of which a write touches only the parts it changes: days, or buckets of a key.

The parts of a table lie in folders ``data/_write=N/<column>=<part>``, one number per write. A manifest, a
small versioned table with one row per part, says which folder is the current one. A write brings
the new folders of its parts first and its manifest last, so readers see either all of it or
nothing, a run that stops in between changes nothing, and no folder is moved or deleted under a
reader: replaced folders go ``keep_hours`` later. One writer at a time; stores without a rename (such
as object stores) are served as well.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitepulse.operators.joins import null_safe_anti
from sitepulse.session import reuse
from sitepulse.sources.tickets import apply_ticket_changes, number_rows
from sitepulse.sources.writers import current_version, finished_versions, replace_table

MANIFEST = "part string, version long, retired double"
KEEP_HOURS = 24.0


@dataclass(frozen=True)
class PartTable:
    """A table cut by ``column``, whose values must be plain words, numbers or dates."""

    spark: SparkSession
    path: str
    column: str
    within: Sequence[str] = ()
    keep_hours: float = KEEP_HOURS

    def exists(self) -> bool:
        return bool(self._versions())

    def _versions(self) -> list[int]:
        return finished_versions(self.spark, f"{self.path}/manifest")

    def _manifest(self) -> tuple[dict[str, int], list[tuple[str, int, float]]]:
        """(current version of each part, replaced folders and when): a row per part or so."""
        if not self.exists():
            return {}, []
        rows = current_version(self.spark, f"{self.path}/manifest").collect()
        return ({r["part"]: r["version"] for r in rows if r["retired"] is None},
                [(r["part"], r["version"], r["retired"]) for r in rows if r["retired"] is not None])

    def _folder(self, part: str, version: int) -> str:
        return f"{self.path}/data/_write={version}/{self.column}={part}"

    def _schema(self) -> StructType:
        return self.spark.read.parquet(f"{self.path}/empty").schema

    def version(self) -> int:
        """The last finished write, 0 before the first."""
        return max(self._versions(), default=0)

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The current rows, of the listed parts only if there is a list."""
        live, _ = self._manifest()
        wanted = live if parts is None else {p: live[p] for p in map(str, parts) if p in live}
        schema = self._schema()
        if not wanted:
            return self.spark.createDataFrame([], schema)
        folders = [self._folder(p, v) for p, v in sorted(wanted.items())]
        return (self.spark.read.schema(StructType([*schema, *StructType.fromDDL("_write long")]))
                .option("basePath", f"{self.path}/data").parquet(*folders).drop("_write"))

    def replace(self, df: DataFrame, parts: Iterable[str]) -> list[str]:
        """The listed parts get the rows of ``df`` (or none); returns the folders written."""
        parts = sorted({str(p) for p in parts})
        live, retired = self._manifest()
        version, now = self.version() + 1, time.time()
        if not self.exists():
            df.limit(0).write.mode("overwrite").parquet(f"{self.path}/empty")
        folder = f"{self.path}/data/_write={version}"
        by = [self.column, *self.within]
        columns = [c for c in df.columns if c not in by]
        (df.select(*columns, *by).hint("rebalance", *by).write.mode("overwrite")
         .partitionBy(*by).parquet(folder))
        written = [n[len(self.column) + 1:] for n in self._names(folder)
                   if n.startswith(f"{self.column}=")]
        if extra := set(written) - set(parts):
            raise ValueError(f"rows of parts that are not replaced: {sorted(extra)}")
        retired = [*retired, *[(p, live[p], now) for p in parts if p in live]]
        gone = [r for r in retired if r[2] < now - 3600 * self.keep_hours]
        live = {p: v for p, v in live.items() if p not in parts} | dict.fromkeys(written, version)
        rows = [(p, v, None) for p, v in live.items()] + [r for r in retired if r not in gone]
        replace_table(self.spark.createDataFrame(rows, MANIFEST).coalesce(1),
                      f"{self.path}/manifest", version=version, keep=2)
        for part, old, _ in gone:
            self._delete(self._folder(part, old))
        return [self._folder(p, version) for p in written]

    def _fs(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, fs = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)]

    def _delete(self, folder: str) -> None:
        path, fs = self._fs(folder)
        fs.delete(path, True)


def replace_day(df: DataFrame, path: str, day: str, column: str = "date") -> None:
    """Replace one day of a daily table, also by nothing. ``df`` holds that day only.

    Readers (``read_parts``, or ``PartTable`` for another column) see the old day until the new one
    is complete; a run that stops at any point leaves the old day in place.
    """
    PartTable(df.sparkSession, path, column).replace(df, [day])


def bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class KeyedTable:
    """A table in buckets of its key columns; a change rewrites the buckets of the keys it names."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    buckets: int = 64
    keep_hours: float = KEEP_HOURS

    @property
    def parts(self) -> PartTable:
        return PartTable(self.spark, self.path, "_bucket", keep_hours=self.keep_hours)

    def exists(self) -> bool:
        return self.parts.exists()

    def read(self) -> DataFrame:
        return self.parts.read().drop("_bucket")

    def replace_all(self, df: DataFrame) -> list[str]:
        return self.parts.replace(df.withColumn("_bucket", bucket(self.keys, self.buckets)),
                                  range(self.buckets))

    def replace_keys(self, df: DataFrame, keys: DataFrame) -> list[str]:
        """Rows of the listed keys give way to ``df``, which may read this table."""
        if not self.exists():
            return self.replace_all(df)
        new = reuse(df)
        named = keys.select(*self.keys).unionByName(new.select(*self.keys)).distinct()
        touched = _touched(named, self.keys, self.buckets)
        kept = null_safe_anti(self.parts.read(touched).drop("_bucket"), named, list(self.keys))
        rows = kept.unionByName(new, allowMissingColumns=True)
        return self.parts.replace(rows.withColumn("_bucket", bucket(self.keys, self.buckets)),
                                  touched)


def _touched(rows: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """Buckets with a row, ``buckets`` numbers at most."""
    found = rows.select(bucket(keys, buckets).alias("b")).distinct()
    return sorted(r["b"] for r in found.collect())


@dataclass(frozen=True)
class TicketTable:
    """Fault tickets in buckets of their id, open and closed ones apart.

    A poll reads the open tickets only, and writes only the buckets with a ticket that it opens,
    closes or touches. The highest id ever given is a one-row table beside them.
    """

    spark: SparkSession
    path: str
    schema: StructType
    buckets: int = 64
    id_column: str = "ticket_id"
    keep_hours: float = KEEP_HOURS

    @property
    def parts(self) -> PartTable:
        return PartTable(self.spark, self.path, "_bucket", ("_open",), self.keep_hours)

    def exists(self) -> bool:
        return self.parts.exists()

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.parts.read().select(*self.schema.names)

    def open(self) -> DataFrame:
        """Open tickets; the folders of closed ones are not read."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.parts.read().filter("_open = 1").select(*self.schema.names)

    def begin(self, tickets: DataFrame) -> None:
        """The whole table, from an older layout or an import."""
        self._write(tickets, range(self.buckets), tickets.agg(F.max(self.id_column)))

    def apply(self, asof, *, closed: DataFrame | None = None, touched: DataFrame | None = None,
              opened: DataFrame | None = None) -> list[str]:
        """Close, touch and open tickets as ``apply_ticket_changes`` does; the folders written."""
        key = self.id_column
        closed, touched = (None if df is None else reuse(df) for df in (closed, touched))
        highest = self._highest()
        fresh = None
        if opened is not None:
            names = [c for c in self.schema.names if c in opened.columns and c != key]
            fresh = reuse(number_rows(opened.select(*names), key, highest))
        named = [df.select(key) for df in (closed, touched, fresh) if df is not None]
        if not named:
            return []
        ids = named[0]
        for more in named[1:]:
            ids = ids.unionByName(more)
        buckets = _touched(ids, [key], self.buckets)
        if not buckets:
            return []
        old = self.spark.createDataFrame([], self.schema)
        if self.exists():
            old = self.parts.read(buckets).select(*self.schema.names)
        rows = apply_ticket_changes(old, asof, closed=closed, touched=touched, id_column=key)
        top = ids.agg(F.max(key))
        if fresh is not None:
            rows = rows.unionByName(fresh, allowMissingColumns=True)
        return self._write(rows, buckets, top)

    def _highest(self) -> int:
        version = self.parts.version()
        if not version:
            return 0
        return current_version(self.spark, f"{self.path}/highest", before=version + 1).first()[0]

    def _write(self, rows: DataFrame, buckets: Iterable[int], top: DataFrame) -> list[str]:
        version = self.parts.version() + 1
        highest = max(self._highest(), top.first()[0] or 0)
        replace_table(self.spark.createDataFrame([(highest,)], "highest long"),
                      f"{self.path}/highest", version=version, keep=3)
        return self.parts.replace(rows.withColumns({
            "_bucket": bucket([self.id_column], self.buckets),
            "_open": F.col("closed_on").isNull().cast("int")}), buckets)


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """The current rows of any of these tables; None if there is none at ``path``."""
    if not finished_versions(spark, f"{path}/manifest"):
        return None
    return _without_marks(PartTable(spark, path, _column(spark, path)).read())


def _column(spark: SparkSession, path: str) -> str:
    """Parts are written with their column, and a second one for tickets, at the end."""
    names = spark.read.parquet(f"{path}/empty").schema.names
    return next((n for n in names if n == "_bucket"), "date")


def _without_marks(df: DataFrame) -> DataFrame:
    return df.drop("_bucket", "_open")

