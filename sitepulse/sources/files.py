"""Which files of a growing folder were read by which version, kept as a table.

Files are written once and never changed. Listing them, finding new ones and describing them (time
range per file) are Spark jobs; nothing grows with the number of files on the driver, and a plan
holds two times, whatever the number of files.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.sources.readers import canonical_names, look_back
from sitepulse.sources.writers import current_version, finished_versions, replace_table

ROWS = "file string, written timestamp, first_time timestamp_ntz, last_time timestamp_ntz, version long"
# Polls after which the rows of the index are gathered into one table again.
GATHER = 100


def _plain(path: Column) -> Column:
    """One spelling of a path: scheme with one slash."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def file_of() -> Column:
    """The file a row was read from, as ``FileIndex`` spells it (Spark gives it encoded)."""
    return _plain(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


@dataclass(frozen=True)
class FileIndex:
    """The index at ``path`` of the parquet files in ``source``; ``at`` is their time column."""

    spark: SparkSession
    source: str
    path: str
    at: str = "at_time"

    def listed(self) -> DataFrame:
        """file, written: all files there are now. Their contents are not opened."""
        found = self.spark.read.format("binaryFile").load(self.source)
        return found.select(_plain(F.col("path")).alias("file"),
                            F.col("modificationTime").alias("written"))

    def known(self, version: int) -> DataFrame:
        """Files read by versions up to ``version``; rows of unfinished ones do not count."""
        gathered = [v for v in finished_versions(self.spark, f"{self.path}/gathered") if v <= version]
        rows = self.spark.createDataFrame([], ROWS)
        if gathered:
            rows = current_version(self.spark, f"{self.path}/gathered", before=version + 1)
        if finished_versions(self.spark, f"{self.path}/polls"):
            polls = self.spark.read.schema(ROWS).parquet(f"{self.path}/polls").drop("v")
            rows = rows.unionByName(polls.filter(
                (F.col("version") > max(gathered, default=-1)) & (F.col("version") <= version)))
        return rows

    def unread(self, version: int) -> DataFrame:
        """Files that no version up to ``version`` has read."""
        return self.listed().join(self.known(version).select("file"), "file", "left_anti")

    def rows_of(self, files: DataFrame) -> DataFrame:
        """All rows of the listed files (file, written), whatever their times, with ``_file``.

        Files older than the oldest of them are left out when Spark lists the folder.
        """
        oldest = files.agg(F.min("written")).first()[0]
        rows = self._since(oldest or datetime(9000, 1, 1)).withColumn("_file", file_of())
        return rows.join(files.select(F.col("file").alias("_file")), "_file", "left_semi")

    def recent(self, version: int, last: datetime, overlap_minutes: int) -> DataFrame | None:
        """Rows from ``overlap_minutes`` before ``last`` on, from files that were read already: those
        older than the oldest file whose time range reaches so far are left out at listing."""
        reaching = look_back(self.known(version), "last_time", last, minutes=overlap_minutes)
        start = reaching.agg(F.min("written")).first()[0]
        if start is None:
            return None
        rows = look_back(self._since(start).withColumn("_file", file_of()), self.at, last,
                         minutes=overlap_minutes)
        return rows.join(reaching.select(F.col("file").alias("_file")), "_file", "left_semi").drop(
            "_file")

    def _since(self, written: datetime) -> DataFrame:
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        text = self.spark.createDataFrame([(written,)], "t timestamp").select(
            F.date_format(F.col("t") - F.expr("interval 2 seconds"), "yyyy-MM-dd'T'HH:mm:ss")
        ).first()[0]
        return canonical_names(self.spark.read.schema(self._schema()).option("timeZone", zone)
                               .option("modifiedAfter", text).parquet(self.source))

    def _schema(self):
        return self.spark.read.parquet(self.source).schema

    def append(self, rows: DataFrame, files: DataFrame, version: int) -> None:
        """Describe ``files`` (file, written) by the ``rows`` read from them (see ``rows_of``).

        Written before the version that it belongs to is finished; repeating it changes nothing.
        """
        times = rows.groupBy(F.col("_file").alias("file")).agg(
            F.min(self.at).cast("timestamp_ntz").alias("first_time"),
            F.max(self.at).cast("timestamp_ntz").alias("last_time"))
        new = files.join(times, "file", "left").select(
            "file", "written", "first_time", "last_time",
            F.lit(version).cast("long").alias("version"))
        replace_table(new, f"{self.path}/polls", version=version)
        if version % GATHER == 0:
            replace_table(self.known(version), f"{self.path}/gathered", version=version, keep=2)
