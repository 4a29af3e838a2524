"""Sinks. Every write is one Spark job; nothing is looped over rows."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.operators.joins import anti


def _gathered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of one slice together, so that a slice is few files; Spark splits large slices."""
    return df.hint("rebalance", *columns) if columns else df


def append(df: DataFrame, path: str, *, partition_by: Sequence[str] = (),
           fmt: str = "parquet") -> None:
    """Append by column name."""
    (_gathered(df, partition_by).write.format(fmt).mode("append").partitionBy(*partition_by)
     .save(path))


def replace_slices(df: DataFrame, path: str, slice_by: Sequence[str] = ("bank",)) -> None:
    """Replace exactly the slices (customers, days) present in ``df``; the others stay.

    A slice without any new row keeps its old rows; ``replace_customers`` empties it. The target
    must not be an input of ``df``.
    """
    (_gathered(df, slice_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*slice_by).parquet(path))


def finished_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a table whose write was completed, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    done = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("v=")
            and fs.exists(hadoop.Path(s.getPath(), "_SUCCESS"))]
    return sorted(int(p.getName()[2:]) for p in done)


def _forget(spark: SparkSession, path: str, versions: Sequence[int]) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for version in versions:
        fs.delete(hadoop.Path(f"{path}/v={version}"), True)


def _written_at(spark: SparkSession, path: str, version: int) -> float:
    """Seconds since 1970 at which the version was finished."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    done = hadoop.Path(f"{path}/v={version}/_SUCCESS")
    fs = done.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(done).getModificationTime() / 1000


def replace_table(df: DataFrame, path: str, *, skip_empty: bool = False,
                  version: int | None = None, keep: int | None = None,
                  keep_hours: float | None = None) -> str:
    """Write the next version of a whole table and return its folder.

    ``df`` may read the current version: that one stays until readers have moved on. A version
    counts only once its ``_SUCCESS`` file exists, so a failed run leaves the old table in place.
    A given ``version`` is written again when the same step is repeated. ``keep`` removes all but
    that many of the newest versions; ``keep_hours`` removes versions that were followed by a
    newer one longer ago than that, so a reader has that time for its scan.
    """
    found = finished_versions(df.sparkSession, path)
    if skip_empty and found and df.isEmpty():
        return f"{path}/v={found[-1]}"
    if version is None:
        version = found[-1] + 1 if found else 1
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    if keep is not None:
        older = [v for v in found if v < version]
        _forget(df.sparkSession, path, older[:max(0, len(older) - keep + 1)])
    if keep_hours is not None:
        kept = [v for v in finished_versions(df.sparkSession, path) if v <= version]
        limit = time.time() - 3600 * keep_hours
        _forget(df.sparkSession, path, [v for v, newer in zip(kept, kept[1:]) if _written_at(
            df.sparkSession, path, newer) < limit])
    return f"{path}/v={version}"


def current_version(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest finished version, or the newest one below ``before``."""
    found = [v for v in finished_versions(spark, path) if before is None or v < before]
    if not found:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/v={found[-1]}")


def replace_customers(df: DataFrame, path: str, customers: DataFrame, key: str = "bank", *,
                      keep_hours: float | None = None) -> str:
    """Next version of a table: rows of the listed customers are replaced by ``df``."""
    spark = df.sparkSession
    if not finished_versions(spark, path):
        return replace_table(df, path)
    kept = anti(current_version(spark, path), customers, [key])
    return replace_table(kept.unionByName(df), path, keep_hours=keep_hours)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_sheets(sheets: Mapping[str, DataFrame], path: str, fmt: str = "csv") -> None:
    """A report of several sheets: one folder per sheet."""
    for name, df in sheets.items():
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", "true")
        writer.save(f"{path}/{name}")


def _printable(df: DataFrame) -> list[Column]:
    return [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if kind.startswith("timestamp")
            else F.col(c) for c, kind in df.dtypes]


def json_records(df: DataFrame, name: str = "record") -> DataFrame:
    """One JSON object per row, times as text, NULL fields kept."""
    return df.select(F.to_json(F.struct(*_printable(df)),
                               {"ignoreNullFields": "false"}).alias(name))


def write_json(df: DataFrame, path: str) -> None:
    (df.select(*_printable(df)).write.mode("overwrite")
     .option("ignoreNullFields", "false").json(path))


def nested_document(df: DataFrame, boxes: Mapping[str, Mapping]) -> DataFrame:
    """One JSON document per row: box -> title, total and a map of sub-totals.

    A box is ``{"title": text, "table": text, "total": column, "parts": {label: column}}`` and
    may have a ``"subtitle"``.
    """
    out = []
    for name, box in boxes.items():
        parts = []
        for label, column in box["parts"].items():
            parts += [F.lit(label), F.col(column)]
        subtitle = [F.lit(box["subtitle"]).alias("subtitle")] if "subtitle" in box else []
        out.append(F.struct(
            F.lit(box["title"]).alias("title"), *subtitle, F.lit(box["table"]).alias("tablename"),
            F.col(box["total"]).alias("total"), F.create_map(*parts).alias("sub-total"),
        ).alias(name))
    return df.select(F.to_json(F.struct(*out)).alias("document"))
