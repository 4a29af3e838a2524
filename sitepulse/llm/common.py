"""Helpers shared by the corpus operators: tables, stored intermediate results, skewed look-ups."""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.session import shared_dir

# White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def on_workers(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``fn(spark, ...)`` with this package on the Python path of the workers.

    That serves a driver started from another folder. On a cluster whose nodes do not share the
    folder, ship the package with ``--py-files``; the entry does no harm there.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    @functools.wraps(fn)
    def run(spark: SparkSession, *args):
        environment = spark.sparkContext.environment
        paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
        return fn(spark, *args)

    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, below a folder of this application."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe against lost executors."""
    folder = work_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def look_up(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group (one row per ``key``), hot groups without a shuffle.

    ``size`` counts the rows of each group and ``total`` all rows. Groups above a thousandth of
    all rows are at most a thousand, so they are broadcast; the rest is joined by key. ``key``
    must not be null.
    """
    limit = max(200, total // 1000)
    hot = F.broadcast(groups.where(F.col(size) > limit))
    cold = groups.where(F.col(size) <= limit)
    rest = rows.join(hot.select(key), key, "left_anti")  # hot rows don't meet in one task
    return rows.join(hot, key).unionByName(rest.join(cold, key))


def one_by_one(rows: DataFrame, count: str, number: str, at_once: int = 10_000) -> DataFrame:
    """Each row as often as its column ``count`` (1 or more) says, numbered 0, 1, ... in ``number``.

    A row that comes more than ``at_once`` times is dealt out in parts first, so that no task
    writes all of them.
    """
    n = F.col(count).cast("long")
    zero = F.lit(0).cast("long")
    few = rows.where(n <= at_once).withColumn(number, F.explode(F.sequence(zero, n - 1)))
    parts = F.sequence(zero, F.floor((n - 1) / at_once))
    many = rows.where(n > at_once).withColumn("_part", F.explode(parts)).repartition(
        count, "_part")
    first = F.col("_part") * at_once
    many = many.withColumn(number, F.explode(F.sequence(
        first, F.least(n, first + at_once) - 1))).drop("_part")
    return few.unionByName(many)
