"""Exact deduplication against a persistent digest index.

The index is a few runs, each a table bucketed and sorted by digest with one file a bucket, so a
run is read as it lies: a sort-merge join needs neither an exchange nor a sort of it. A batch is
reduced to one row per digest, anti-joined with the runs one after the other, and what is left is
appended as a run of its own. A run that is at least half as large as the one before is merged
with it, so there are at most about log2(rows) runs and a digest is written again that often. The
first batch that brings a text owns it; within a batch the smallest ``doc_id`` does.

Defined cases: a null text is an empty text; a null ``doc_id`` counts as larger than every other
one (a group of such rows only keeps them, with a null ``keep_id``); rows repeated with one
``doc_id`` and one text are one document and stay or go together (``dedup`` returns one of them);
an empty batch gives no rows and appends nothing; further columns are ignored by ``assign`` and
kept by ``dedup``. Running a batch again changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import SPACES, look_up, stored, table, text_of, work_dir


def text_digest(column: str = "text") -> Column:
    """SHA-256 of the text with each run of white space as one blank, lowercase hex."""
    return F.sha2(F.regexp_replace(text_of(column), SPACES, " "), 256)


class Run(NamedTuple):
    """Batches ``first`` to ``last`` in one table; wider runs replace those they cover."""

    first: int
    last: int
    buckets: int


@contextmanager
def ordered_scans(spark: SparkSession) -> Iterator[None]:
    """Plans made inside know that a bucket of one file is sorted."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class DigestIndex:
    """Digests seen so far, with the document that owns each of them.

    ``folder`` must be reachable by all executors; opening an existing folder continues it. One
    writer at a time. A run counts once its write was finished, so a batch that failed half-way can
    be run again. ``vacuum`` removes the runs that were merged into others; ``close`` takes the
    tables out of the session's catalog and leaves the files.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "digest_index_" + hashlib.md5(folder.encode()).hexdigest()

    def _files(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.folder)
        return hadoop, root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _finished(self) -> list[Run]:
        hadoop, root, fs = self._files()
        if not fs.exists(root):
            return []
        paths = [s.getPath() for s in fs.listStatus(root)]
        return [Run(*map(int, p.getName().split("-")[1:])) for p in paths if p.getName().startswith(
            "run-") and fs.exists(hadoop.Path(p, "_SUCCESS"))]

    def runs(self) -> list[Run]:
        """The finished runs that no other one covers, oldest first."""
        found = self._finished()
        return sorted(r for r in found if not any(
            o != r and o.first <= r.first and r.last <= o.last for o in found))

    def _path(self, run: Run) -> str:
        return f"{self.folder}/run-{run.first}-{run.last}-{run.buckets}"

    def _table(self, run: Run) -> str:
        return f"{self.name}_{run.first}_{run.last}"

    def read(self, run: Run) -> DataFrame:
        self.spark.sql(f"""create table if not exists {self._table(run)}
            (digest string, keep_id bigint) using parquet
            clustered by (digest) sorted by (digest) into {run.buckets} buckets
            location '{self._path(run)}'""")
        return self.spark.table(self._table(run))

    def rows(self) -> DataFrame:
        empty = self.spark.createDataFrame([], "digest string, keep_id bigint")
        return reduce(DataFrame.unionByName, map(self.read, self.runs()), empty)

    def _write(self, rows: DataFrame, first: int, last: int) -> Run:
        """``rows``, dealt out by digest, as one file a bucket."""
        run = Run(first, last, self.buckets)
        (rows.write.format("parquet").mode("overwrite").option("path", self._path(run))
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self._table(run)))
        return run

    def _remove(self, run: Run) -> None:
        hadoop, _, fs = self._files()
        self.spark.sql(f"drop table if exists {self._table(run)}")
        fs.delete(hadoop.Path(self._path(run)), True)

    def unknown(self, groups: DataFrame) -> DataFrame:
        """The (digest, keep_id) rows whose digest is not in the index, dealt out by digest."""
        new = groups.select("digest", F.col("keep_id").cast("long").alias("keep_id"))
        new = new.repartition(self.buckets, "digest")
        for run in self.runs():
            new = new.join(self.read(run).select("digest").hint("merge"), "digest", "left_anti")
        return new

    def append(self, groups: DataFrame) -> None:
        """Add the (digest, keep_id) rows whose digest is not in the index yet."""
        before = self.runs()
        number = before[-1].last + 1 if before else 1
        with ordered_scans(self.spark):
            added = self._write(self.unknown(groups), number, number)
            size = self.read(added).count()
            if size == 0:
                self._remove(added)
                return
            while before and self.read(before[-1]).count() <= 2 * size:
                older = before.pop()
                # Read as plain files: a union of bucketed tables may be written bucket by bucket
                # and table by table, which gives a bucket two files.
                both = self.spark.read.schema("digest string, keep_id bigint").parquet(
                    self._path(older), self._path(added))
                added = self._write(both.repartition(self.buckets, "digest"), older.first, number)
                size = self.read(added).count()

    def vacuum(self) -> None:
        """Remove runs that were merged into others; no query may still read them."""
        current = self.runs()
        for run in self._finished():
            if run not in current:
                self._remove(run)

    def close(self) -> None:
        for run in self._finished():
            self.spark.sql(f"drop table if exists {self._table(run)}")

    def owners(self, groups: DataFrame) -> DataFrame:
        """``groups`` (one row per digest) with the index's ``keep_id``; a digest is in one run."""
        known = groups.drop("keep_id")
        nothing = known.where(F.lit(False)).withColumn("keep_id", F.lit(None).cast("long"))
        return reduce(DataFrame.unionByName, [
            known.join(self.read(run).hint("merge"), "digest") for run in self.runs()], nothing)

    def assign(self, docs: DataFrame) -> DataFrame:
        """Add a batch; one row per document: doc_id, keep_id, group_size, kept, text_sha256.

        ``group_size`` counts the rows of this batch that have the text.
        """
        rows = stored(docs.select("doc_id", text_digest().alias("digest")), "digests")
        # Stored, or the optimizer would join the single rows of a hot text before they are grouped.
        groups = stored(rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"),
                                                   F.count(F.lit(1)).alias("group_size")),
                        "digest-groups")
        self.append(groups)
        with ordered_scans(self.spark):
            owned = stored(self.owners(groups), "digest-owners")
        found = look_up(rows, owned, "digest", "group_size", rows.count())
        return found.select("doc_id", "keep_id", "group_size",
                            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                            F.col("digest").alias("text_sha256"))

    def dedup(self, docs: DataFrame) -> DataFrame:
        """The documents of a batch that stay, with all their columns."""
        # One key without nulls for the join and for repeated rows, so the texts move once.
        name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        kept = self.assign(docs).where("kept").select(
            name.alias("id"), F.col("text_sha256").alias("digest")).distinct()
        marked = docs.select(F.struct(*docs.columns).alias("row"), name.alias("id"),
                             text_digest().alias("digest"))
        stays = marked.join(kept, ["id", "digest"], "left_semi")
        return stays.dropDuplicates(["id", "digest"]).select("row.*")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    index = DigestIndex(spark, work_dir(spark, "digest-index"))
    found = index.assign(table(spark, sf_dir, "documents"))
    index.close()
    return found


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose text none with a smaller ``doc_id`` has, with all their columns."""
    index = DigestIndex(spark, work_dir(spark, "digest-index"))
    kept = index.dedup(docs)
    index.close()
    return kept


SQL = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t
           from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = min(doc_id) over g as kept, sha256(t) as text_sha256
from n window g as (partition by t)
"""
