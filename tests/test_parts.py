"""Tables that are written part by part, and the index of read files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from sitepulse import sources as src
from sitepulse.sources.writers import finished_versions
from tests.conftest import rows, t


def _files(path):
    return set(glob.glob(f"{path}/data/**/*.parquet", recursive=True))


def test_one_closed_ticket_writes_one_bucket(spark, frame, tmp_path):
    """Of a large table, one bucket is written for one closed ticket, and open ones are read alone."""
    path = str(tmp_path / "t")
    many = spark.range(1, 40_001).select(
        F.col("id").alias("ticket_id"), F.lit("b").alias("box_id"), F.lit("E").alias("error"),
        F.lit(t("01 00:00")).cast("timestamp_ntz").alias("opened_on"),
        F.when(F.col("id") % 100 != 0, F.lit(t("02 00:00")).cast("timestamp_ntz")).alias("closed_on"))
    table = src.TicketTable(spark, path, many.schema, buckets=64)
    table.begin(many)
    before = _files(path)
    assert len(before) >= 64
    one = spark.createDataFrame([(500,)], "ticket_id long")
    written = table.apply("2024-01-05", closed=one)
    new = _files(path) - before
    assert len(written) == 1 and len(new) == 2  # open and closed tickets of one bucket
    assert sum(spark.read.parquet(f).count() for f in new) < 40_000 / 40
    assert table.read().count() == 40_000 and table.open().count() == 399
    assert rows(table.read().filter("ticket_id = 500"), "closed_on") == [(t("05 00:00"),)]
    plan = table.open()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_open" in plan
    # Nothing to do writes nothing.
    assert table.apply("2024-01-06", closed=one.filter("ticket_id < 0")) == []
    assert _files(path) - before == new


def test_ids_are_never_given_twice(spark, tmp_path):
    known = spark.createDataFrame([(7, "a", None)], "ticket_id long, box_id string, closed_on timestamp_ntz")
    table = src.TicketTable(spark, str(tmp_path / "t"), known.schema, buckets=4)
    fresh = spark.createDataFrame([("x",), ("y",)], "box_id string")
    assert table.open().count() == 0
    table.begin(known)
    table.apply("2024-01-05", opened=fresh)
    table.apply("2024-01-05", closed=table.open().select("ticket_id"))
    table.apply("2024-01-06", opened=fresh)
    assert [r[0] for r in table.read().orderBy("ticket_id").select("ticket_id").collect()] == [7, 8, 9, 10, 11]
    assert rows(table.open(), "box_id") == [("x",), ("y",)]


def test_a_stop_before_the_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    """Data of the new version is there, but readers and the next run go on with the old one."""
    from sitepulse.sources import parts
    table = src.PartTable(spark, str(tmp_path / "d"), "date")
    days = spark.createDataFrame([("x", "2024-01-01"), ("y", "2024-01-02")], "v string, date string")
    table.replace(days, ["2024-01-01", "2024-01-02"])

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    new = spark.createDataFrame([("z", "2024-01-01")], "v string, date string")
    with monkeypatch.context() as m:
        m.setattr(parts, "replace_table", stop)
        with pytest.raises(RuntimeError):
            table.replace(new, ["2024-01-01"])
    assert rows(table.read(), "v") == [("x",), ("y",)] and table.version() == 1
    table.replace(new, ["2024-01-01"])
    assert rows(table.read(), "v") == [("y",), ("z",)]
    table.replace(new.limit(0), ["2024-01-02"])
    assert rows(table.read(), "v") == [("z",)]
    table.replace(new.limit(0), ["2024-01-01"])
    assert table.read().isEmpty() and table.read().columns == ["v", "date"]


def test_readers_keep_the_files_they_planned(spark, tmp_path):
    """A replaced part stays for its readers, and goes when its time is over."""
    table = src.PartTable(spark, str(tmp_path / "d"), "date")
    one = spark.createDataFrame([("x", "2024-01-01")], "v string, date string")
    table.replace(one, ["2024-01-01"])
    reader = table.read()
    table.replace(one.withColumn("v", F.lit("y")), ["2024-01-01"])
    assert rows(reader, "v") == [("x",)] and rows(table.read(), "v") == [("y",)]
    src.PartTable(spark, table.path, "date", keep_hours=0).replace(one, ["2024-01-01"])
    assert sorted(os.listdir(f"{table.path}/data")) == ["_write=1", "_write=2", "_write=3"]
    assert len(_files(table.path)) == 2  # the one replaced just now and the current one
    assert finished_versions(spark, f"{table.path}/manifest") == [2, 3]


def test_rows_outside_the_parts_are_refused(spark, tmp_path):
    table = src.PartTable(spark, str(tmp_path / "d"), "date")
    df = spark.createDataFrame([("x", "2024-01-01"), ("y", "2024-01-02")], "v string, date string")
    with pytest.raises(ValueError, match="2024-01-02"):
        table.replace(df, ["2024-01-01"])
    assert not table.exists()


def test_customers_by_bucket_read_their_own_table(spark, tmp_path):
    table = src.KeyedTable(spark, str(tmp_path / "k"), ["bank"], buckets=8)
    df = spark.createDataFrame([(c, i) for i, c in enumerate("abcdefghijkl")] + [(None, 99)], "bank string, v int")
    table.replace_keys(df, df)
    before = _files(table.path)
    keys = df.filter("bank in ('b', 'c')")
    table.replace_keys(table.read().filter("bank = 'b'").withColumn("v", -F.col("v")), keys)
    assert rows(table.read().filter("v < 0 or bank = 'c' or bank is null")) == [(None, 99), ("b", -1)]
    assert table.read().count() == 12 and 1 <= len(_files(table.path) - before) <= 2
    table.replace_keys(df.limit(0), df.filter("bank is null").select("bank"))
    assert table.read().count() == 11


def _signals(spark, folder, *signals):
    df = spark.createDataFrame([(b, t(at)) for b, at in signals], "box_id string, at_time timestamp_ntz")
    df.coalesce(1).write.mode("append").parquet(folder)


def _age(folder, minutes):
    import time
    for f in glob.glob(f"{folder}/*.parquet"):
        os.utime(f, (os.stat(f).st_mtime - 60 * minutes,) * 2)


def test_file_index_finds_new_files_whatever_their_times(spark, tmp_path):
    source = str(tmp_path / "in with blank+%20")
    index = src.FileIndex(spark, source, str(tmp_path / "index"))
    _signals(spark, source, ("a", "10 10:00"), ("b", "10 11:00"))
    assert index.unread(0).count() == 1

    def poll(version):
        files = index.unread(version - 1)
        got = rows(index.rows_of(files), "box_id")
        listed = files.collect()  # as the jobs do, the list is fixed before it is used
        fixed = spark.createDataFrame(listed, files.schema)
        index.append(index.rows_of(fixed), fixed, version)
        return got

    assert poll(1) == [("a",), ("b",)] and index.unread(1).count() == 0
    _age(source, 600)
    _signals(spark, source, ("c", "01 00:00"))  # a late upload with old times
    _signals(spark, source, ("d", "2025-01-01 00:00"))
    assert poll(2) == [("c",), ("d",)]
    # A version that was not finished does not count; the same poll is made again.
    assert rows(index.rows_of(index.unread(1)), "box_id") == [("c",), ("d",)]
    assert poll(2) == [("c",), ("d",)] and index.unread(2).isEmpty()
    known = index.known(2)
    assert known.count() == 3 and known.filter("first_time < last_time").count() == 1
    # A file that keeps an old age is found by its name.
    _signals(spark, source, ("e", "10 12:00"))
    _age(source, 6000)
    assert poll(3) == [("e",)]


def test_file_index_prunes_old_files_and_its_plan_does_not_grow(spark, tmp_path):
    source = str(tmp_path / "in")
    index = src.FileIndex(spark, source, str(tmp_path / "index"))
    sizes, seen = [], set()
    for version in (1, 2, 3):
        for i in range(8):
            _signals(spark, source, ("a", f"{version:02d} 0{i}:00"))
        for f in set(glob.glob(f"{source}/*.parquet")) - seen:
            os.utime(f, (1_700_000_000 + 3600 * version,) * 2)
            seen.add(f)
        files = index.unread(version - 1)
        df = index.rows_of(files)
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
        fixed = spark.createDataFrame(files.collect(), files.schema)
        index.append(df, fixed, version)
    assert sizes[2] < sizes[1] + 200 and sizes[1] < sizes[0] + 2500
    _signals(spark, source, ("new", "09 00:00"))
    files = index.unread(3)
    df = index.rows_of(spark.createDataFrame(files.collect(), files.schema))
    # The unread file, not the 24 old ones.
    assert sum(f"{source}/" in f for f in df.inputFiles()) < 4
    again = index.recent(3, t("03 07:00"), 90)
    assert rows(again, "at_time") == [(t("03 06:00"),), (t("03 07:00"),)]


def test_gathered_index_is_the_same(spark, tmp_path, monkeypatch):
    from sitepulse.sources import files as module
    monkeypatch.setattr(module, "GATHER", 2)
    source = str(tmp_path / "in")
    index = src.FileIndex(spark, source, str(tmp_path / "index"))
    for version in range(1, 6):
        _signals(spark, source, ("a", f"0{version} 00:00"))
        files = index.unread(version - 1)
        assert files.count() == 1
        fixed = spark.createDataFrame(files.collect(), files.schema)
        index.append(index.rows_of(fixed), fixed, version)
    assert index.known(5).count() == 5 and index.unread(5).isEmpty()
