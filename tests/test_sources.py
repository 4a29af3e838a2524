import json

import pytest
from pyspark.sql import functions as F

from sitepulse import sources as src
from tests.conftest import rows, t


def test_filters_and_columns_reach_the_scan(spark):
    df = src.read_table(spark, "/root/testdata/sf0.001/events.parquet", ["event_id"],
                        F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_look_back_is_a_plain_filter(spark):
    df = src.look_back(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "ts",
                       "2024-01-31 00:00:00", days=3)
    assert "GreaterThanOrEqual(ts,2024-01-28T00:00" in df._jdf.queryExecution().executedPlan().toString()


def test_slices(spark):
    df = spark.createDataFrame([(t(x),) for x in ("01 00:00", "01 23:59:59", "02 00:00", "31 23:59")], "a timestamp_ntz")
    assert src.day_slice(df, "a", "2024-01-01", "2024-01-02").count() == 2
    assert src.day_slice(df, "a", "2024-01-01", "2024-01-02", closed=True).count() == 3
    assert src.month_slice(df, "a", "2024-01-01").count() == 4


def test_scope(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "bank string")
    assert [src.scope(df, b).count() for b in ("ALL", ["All"], "x", ["x", "y"])] == [3, 3, 1, 2]


def test_canonical_names(spark):
    df = spark.createDataFrame([("1", "True", "2024")], "McuID string, qStatus string, GetDate string")
    out = src.canonical_names(df)
    assert out.columns == ["site_id", "active", "received"] and out.first()["active"] is True


def test_jdbc_options_are_split_and_carry_the_callers_login():
    got = src.jdbc_options("jdbc:x", "t", split_on="id", low=1, high=9, parts=4, user="u")
    assert got["numPartitions"] == "4" and got["partitionColumn"] == "id" and got["user"] == "u"


def test_header_rows(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("Report of May,,\nSite , Month,Amount\na,May,1\nSite,Month,Amount\nb,,2\n,May,9\n")
    raw = src.read_sheets(spark, {"s": str(tmp_path / "sheet.csv")}, header=False)["s"]
    body = src.promote_header(raw.filter("_c0 is null or _c0 not like 'Report%'"), "Site")
    assert body.columns == ["Site", "Month", "Amount"]
    assert rows(src.drop_header_rows(body, "Month")) == [(None, "May", "9"), ("a", "May", "1")]
    with pytest.raises(ValueError):
        src.promote_header(raw, "nothing")


def test_versions_survive_a_failed_write(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        src.current_version(spark, path)
    src.replace_table(spark.range(3).toDF("a"), path)
    src.replace_table(src.current_version(spark, path).filter("a > 0"), path)
    (tmp_path / "t" / "v=3").mkdir()
    assert rows(src.current_version(spark, path)) == [(1,), (2,)]
    assert rows(src.current_version(spark, path, before=2)) == [(0,), (1,), (2,)]
    src.replace_table(spark.range(0).toDF("a"), path, skip_empty=True)
    assert src.current_version(spark, path).count() == 2


def test_replace_customers_empties_a_slice(spark, tmp_path):
    path = str(tmp_path / "c")
    table = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "bank string, v int")
    src.replace_customers(table, path, table)
    src.replace_customers(spark.createDataFrame([("x", 9)], "bank string, v int"), path,
                          table.filter("bank != 'z'"))
    assert rows(src.current_version(spark, path)) == [("x", 9), ("z", 3)]


def test_replace_slices_keeps_other_customers(spark, tmp_path):
    path = str(tmp_path / "s")
    src.replace_slices(spark.createDataFrame([("x", 1), ("y", 2)], "bank string, v int"), path)
    src.replace_slices(spark.createDataFrame([("x", 5), ("x", 6)], "bank string, v int"), path)
    assert rows(spark.read.parquet(path), "bank", "v") == [("x", 5), ("x", 6), ("y", 2)]


def test_ticket_changes_are_idempotent(spark):
    tickets = spark.createDataFrame(
        [(1, None, None), (2, t("01 00:00"), None), (3, None, t("02 00:00"))],
        "ticket_id long, closed_on timestamp_ntz, latest_remote_recording timestamp_ntz")
    ids = tickets.select("ticket_id").filter("ticket_id < 3")
    seen = spark.createDataFrame([(3, t("05 00:00")), (3, t("04 00:00"))], "ticket_id long, latest_remote_recording timestamp_ntz")
    once = src.apply_ticket_changes(tickets, "2024-01-31", closed=ids.union(ids), touched=seen)
    wanted = [(1, t("31 00:00"), None), (2, t("01 00:00"), None), (3, None, t("05 00:00"))]
    assert rows(once) == wanted
    assert rows(src.apply_ticket_changes(once, "2024-02-09", closed=ids, touched=seen)) == wanted


def test_json_keeps_nulls_and_prints_times(spark, tmp_path):
    df = spark.createDataFrame([(1, None, t("01 02:03:04"))], "a int, b string, c timestamp_ntz")
    assert json.loads(src.json_records(df).first()[0]) == {"a": 1, "b": None, "c": "2024-01-01 02:03:04"}
    src.write_json(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":1,"b":null,"c":"2024-01-01 02:03:04"}'


def test_nested_document(spark):
    df = spark.createDataFrame([(7, 3)], "total int, part int")
    doc = src.nested_document(df, {"box1": {"title": "T", "table": "t", "total": "total", "parts": {">4": "part"}}})
    assert json.loads(doc.first()[0]) == {"box1": {"title": "T", "tablename": "t", "total": 7, "sub-total": {">4": 3}}}


def test_sheets_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    src.write_sheets({"one": df, "two": df}, str(tmp_path / "w"))
    back = src.read_sheets(spark, {n: str(tmp_path / "w" / n) for n in ("one", "two")}, {"one": "k string, v int"})
    assert back["one"].first()["v"] == 1 and back["two"].first()["v"] == "1"
    src.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).columns == ["k", "v"]


def test_append_by_name(spark, tmp_path):
    src.append(spark.createDataFrame([("x", 1)], "bank string, v int"), str(tmp_path / "a"), partition_by=["bank"])
    src.append(spark.createDataFrame([(2, "y")], "v int, bank string"), str(tmp_path / "a"), partition_by=["bank"])
    assert rows(spark.read.parquet(str(tmp_path / "a")), "bank", "v") == [("x", 1), ("y", 2)]


def test_header_keeps_rows_with_a_blank_first_cell(spark):
    raw = spark.createDataFrame([("Site", "Month"), ("a", "1"), (None, "2"), ("", "3"), ("Site", "Month"), ("Site", "4")],
                                "_c0 string, _c1 string")
    assert rows(src.promote_header(raw, "Site"), "Month") == [("1",), ("2",), ("3",), ("4",)]


def test_a_failed_run_keeps_the_old_day(spark, tmp_path):
    path = str(tmp_path / "daily")
    src.replace_day(spark.createDataFrame([("x", "2024-01-01")], "v string, date string"), path, "2024-01-01")
    broken = spark.range(1).select(F.raise_error(F.lit("no")).cast("string").alias("v"), F.lit("2024-01-01").alias("date"))
    with pytest.raises(Exception):
        src.replace_day(broken, path, "2024-01-01")
    assert rows(src.read_parts(spark, path), "v") == [("x",)]
    src.replace_day(spark.createDataFrame([("y", "2024-01-01")], "v string, date string"), path, "2024-01-01")
    assert rows(src.read_parts(spark, path), "v") == [("y",)]


def test_a_day_is_replaced_under_a_reader_and_by_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "daily")
    day = lambda v, d: spark.createDataFrame([(v, d)], "v string, date string")
    src.replace_day(day("x", "2024-01-01"), path, "2024-01-01")
    src.replace_day(day("z", "2024-01-02"), path, "2024-01-02")
    reader = src.read_parts(spark, path)
    with monkeypatch.context() as m:  # stopped when all rows are written and none is published
        m.setattr("sitepulse.sources.parts.replace_table", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            src.replace_day(day("lost", "2024-01-01"), path, "2024-01-01")
    assert rows(src.read_parts(spark, path), "v") == [("x",), ("z",)]
    src.replace_day(day("y", "2024-01-01"), path, "2024-01-01")
    assert rows(reader, "v") == [("x",), ("z",)]  # its files are still there
    assert rows(src.read_parts(spark, path), "v") == [("y",), ("z",)]
    src.replace_day(day("y", "2024-01-01").limit(0), path, "2024-01-01")
    assert rows(src.read_parts(spark, path), "v") == [("z",)]


def test_a_slice_is_few_files(spark, tmp_path):
    df = spark.range(4000).select(F.col("id").alias("v"), (F.col("id") % 5).cast("string").alias("bank")).repartition(40)
    for write, name in ((src.replace_slices, "r"), (lambda d, p: src.append(d, p, partition_by=["bank"]), "a")):
        write(df, str(tmp_path / name))
        files = list((tmp_path / name).glob("bank=*/*.parquet"))
        assert 5 <= len(files) <= 10


def test_versions_are_kept_for_some_hours(spark, tmp_path):
    import os
    import time
    path = str(tmp_path / "t")
    for i in range(4):
        src.replace_table(spark.range(i + 1).toDF("a"), path, keep_hours=1)
    assert len(os.listdir(path)) == 4
    for v in (1, 2, 3):
        os.utime(f"{path}/v={v}/_SUCCESS", (time.time() - 7200 - 10 * v,) * 2)
    src.replace_table(spark.range(9).toDF("a"), path, keep_hours=1)
    assert sorted(os.listdir(path)) == ["v=3", "v=4", "v=5"]


def test_numbers_do_not_depend_on_the_partitions(spark):
    from sitepulse.sources.tickets import number_rows
    df = spark.range(700).select((F.col("id") % 350).alias("a"), F.col("id").alias("b"))
    one, two = (rows(number_rows(df.repartition(n), "ticket_id", 41), "b", "ticket_id") for n in (1, 13))
    assert one == two and sorted(i for _, i in one) == list(range(42, 742))


def test_subtitle_of_a_box(spark):
    df = spark.createDataFrame([(7, 3)], "total int, part int")
    doc = src.nested_document(df, {"b": {"title": "T", "table": "t", "subtitle": "S", "total": "total", "parts": {"p": "part"}}})
    assert json.loads(doc.first()[0])["b"]["subtitle"] == "S"
