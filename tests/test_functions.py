import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitepulse import functions as fn
from sitepulse.functions.time import SLOT_EDGES, SLOT_NAMES
from tests.conftest import t


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        lit = F.lit(value)
        df = df.withColumn(name, lit)
    return df.select(column).first()[0]


def test_minutes_are_floored(spark):
    df = spark.createDataFrame([(t("01 00:00:00"), t("01 00:01:30"))], "a timestamp_ntz, b timestamp_ntz")
    row = df.select(fn.minutes_between("a", "b"), fn.minutes_between("b", "a"),
                    fn.minutes_between_exact("a", "b"), fn.hours_between("b", "a")).first()
    assert tuple(row) == (1, -2, 1.5, -1)


def test_slot_edges(spark):
    df = spark.createDataFrame([(t("01 03:59:59"),), (t("01 04:00:00"),), (t("01 00:00:00"),),
                                (t("01 23:59:59"),), (None,)], "a timestamp_ntz")
    assert [r[0] for r in df.select(fn.slot_label("a")).collect()] == [
        "12AM~4AM", "4AM~8AM", "12AM~4AM", "8PM~12AM", None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 27)), min_size=1, max_size=30))
def test_cut_like_pandas(spark, values):
    wanted = pd.cut(pd.Series(values, dtype="float"), SLOT_EDGES, labels=SLOT_NAMES)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    got = [r[0] for r in df.orderBy("i").select(fn.cut(F.col("v"), SLOT_EDGES, SLOT_NAMES)).collect()]
    assert got == [None if pd.isna(w) else w for w in wanted]


def test_cut_needs_matching_labels():
    with pytest.raises(ValueError):
        fn.cut(None, [0, 1], ["a", "b"])


def test_row_statistics_like_numpy(spark):
    data = [[1.0, 2.0, None, 4.0], [3.0, 3.0, 3.0, 3.0], [None, None, None, None], [5.0, 1.0, 1.0, 9.0]]
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame(data, "a double, b double, c double, d double").coalesce(1)
    got = df.select(fn.row_mean(cols), fn.row_min(cols), fn.row_max(cols), fn.row_range(cols),
                    fn.row_std(cols), fn.row_sum(cols), fn.row_null_count(cols),
                    fn.row_argmin(cols)).collect()
    pdf = pd.DataFrame(data, columns=cols, dtype=float)
    for i, r in enumerate(got):
        line = pdf.loc[i].dropna()
        if line.empty:
            assert tuple(r) == (None, None, None, None, None, 0.0, 4, None)
            continue
        assert r[:4] == pytest.approx((line.mean(), line.min(), line.max(), line.max() - line.min()))
        assert r[4] == pytest.approx(np.std(line, ddof=0))
        assert (r[5], r[6], r[7]) == (line.sum(), int(pdf.loc[i].isna().sum()), line.idxmin())


def test_row_slope_like_polyfit(spark):
    values = [3.0, 7.5, 1.0, 9.0]
    df = spark.createDataFrame([values], "a double, b double, c double, d double")
    assert df.select(fn.row_slope(["a", "b", "c", "d"])).first()[0] == pytest.approx(
        np.polyfit([1, 2, 3, 4], values, 1)[0])


def test_null_rules(spark):
    assert one(spark, fn.clip(F.lit(None).cast("double"), 0, 1)) is None
    assert one(spark, fn.clip(F.lit(7.0), 0, 1)) == 1.0
    assert [one(spark, fn.number_or_zero(F.lit(v))) for v in ("-", "--", "NA ", " 12.5 ")] == [
        0.0, 0.0, 0.0, 12.5]
    assert one(spark, fn.not_text(F.lit(None).cast("string"), "system", keep_null=True)) is True
    assert one(spark, fn.not_text(F.lit(None).cast("string"), "system", keep_null=False)) is False
    assert one(spark, fn.not_text(F.lit("SYSTEM"), "system", keep_null=True)) is False
    assert [one(spark, fn.text_flag(F.lit(v))) for v in ("True", "false", "1", "?")] == [
        True, False, True, None]
    assert one(spark, fn.ratio(F.lit(1.0), F.lit(0.0))) is None


def test_clamp_and_clock(spark):
    low, high = fn.as_of("2024-01-10"), fn.as_of("2024-01-20")
    assert one(spark, fn.clamp(F.lit(None).cast("timestamp_ntz"), low, high)) == t("20 00:00")
    assert one(spark, fn.clamp(fn.as_of("2024-01-01"), low, high)) == t("10 00:00")
    assert one(spark, fn.combine_date_time(F.lit("2024-01-05"), F.lit("07:08:09"))) == t("05 07:08:09")
    assert one(spark, fn.combine_date_time(F.lit("2024-01-05"), F.lit("late"))) is None
    assert one(spark, fn.days_before("2024-01-20 10:30:00", 3, whole_days=True)) == t("17 00:00")


def test_recode_and_first_match(spark):
    assert one(spark, fn.recode(F.lit("0702R"), {"0702R": "0702"})) == "0702"
    assert one(spark, fn.recode(F.lit("x"), {"0702R": "0702"}, keep_unmapped=False)) is None
    rules = [(F.lit(False), "a"), (F.lit(None).cast("boolean"), "b")]
    assert one(spark, fn.first_match(rules, "0")) == "0"
    assert one(spark, fn.first_match(rules)) is None
