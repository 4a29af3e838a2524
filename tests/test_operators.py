"""Operators against pandas or brute force, also with one key holding most rows."""

import random
import re
from datetime import datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitepulse import operators as op
from sitepulse.operators.intervals import dealt_rows
from tests.conftest import rows, t

SLOW = settings(max_examples=6, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(st.lists(st.one_of(st.none(), st.sampled_from([0.0, -1.5, -1e9, 1e-9, 2.0, 2.0000001, 7.0]),
                          st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_pct_rank_like_pandas(spark, values):
    wanted = pd.Series(values, dtype=float).rank(pct=True)
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = {r["i"]: r["p"] for r in op.pct_rank(df, "v", "p", digits=None).collect()}
    assert len(got) == len(values)
    for i, w in enumerate(wanted):
        assert (got[i] is None) if pd.isna(w) else got[i] == pytest.approx(w)


def test_pct_rank_edges_of_ranges(spark):
    """Values on both sides of a power of two, tiny and huge ones, keep their order."""
    values = [s * v for s in (-1, 1) for e in range(-1000, 1001, 50) for v in
              (2.0 ** e, 2.0 ** e * (1 + 1e-9))] + [0.0, 5e-324, 1.7e308]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["v"] for r in op.pct_rank(df, "v", "p", digits=None).orderBy("p").collect()]
    assert got == sorted(values)


def test_pct_rank_of_a_hot_value(spark):
    values = [0] * 700 + list(range(1, 301))
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = {r["v"]: r["p"] for r in op.pct_rank(df, "v", "p", digits=None).distinct().collect()}
    wanted = pd.Series(values).rank(pct=True)
    assert got == {v: pytest.approx(w) for v, w in zip(values, wanted)}


def _spans(rng, key, count, open_share):
    out = []
    for _ in range(count):
        start = datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 6000))
        end = None if rng.random() < open_share else start + timedelta(minutes=rng.choice([0, 5, 90, 900]))
        out.append((key, start, end))
    return out


@pytest.mark.parametrize("open_covers", [True, False])
@pytest.mark.parametrize("bin_unit", ["hour", "day"])
def test_covered_points_like_brute_force(spark, open_covers, bin_unit):
    rng = random.Random(5)
    spans = _spans(rng, "hot", 60, 0.0) + _spans(rng, "b", 6, 0.2) + [("c", t("01 00:00"), None)]
    points = [(i, rng.choice(["hot", "hot", "hot", "b", "c", "none", None]),
               datetime(2024, 1, 1) + timedelta(minutes=rng.randint(-60, 8000))) for i in range(400)]
    # Points exactly on both ends of a span.
    points += [(1000, "hot", spans[0][1]), (1001, "hot", spans[0][2]), (1002, "hot", None)]
    span_df = spark.createDataFrame(spans, "k string, a timestamp_ntz, z timestamp_ntz")
    df = spark.createDataFrame(points, "i int, k string, at timestamp_ntz")
    got = op.covered_points(df, {"hit": span_df, "early": span_df.filter("k = 'b'")}, "k", "at", "a",
                            "z", bin_unit=bin_unit, open_covers=open_covers)

    def covered(k, at, only=None):
        return any(sk == k and at is not None and a <= at and (open_covers if z is None else z >= at)
                   for sk, a, z in spans if only in (None, sk))

    assert {r["i"]: (r["hit"], r["early"]) for r in got.collect()} == {
        i: (covered(k, at), covered(k, at, "b")) for i, k, at in points}
    assert got.columns == ["i", "k", "at", "hit", "early"]


def _busy_hour(spark, points=2700, spans=900):
    """90 % of all points and spans lie in one site and hour, some of them at the same instant."""
    rng = random.Random(11)
    first = datetime(2024, 1, 5, 10)

    def when(i):
        if i % 10 == 0:
            return datetime(2024, 1, 1) + timedelta(seconds=rng.randint(0, 10 * 86400))
        if i % 50 == 1:
            return first + timedelta(minutes=17)
        return first + timedelta(microseconds=rng.randint(0, 3_600_000_000 - 1))

    def key(i):
        return f"s{rng.randint(0, 40)}" if i % 10 == 0 else "busy"

    made = []
    for i in range(spans):
        a = when(i)
        # Mostly moments; a few last into the next hours, one is open, one ends before it starts.
        length = 0.4 if i % 60 else rng.choice([3, 70, 900])
        z = None if i == 5 else a + timedelta(seconds=-5 if i == 6 else length)
        made.append((key(i), a, z))
    made.append(("busy", first - timedelta(hours=3), first + timedelta(minutes=2)))
    asked = [(i, key(i), when(i)) for i in range(points)]
    asked += [(10_000 + i, "busy", z) for i, (k, _, z) in enumerate(made) if k == "busy" and z][:300]
    asked += [(20_000, None, first), (20_001, "busy", None)]
    return (asked, made, spark.createDataFrame(asked, "i int, k string, at timestamp_ntz"),
            spark.createDataFrame(made, "k string, a timestamp_ntz, z timestamp_ntz"))


@pytest.mark.parametrize("open_covers", [True, False])
@pytest.mark.parametrize("unit", ["second", "minute"])
def test_busy_hour_like_brute_force(spark, open_covers, unit):
    asked, made, points, spans = _busy_hour(spark)
    kinds = {"all": spans, "some": spans.filter("second(a) % 3 = 0")}
    got = op.covered_points(points, kinds, "k", "at", "a", "z", busy_rows=100, piece_unit=unit,
                            open_covers=open_covers)

    def covered(k, at, some):
        return any(sk == k and at is not None and a <= at and (open_covers if z is None else z >= at)
                   for sk, a, z in made if not some or a.second % 3 == 0)

    assert {r["i"]: (r["all"], r["some"]) for r in got.collect()} == {
        i: (covered(k, at, False), covered(k, at, True)) for i, k, at in asked}
    assert got.columns == ["i", "k", "at", "all", "some"]


def test_busy_hour_is_no_large_group_and_spans_are_scanned_once(spark, tmp_path):
    _, _, points, spans = _busy_hour(spark)
    points.write.parquet(str(tmp_path / "points"))
    spans.write.parquet(str(tmp_path / "spans"))
    points, spans = (spark.read.parquet(str(tmp_path / n)) for n in ("points", "spans"))
    rows, _ = dealt_rows(points, {"hit": spans}, "k", "at", "a", "z", busy_rows=100)
    largest = rows.groupBy("k", "_piece", "_part").count().agg(F.max("count")).first()[0]
    assert largest < 0.03 * rows.count()
    # Dealt out as the window deals them: no task is far above the median one.
    sizes = [r["n"] for r in rows.repartition(40, "k", "_piece", "_part").groupBy(
        F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 40 and max(sizes) < 3 * sorted(sizes)[20]
    out = op.covered_points(points, {"hit": spans}, "k", "at", "a", "z", busy_rows=100)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scans = re.findall(r"FileScan parquet.*", plan)
    assert sum("/spans" in scan for scan in scans) == 1 and "ReusedExchange" in plan


def test_latest_keeps_one_row_per_map_task(spark):
    df = spark.range(1000).select((F.col("id") > 5000).alias("k"), F.col("id").alias("v"))
    latest = op.latest_per_key(df, ["k"], ["v"])
    assert rows(latest) == [(False, 999)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_first_and_last_rows_with_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, t("01 10:00")), ("a", 3, t("01 10:00")),
                                (None, 4, t("01 09:00"))], "k string, i int, at timestamp_ntz")
    assert rows(op.latest_per_key(df, ["k"], ["at", "i"]), "k", "i") == [(None, 4), ("a", 3)]
    assert rows(op.first_per_key(df, ["k"], ["at", "i"]), "k", "i") == [(None, 4), ("a", 2)]
    assert rows(op.superseded(df, ["k"], ["at", "i"], "i"), "i") == [(1,), (2,)]


def test_last_non_null_per_column(spark):
    df = spark.createDataFrame([("a", 1, "x", None), ("a", 2, None, "y"), ("a", 3, None, None)],
                               "k string, at int, p string, q string")
    assert rows(op.last_non_null(df, ["k"], "at", ["p", "q"])) == [("a", "x", "y")]


def test_null_safe_anti_matches_nulls(spark):
    left = spark.createDataFrame([(1, None), (1, 5), (2, None)], "a int, b int")
    right = spark.createDataFrame([(1, None)], "a int, b int")
    assert rows(op.null_safe_anti(left, right, ["a", "b"])) == [(1, 5), (2, None)]
    assert rows(op.null_safe_semi(left, right, ["a", "b"])) == [(1, None)]
    assert rows(op.anti(left, right, ["a", "b"])) == [(1, None), (1, 5), (2, None)]
    assert rows(op.without_matches(left, right)) == [(1, 5), (2, None)]


def test_except_keeps_duplicates(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    assert rows(op.except_rows(left, spark.createDataFrame([(2,)], "a int"))) == [(1,), (1,)]


def test_group_size_counts_null_keys_too(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), (None,)], "k string")
    assert rows(op.group_size(df, ["k"], "n")) == [(None, 3)] * 3 + [("a", 2)] * 2


@SLOW
@given(st.lists(st.tuples(st.sampled_from("pqr"), st.integers(1, 5)), max_size=12),
       st.lists(st.tuples(st.sampled_from("pqr"), st.integers(1, 5)), max_size=12),
       st.lists(st.tuples(st.sampled_from("pqr"), st.integers(1, 5)), max_size=12))
def test_outer_join_sums_like_the_joins(spark, a, b, c):
    frames = {n: pd.DataFrame(r, columns=["k", n]) for n, r in (("a", a), ("b", b), ("c", c))}
    joined = frames["a"].merge(frames["b"], on="k", how="outer").merge(frames["c"], on="k", how="outer")
    wanted = joined.astype({n: float for n in frames}).fillna(0).groupby("k").sum()
    sides = [(spark.createDataFrame(r, f"k string, {n} int"), n)
             for n, r in (("a", a), ("b", b), ("c", c))]
    got = op.outer_join_sums(sides, ["k"]).toPandas().set_index("k").sort_index()
    assert got.astype(float).to_dict() == wanted.astype(float).sort_index().to_dict()


def test_pivot_text_repeats_labels(spark):
    df = spark.createDataFrame([("a", "1", "NO"), ("a", "1", "NO"), ("a", "1", "YES"), ("a", "2", "PR"),
                                ("b", "2", None)], "k string, d string, l string")
    out = op.pivot_text(df, ["k"], "d", {"1": "d1", "2": "d2"}, "l", ["NO", "PR", "YES"])
    assert rows(out) == [("a", "NO NO YES", "PR"), ("b", None, None)]


def test_pivot_unique_refuses_duplicates(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "k string, c string, v int")
    assert rows(op.pivot_unique(df, ["k"], "c", ["x", "y"], "v")) == [("a", 1, 2), ("b", 3, None)]
    with pytest.raises(Exception, match="duplicate cell"):
        op.pivot_unique(df.union(df), ["k"], "c", ["x", "y"], "v").collect()


def test_pivot_mode_takes_smallest_on_tie(spark):
    df = spark.createDataFrame([("a", "x", "b"), ("a", "x", "a"), ("a", "x", None)], "k string, c string, l string")
    assert rows(op.pivot_mode(df, ["k"], "c", ["x"], "l")) == [("a", "a")]


def test_share_counts_null_groups_in_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(op.share_of_total(df, ["k"])) == [("a", 2, 50.0), ("b", 1, 25.0)]


def test_drop_matching_keeps_unknown(spark):
    df = spark.createDataFrame([("system",), ("op",), (None,)], "c string")
    assert rows(op.drop_matching(df, F.col("c") == "system")) == [(None,), ("op",)]


def test_active_sites_flags(frame):
    sites = frame("sites", [
        {"site_id": "1", "bank": "x", "bank_code": "B", "status": 1, "active": True, "site_name": "s"},
        {"site_id": "2", "bank": "x", "bank_code": "B", "status": 0, "active": True, "site_name": "s"},
        {"site_id": "3", "bank": "x", "bank_code": "C", "status": 1, "active": True, "site_name": "s"},
        {"site_id": "4", "bank": "x", "bank_code": "B", "status": 1, "active": False, "site_name": "s"},
        {"site_id": "5", "bank": "x", "bank_code": "B", "status": 1, "active": True, "site_name": "TEST BED"}])
    customers = frame("customers", [{"bank_code": "B", "bank": "Bank", "active": True},
                                    {"bank_code": "C", "bank": "Other", "active": False}])
    assert rows(op.active_sites(sites, customers, drop_test=True), "site_id", "bank") == [("1", "Bank")]
    assert rows(op.active_sites(sites, customers, require_status=False), "site_id") == [("1",), ("2",), ("5",)]


def test_last_non_null_with_ties(spark):
    data = [("a", 1, 1, "a"), ("a", 1, 2, "b"), ("a", 1, 0, "c")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, at int, i int, p string").coalesce(1)
        assert rows(op.last_non_null(df, ["k"], "at", ["p"])) == [("a", "c")]
        assert rows(op.last_non_null(df, ["k"], "at", ["p"], tie="i")) == [("a", "b")]


def test_natural_join_kinds(spark):
    left = spark.createDataFrame([(1, None, "l1"), (2, 5, "l2"), (None, None, "l3")], "a int, b int, x string")
    right = spark.createDataFrame([(1, None, "r1"), (1, None, "r2"), (3, None, "r3"), (None, None, "r4")],
                                  "a int, b int, y string")
    assert rows(op.natural_join(left, right), "x", "y") == [("l1", "r1"), ("l1", "r2"), ("l3", "r4")]
    assert rows(op.natural_join(left, right, "left"), "x", "y") == [
        ("l1", "r1"), ("l1", "r2"), ("l2", None), ("l3", "r4")]
    assert rows(op.natural_join(left, right, "outer")) == [
        (None, None, "l3", "r4"), (1, None, "l1", "r1"), (1, None, "l1", "r2"), (2, 5, "l2", None), (3, None, None, "r3")]


def slow_ranks(values):
    known = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    same = lambda x, y: x == y or (x != x and y != y)
    return [None if v is None else (
        sum(1 for w in known if not same(v, w) and ((v != v) or w < v)) + (sum(same(v, w) for w in known) + 1) / 2
    ) / len(known) for v in values]


def test_ranks_of_odd_and_clustered_values(spark):
    nan, inf = float("nan"), float("inf")
    values = [1.0, nan, None, inf, -inf, 1.0, nan, 0.0, -0.0, 3.5, None] + [1.7e9 + i for i in range(300)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    wanted = slow_ranks(values)
    for key in (None, "i"):
        got = [r["p"] for r in op.pct_ranks(df, {"v": "p"}, None, key=key).orderBy("i").collect()]
        assert all(a == b or abs(a - b) < 1e-12 for a, b in zip(got, wanted))
    only_nan = spark.createDataFrame([(nan,), (nan,)], "v double")
    assert rows(op.pct_rank(only_nan, "v", "p"), "p") == [(0.75,), (0.75,)]


def test_clustered_values_fall_into_many_ranges(spark):
    from sitepulse.operators import ranking

    seconds = spark.range(200_000).select((F.col("id") + 1_700_000_000).cast("double").alias("_v"))
    bounds = seconds.agg(F.percentile_approx("_v", F.array(*[
        F.lit(i / ranking.RANGES) for i in range(1, ranking.RANGES)]), F.lit(4 * ranking.RANGES)).alias("_bounds"))
    sizes = ranking._in_ranges(seconds.crossJoin(F.broadcast(bounds))).groupBy("_range").count()
    found = [r["count"] for r in sizes.collect()]
    assert len(found) == ranking.RANGES and max(found) < 2 * 200_000 / ranking.RANGES


def test_quantiles(spark):
    df = spark.createDataFrame([(float(v), w) for v, w in ((1, None), (2, 5.0), (4, None), (8, 7.0))], "a double, b double")
    got = rows(op.quantiles(df, ["a", "b"], {"q25": 0.25, "median": 0.5, "q75": 0.75}))
    assert got == [("a", 1.75, 3.0, 5.0), ("b", 5.5, 6.0, 6.5)]


def test_kept_histogram_ranks_like_all_rows(spark, tmp_path):
    """Days merged one by one, with ties, NULL, NaN, infinities, and a value that only a later day has."""
    rng = random.Random(4)
    pool = [None, float("nan"), float("inf"), -float("inf"), 0.0, -1.5, 2.0, 2.0, 1e9]
    values = [(i, i % 4, rng.choice([*pool, rng.gauss(0, 3)]), rng.choice([1.0, None, 7.5]))
              for i in range(600)] + [(1000, 3, 123.25, None)]
    df = spark.createDataFrame(values, "i int, day int, v double, w double")
    kept = None
    for day in range(4):
        kept = op.rank_histogram(df.filter(F.col("day") == day), ["v", "w"], kept)
        kept.write.parquet(str(tmp_path / str(day)))
        kept = spark.read.parquet(str(tmp_path / str(day)))
    got = op.ranks_from(df, kept, {"v": "rv", "w": "rw"}, digits=None)
    whole = op.pct_ranks(df, {"v": "rv", "w": "rw"}, digits=None)
    assert rows(got, "i", "rv", "rw") == rows(whole, "i", "rv", "rw")
    assert kept.count() == op.rank_histogram(df, ["v", "w"]).count()


def test_few_values_rank_like_many(spark):
    df = spark.range(5000).select(F.col("id").alias("i"), F.when(F.col("id") % 13 > 0, F.col("id") % 13).alias("v"))
    assert rows(op.pct_ranks(df, {"v": "r"}, few=True)) == rows(op.pct_ranks(df, {"v": "r"}))
