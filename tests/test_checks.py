"""Every registered query against its SQL on the smallest sample, and its plan."""

import datetime
import decimal
import math
import re

import duckdb
import pytest

from sitepulse.bindings import table
from sitepulse.catalog import CHECKS, QUERIES
from tests.conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# Only these end in one task: their aggregates are already one row per map task.
ONE_ROW = {"distinct_rolling", "conditional_counts", "column_profile", "share_of_total", "time_slices",
           "site_features", "site_priority", "dashboard_counts", "dashboard_counts_two_banks",
           "dashboard_document", "portfolio_by_bank", "portfolio_by_state",
           "portfolio_by_state_city", "portfolio_by_customer_state"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def test_every_query_is_checked():
    assert set(QUERIES) == set(CHECKS)
    for name in QUERIES:
        assert not re.match(r"op\d*_", name) and "pipeline" not in name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    assert "SinglePartition" not in plan or name in ONE_ROW
    found = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted((tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    assert found == wanted


# These write something, run a stream, or look up a header row or a schema while they are built.
EAGER = {"scan_pushdown", "append_table", "replace_one_slice", "replace_whole_table", "customer_slice_replaced",
         "csv_sheets", "csv_table", "json_records", "customer_buckets_replaced", "day_parts_replaced",
         "ticket_buckets_changed", "outage_patterns_kept", "pct_rank_kept"}


def test_building_a_query_starts_no_job(spark):
    lazy = [n for n in sorted(QUERIES) if n not in EAGER and not n.startswith("stream_")]
    for name in TABLES:  # schemas are looked up once per application
        table(spark, SF, name)
    context = spark.sparkContext
    context.setJobGroup("building", "building queries")
    for name in lazy:
        QUERIES[name](spark, SF)
        assert not context.statusTracker().getJobIdsForGroup("building"), name
    context.setLocalProperty("spark.jobGroup.id", None)


def test_site_features_shuffles(spark):
    df = QUERIES["site_features"](spark, SF)
    df.collect()
    *ran, _ = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")
    # A line of a reused shuffle names the shuffle again.
    shuffles = [sum("Exchange hashpartitioning" in line and "ReusedExchange" not in line
                    for line in plan.split("\n")) for plan in ran]
    assert 0 < max(shuffles) <= 15, shuffles
