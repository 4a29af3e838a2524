"""Joins with the NULL and duplicate rules of the reports.

No broadcast hints: dimension sizes are not known here, so the choice stays with Spark, which
checks the size against ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed keys otherwise.
The probe side of a semi or anti join is reduced to distinct keys first, so repeated keys on it
never cost more than one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of customers and sites used for testing only.
TEST_TENANTS = ["Test", "TEST BED"]


def _distinct_keys(right: DataFrame, keys: Sequence[str],
                   right_keys: Sequence[str] | None) -> DataFrame:
    return right.select(*[F.col(r).alias(k) for k, r in zip(keys, right_keys or keys)]).distinct()


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, cond, how)


def null_safe_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join where NULL matches NULL; the right side has unique keys."""
    return _null_safe(left, right, keys, "left").drop(*[f"_r_{k}" for k in keys])


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str],
         right_keys: Sequence[str] | None = None) -> DataFrame:
    return left.join(_distinct_keys(right, keys, right_keys), list(keys), "left_semi")


def anti(left: DataFrame, right: DataFrame, keys: Sequence[str],
         right_keys: Sequence[str] | None = None) -> DataFrame:
    return left.join(_distinct_keys(right, keys, right_keys), list(keys), "left_anti")


def null_safe_semi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _null_safe(left, _distinct_keys(right, keys, None), keys, "left_semi")


def null_safe_anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without an equal key on the right, NULL being equal to NULL."""
    return _null_safe(left, _distinct_keys(right, keys, None), keys, "left_anti")


def without_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Null-safe anti join on all common columns."""
    shared = [c for c in left.columns if c in right.columns]
    return null_safe_anti(left, right, shared)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all common columns, NULL matching NULL; ``how``: inner, left or outer.

    Several right rows of a key pair with each left row. An outer join adds the right rows that
    no left row has, with NULL in the left columns.
    """
    if how not in ("inner", "left", "outer"):
        raise ValueError("natural_join supports inner, left and outer")
    shared = [c for c in left.columns if c in right.columns]
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in shared else F.col(c)
                           for c in right.columns], F.lit(True).alias("_right"))
    marked = left.withColumn("_left", F.lit(True))
    on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in shared])
    joined = marked.join(other, on, "full" if how == "outer" else how)
    keys = {c: F.when(F.col("_left"), F.col(c)).otherwise(F.col(f"_r_{c}")) for c in shared}
    return joined.withColumns(keys).drop("_left", "_right", *[f"_r_{c}" for c in shared])


def active_sites(sites: DataFrame, customers: DataFrame | None = None, *,
                 require_status: bool = True, drop_test: bool = False) -> DataFrame:
    """Sites in service of customers in service."""
    kept = sites.filter("active")
    if require_status:
        kept = kept.filter("status = 1")
    if customers is not None:
        live = customers.filter("active").select("bank_code", "bank").distinct()
        kept = kept.drop("bank").join(live, "bank_code")
    if drop_test:
        kept = kept.filter(~F.coalesce(F.col("bank").isin(TEST_TENANTS), F.lit(False))
                           & ~F.coalesce(F.col("site_name").isin(TEST_TENANTS), F.lit(False)))
    return kept


def densify(members: DataFrame, counts: DataFrame, keys: Sequence[str],
            measures: Sequence[str]) -> DataFrame:
    """Every member with its measures, zero where there is no fact."""
    joined = members.join(counts.select(*keys, *measures), list(keys), "left")
    return joined.fillna(0, subset=list(measures))


def flag_members(df: DataFrame, members: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """1 for rows whose key occurs in ``members``, else 0."""
    marked = _distinct_keys(members, keys, None).withColumn(flag, F.lit(1))
    return df.join(marked, list(keys), "left").fillna(0, subset=[flag])


def _stacked(sides: Sequence[tuple[DataFrame, str]], keys: Sequence[str]) -> DataFrame:
    """Sides one below the other, each measure in a column of its own."""
    parts = [df.select(*keys, F.col(name).cast("double").alias(f"_m{i}"), F.lit(i).alias("_side"))
             for i, (df, name) in enumerate(sides)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def outer_combine(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  measure: str) -> DataFrame:
    """Full outer combination: the left value, else the right one. Keys are summed per side."""
    both = _stacked([(left, measure), (right, measure)], keys)
    return both.groupBy(*keys).agg(
        F.coalesce(F.sum("_m0"), F.sum("_m1")).alias(measure))


def outer_join_sums(sides: Sequence[tuple[DataFrame, str]], keys: Sequence[str]) -> DataFrame:
    """Sums per key over the chain of full outer joins of all sides.

    A key met n times on one side repeats the rows of the others n times. The sum over those
    repeats is the side's own sum times the row counts of the other sides, so no pair is built.
    """
    names = [name for _, name in sides]
    grouped = _stacked(sides, keys).groupBy(*keys).agg(
        *[F.sum(f"_m{i}").alias(f"_s{i}") for i in range(len(sides))],
        *[F.greatest(F.count_if(F.col("_side") == i), F.lit(1)).alias(f"_n{i}")
          for i in range(len(sides))])
    out = []
    for i, name in enumerate(names):
        repeats = reduce(lambda a, b: a * b,
                         [F.col(f"_n{j}") for j in range(len(names)) if j != i], F.lit(1))
        out.append((F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) * repeats).alias(name))
    return grouped.select(*keys, *out)
