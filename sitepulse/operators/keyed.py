"""One row per key, and facts about a row's group.

A key may hold a large share of all rows, so nothing here sends a raw group to one task: the
``row_number() = 1`` form keeps one row per key and map task before the shuffle (Spark's window
group limit), the others are aggregates with a map-side part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitepulse.operators.joins import null_safe_left


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(name) for name in names]


def _pick(df: DataFrame, keys: Sequence[str], ordering: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*_cols(keys)).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole row with the greatest ``order`` columns; list a tie-breaker last."""
    return _pick(df, keys, [F.col(name).desc_nulls_last() for name in order])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole row with the smallest ``order`` columns, NULL last."""
    return _pick(df, keys, [F.col(name).asc_nulls_last() for name in order])


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per business key: any row, or the first one by ``order``."""
    return df.dropDuplicates(list(keys)) if order is None else first_per_key(df, keys, order)


def last_non_null(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], *,
                  tie: str | None = None) -> DataFrame:
    """Per key and column the last value that is not NULL.

    Rows with equal ``order`` are told apart by ``tie``, and then by the value itself, so the
    result does not depend on the order of the input.
    """
    place = [order] if tie is None else [order, tie]
    return df.groupBy(*keys).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull() & F.col(order).isNotNull(),
                                  F.struct(*place, c))).alias(c)
        for c in columns])


def latest_values(df: DataFrame, keys: Sequence[str], order: str,
                  when: dict[str, Column]) -> DataFrame:
    """Latest ``order`` value per key under each named condition, in one pass."""
    return df.groupBy(*keys).agg(*[
        F.max(F.when(cond, F.col(order))).alias(name) for name, cond in when.items()
    ])


def group_size(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of rows of the group on every row: counted with a map-side part, joined back."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return null_safe_left(df, counts, keys)


def peer_latest(df: DataFrame, group: Sequence[str], order: str, name: str) -> DataFrame:
    """Latest ``order`` value of the whole group on every row."""
    peers = df.groupBy(*group).agg(F.max(order).alias(name))
    return null_safe_left(df, peers, group)


def superseded(df: DataFrame, keys: Sequence[str], order: Sequence[str], row_id: str) -> DataFrame:
    """Rows that are not the latest of their key (NULL keys have no latest and are left out)."""
    keyed = df.dropna(subset=list(keys))
    newest = latest_per_key(keyed.select(*dict.fromkeys([*keys, *order, row_id])), keys, order)
    return keyed.join(newest.select(row_id), row_id, "left_anti")
