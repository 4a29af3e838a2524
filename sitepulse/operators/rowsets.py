"""Unions, complements, exclusive classes and column housekeeping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.functions.labels import first_match
from sitepulse.operators.joins import null_safe_anti


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts by column name; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def drop_matching(df: DataFrame, cond: Column) -> DataFrame:
    """Complement of a filter: rows where the condition is false or unknown."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` (duplicates kept) that do not occur in ``right``, NULL equal to NULL."""
    return null_safe_anti(left, right, left.columns)


def exclusive_classes(df: DataFrame, name: str, classes: Sequence[tuple[str, Column, Column]],
                      measure: str) -> DataFrame:
    """Puts each row into the first class whose test holds and takes that class's measure.

    ``classes`` holds (label, test, measure); rows that fit none are dropped.
    """
    label = first_match([(test, text) for text, test, _ in classes])
    value = first_match([(test, amount) for _, test, amount in classes])
    return df.withColumns({name: label, measure: value}).filter(F.col(name).isNotNull())


def ensure_columns(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Adds the named columns that are missing."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def move_first(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names, *[c for c in df.columns if c not in names])


def top_rows(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of a ranked report."""
    return df.orderBy(*order).limit(limit)
