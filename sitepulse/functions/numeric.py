"""Numbers with explicit NULL rules, and statistics across the columns of one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL (``greatest`` alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def percent(part: Column, whole: Column | float, digits: int = 2) -> Column:
    whole = whole if isinstance(whole, Column) else F.lit(whole)
    return F.round(F.try_divide(part * 100.0, whole), digits)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part, whole), digits)


def cube_root(*factors: Column) -> Column:
    product = factors[0].cast("double")
    for factor in factors[1:]:
        product = product * factor
    return F.cbrt(product)


def number_or_zero(text: Column) -> Column:
    """Amounts typed by hand: placeholders such as ``-`` or ``NA`` count as zero."""
    return F.coalesce(F.trim(text).try_cast("double"), F.lit(0.0))


def _present(columns: Sequence[str]) -> Column:
    return F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda v: v.isNotNull())


def row_sum(columns: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for name in columns:
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return total


def row_null_count(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for name in columns:
        total = total + F.col(name).isNull().cast("int")
    return total


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of the non-null values, NULL when there are none."""
    present = F.lit(len(columns)) - row_null_count(columns)
    return F.try_divide(row_sum(columns), present.cast("double"))


def row_min(columns: Sequence[str]) -> Column:
    return F.array_min(_present(columns))


def row_max(columns: Sequence[str]) -> Column:
    return F.array_max(_present(columns))


def row_range(columns: Sequence[str]) -> Column:
    return row_max(columns) - row_min(columns)


def row_std(columns: Sequence[str]) -> Column:
    """Population standard deviation of the non-null values."""
    mean = row_mean(columns)
    present = (F.lit(len(columns)) - row_null_count(columns)).cast("double")
    squares = F.lit(0.0)
    for name in columns:
        gap = F.col(name).cast("double") - mean
        squares = squares + F.coalesce(gap * gap, F.lit(0.0))
    return F.sqrt(F.try_divide(squares, present))


def row_slope(columns: Sequence[str]) -> Column:
    """Least-squares slope over the column positions 1..n, for rows without NULL."""
    centre = (len(columns) + 1) / 2
    spread = sum((pos - centre) ** 2 for pos in range(1, len(columns) + 1))
    rise = F.lit(0.0)
    for pos, name in enumerate(columns, 1):
        rise = rise + F.col(name).cast("double") * F.lit(pos - centre)
    return rise / F.lit(spread)


def row_argmin(columns: Sequence[str]) -> Column:
    """Name of the smallest non-null column; the first one wins a tie."""
    entries = [
        F.when(F.col(name).isNotNull(), F.struct(
            F.col(name).cast("double").alias("v"), F.lit(pos).alias("pos"),
            F.lit(name).alias("name")))
        for pos, name in enumerate(columns)
    ]
    return F.array_min(F.array_compact(F.array(*entries)))["name"]
