"""Grouped reports. Categories are passed in, so schemas are fixed and one shuffle is enough."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitepulse.operators.ranking import quantiles


def crosstab_counts(df: DataFrame, rows: Sequence[str], column: str,
                    values: Mapping[Any, str] | Sequence[Any]) -> DataFrame:
    """Row counts per category, one column each, absent categories zero."""
    names = values if isinstance(values, Mapping) else {v: str(v) for v in values}
    return df.groupBy(*rows).agg(*[
        F.count_if(F.col(column) == F.lit(value)).alias(name) for value, name in names.items()
    ])


def pivot_agg(df: DataFrame, rows: Sequence[str], column: str,
              values: Mapping[Any, str] | Sequence[Any], value: str,
              agg: Callable[[Column], Column]) -> DataFrame:
    """Any one-column aggregate per category; empty cells stay NULL."""
    names = values if isinstance(values, Mapping) else {v: str(v) for v in values}
    return df.groupBy(*rows).agg(*[
        agg(F.when(F.col(column) == F.lit(v), F.col(value))).alias(name)
        for v, name in names.items()
    ])


def pivot_mode(df: DataFrame, rows: Sequence[str], column: str,
               values: Mapping[Any, str] | Sequence[Any], label: str) -> DataFrame:
    """Most frequent label per category, the smallest one on a tie."""
    return pivot_agg(df, rows, column, values, label, lambda c: F.mode(c, True))


def pivot_unique(df: DataFrame, rows: Sequence[str], column: str,
                 values: Sequence[Any], value: str) -> DataFrame:
    """Reshape without aggregation: a second value for one cell is an error."""
    cell = df.filter(F.col(column).isin(list(values))).groupBy(*rows, column).agg(
        F.min(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    checked = cell.withColumn("_v", F.when(F.col("_n") > 1, F.raise_error(
        F.concat(F.lit("duplicate cell for "), F.col(column).cast("string"))).cast(dict(df.dtypes)[value]))
        .otherwise(F.col("_v")))
    return pivot_agg(checked, rows, column, values, "_v", F.max)


def pivot_text(df: DataFrame, rows: Sequence[str], column: str, values: Mapping[Any, str],
               label: str, labels: Sequence[str]) -> DataFrame:
    """Labels of one cell joined by blanks, in the order of ``labels``.

    Labels are counted before they are written out, so a cell is never collected row by row.
    """
    counted = df.groupBy(*rows, column).agg(*[
        F.count_if(F.col(label) == F.lit(text)).cast("int").alias(f"_n{i}")
        for i, text in enumerate(labels)
    ])
    cell = F.rtrim(F.concat(*[
        F.repeat(F.lit(f"{text} "), F.col(f"_n{i}")) for i, text in enumerate(labels)]))
    texts = counted.select(*rows, column, F.when(cell != "", cell).alias("_text"))
    return pivot_agg(texts, rows, column, values, "_text", F.max)


def horizon_counts(df: DataFrame, keys: Sequence[str], since: Mapping[str, Column],
                   at_least: Mapping[str, int]) -> DataFrame:
    """Rows per key inside several look-backs, kept where every threshold is met."""
    counted = df.groupBy(*keys).agg(*[
        F.count_if(cond).alias(name) for name, cond in since.items()])
    for name, minimum in at_least.items():
        counted = counted.filter(F.col(name) >= minimum)
    return counted


def conditional_counts(df: DataFrame, tests: Mapping[str, Column],
                       by: Sequence[str] = ()) -> DataFrame:
    """Several filtered counts in one pass, one row or one row per group."""
    return df.groupBy(*by).agg(*[F.count_if(cond).alias(name) for name, cond in tests.items()])


def summed_measures(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                    total: str | None = None) -> DataFrame:
    out = df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    if total is None:
        return out
    cells = [F.coalesce(F.col(m), F.lit(0)) for m in measures]
    return out.withColumn(total, sum(cells[1:], cells[0]))


def two_level_sums(df: DataFrame, outer: Sequence[str], inner: Sequence[str],
                   measures: Sequence[str]) -> DataFrame:
    """The same sums per outer group and per outer+inner group; ``level`` tells them apart."""
    fine = df.groupBy(*outer, *inner).agg(*[F.sum(m).alias(m) for m in measures])
    return fine.groupingSets(
        [[F.col(c) for c in outer], [F.col(c) for c in [*outer, *inner]]],
        *[F.col(c) for c in [*outer, *inner]],
    ).agg(F.when(F.grouping(inner[0]) == 1, F.lit("group")).otherwise(F.lit("member"))
          .alias("level"), *[F.sum(m).alias(m) for m in measures])


def share_of_total(df: DataFrame, keys: Sequence[str], *, count: str = "count",
                   share: str = "percentage", scale: float = 100.0,
                   digits: int = 2) -> DataFrame:
    """Rows per group and their share of all rows, NULL keys counting toward the total only."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counted.dropna(subset=list(keys)).select(
        *keys, count, F.round(F.col(count) * scale / total, digits).alias(share))


def frequency(df: DataFrame, column: str) -> DataFrame:
    return (df.dropna(subset=[column]).groupBy(column)
            .agg(F.count(F.lit(1)).alias("count")))


def slope(df: DataFrame, keys: Sequence[str], y: str, x: str, name: str = "slope") -> DataFrame:
    """Least-squares slope of y over x per group."""
    return df.groupBy(*keys).agg(F.regr_slope(F.col(y), F.col(x)).alias(name))


def column_profile(df: DataFrame, numeric: Sequence[str], nullable: Sequence[str]) -> DataFrame:
    """One row per column: rows, nulls, mean, sample deviation, smallest, quartiles, largest."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for name in dict.fromkeys([*numeric, *nullable]):
        aggs.append(F.count_if(F.col(name).isNull()).alias(f"_null_{name}"))
    for name in numeric:
        value = F.col(name).cast("double")
        aggs += [F.avg(value).alias(f"_mean_{name}"), F.stddev(value).alias(f"_std_{name}"),
                 F.min(value).alias(f"_min_{name}"), F.max(value).alias(f"_max_{name}")]
    flat = df.agg(*aggs)
    nothing = F.lit(None).cast("double")
    lines = []
    for name in dict.fromkeys([*numeric, *nullable]):
        stats = [F.col(f"_{s}_{name}") if name in numeric else nothing
                 for s in ("mean", "std", "min", "max")]
        lines.append(F.struct(
            F.lit(name).alias("column"), F.col("_rows").alias("rows"),
            F.col(f"_null_{name}").alias("nulls"), stats[0].alias("mean"),
            stats[1].alias("std"), stats[2].alias("smallest"), stats[3].alias("largest")))
    profile = flat.select(F.inline(F.array(*lines)))
    shares = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    if not numeric:
        return profile.withColumns({name: nothing for name in shares})
    return profile.join(quantiles(df, list(numeric), shares), "column", "left")
