"""Bucketing and first-match labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(value: Column, edges: Sequence[float], labels: Sequence[Any]) -> Column:
    """Right-closed buckets: ``labels[i]`` for ``edges[i] < value <= edges[i+1]``, else NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("cut needs one more edge than labels")
    chain = F.when(value <= edges[0], F.lit(None))
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(value <= upper, F.lit(label))
    return chain


def first_match(rules: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Label of the first rule that holds."""
    (cond, label), *rest = rules
    chain = F.when(cond, F.lit(label) if not isinstance(label, Column) else label)
    for cond, label in rest:
        chain = chain.when(cond, F.lit(label) if not isinstance(label, Column) else label)
    return chain if default is None else chain.otherwise(F.lit(default))


def recode(value: Column, mapping: Mapping[Any, Any], *, keep_unmapped: bool = True) -> Column:
    """Replace listed values; the others stay, or become NULL."""
    chain = first_match([(value == F.lit(old), new) for old, new in mapping.items()])
    return chain.otherwise(value) if keep_unmapped else chain
