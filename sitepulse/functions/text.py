"""Text clean-up with the NULL behaviour spelled out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(value: Column) -> Column:
    """Trimmed, first letter of each blank-separated word upper."""
    return F.initcap(F.lower(F.trim(value)))


def drop_blanks(value: Column) -> Column:
    return F.replace(value, F.lit(" "), F.lit(""))


def contains(value: Column, part: str) -> Column:
    """Case-insensitive; NULL text does not contain anything."""
    return F.coalesce(F.lower(value).contains(part.lower()), F.lit(False))


def not_text(value: Column, *excluded: str, keep_null: bool) -> Column:
    """Case-insensitive exclusion. ``keep_null=False`` is the SQL ``!=``, ``True`` keeps NULL."""
    kept = ~F.lower(value).isin([text.lower() for text in excluded])
    return F.coalesce(kept, F.lit(keep_null))


def text_flag(value: Column) -> Column:
    """A flag that arrives as boolean, number or text."""
    text = F.lower(F.trim(value.cast("string")))
    return F.when(text.isin("true", "1"), F.lit(True)).when(text.isin("false", "0"), F.lit(False))
