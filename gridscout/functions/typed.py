"""Text to numbers, without failing on bad text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no number".
NO_NUMBER = ["", "None"]


def to_int(value: Column) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(0))


def to_double(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def is_bad(value: Column, type_name: str) -> Column:
    """True for text that is neither a number of the type nor a mark for "no number"."""
    return F.coalesce(~value.isin(NO_NUMBER) & value.try_cast(type_name).isNull(), F.lit(False))
