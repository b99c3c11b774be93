"""Small helpers for building columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def recode(value: Column | str, table: Mapping[str, object], default: object) -> Column:
    """Look a value up in a short fixed table; anything else, NULL too, gets ``default``."""
    value = as_column(value)
    result = None
    for key, label in table.items():
        test = value == F.lit(key)
        result = F.when(test, F.lit(label)) if result is None else result.when(test, F.lit(label))
    return result.otherwise(F.lit(default))


def is_filled(value: Column | str) -> Column:
    """Neither NULL nor an empty string."""
    value = as_column(value)
    return value.isNotNull() & (value.cast("string") != "")


def share(part: Column, whole: Column, scale: int = 2) -> Column:
    """Percentage rounded half up; NULL when the whole is zero."""
    return F.round(F.lit(100) * part.cast("decimal(20,0)") / F.nullif(whole.cast("decimal(20,0)"), F.lit(0)), scale)
