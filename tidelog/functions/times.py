"""Change timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}(:\d{2})?)$"


def change_time(text: Column) -> tuple[Column, Column]:
    """(timestamp, is an error). Missing, empty and "null" are no time; all else needs a date, a time and an offset."""
    none = text.isNull() | text.isin("", "null")
    # T goes with a full offset only
    shaped = text.rlike(_SHAPE) & ~text.rlike(r"T.*[+-]\d{2}$")
    time = F.when(shaped, F.try_to_timestamp(F.regexp_replace(text, r"([+-]\d{2})$", "$1:00")))
    return F.when(~none, time), ~none & time.isNull()
