"""Waiting times between attempts, in seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def engine_backoff(attempt: Column) -> Column:
    """1, 2, 4, 8, 8, ... for attempts 1, 2, 3, ..."""
    return F.least(F.pow(F.lit(2.0), F.greatest(attempt, F.lit(1)) - 1), F.lit(8.0))


def publisher_backoff(attempt: Column) -> Column:
    """2 ** min(attempt, 3)."""
    return F.pow(F.lit(2.0), F.least(attempt, F.lit(3)).cast("double"))


def reconnect_backoff(attempt: int, jitter: float = 0.0, cap: float = 30.0) -> float:
    """Doubling from one second to cap, with up to half as much again of jitter (0 to 1)."""
    return min(2.0 ** max(0, attempt), cap) * (1 + 0.5 * jitter)
