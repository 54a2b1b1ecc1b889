"""Measures of media and their history."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftspark.schemas import HISTORY


def quality_score(width: Column, height: Column, bandwidth: Column) -> Column:
    """4, 3, 2 for full, high and standard definition, 0 below, 1 if anything is unknown."""
    over = lambda w, h, b: (width >= w) & (height >= h) & (bandwidth >= b)
    return (
        F.when(width.isNull() | height.isNull() | bandwidth.isNull(), 1)
        .when(over(1920, 1080, 3_000_000), 4)
        .when(over(1280, 720, 1_500_000), 3)
        .when(over(640, 360, 500_000), 2)
        .otherwise(0)
    )


def last_items(items: Column, n: int = HISTORY) -> Column:
    """The last n elements, all of a shorter array."""
    return F.when(F.size(items) > 0, F.slice(items, -F.least(F.lit(n), F.size(items)), n)).otherwise(items)


def middle(items: Column) -> Column:
    """Median of an array as a double; null for an empty one."""
    ordered, n = F.array_sort(items), F.size(items)
    half = F.floor(n / 2).cast("int")
    upper = F.get(ordered, half).cast("double")
    return F.when(n > 0, F.when(n % 2 == 1, upper).otherwise((F.get(ordered, half - 1).cast("double") + upper) / 2))


def valid_history(items: Column) -> Column:
    return F.filter(F.coalesce(items, F.array().cast("array<int>")), lambda x: x.isNotNull() & (x >= 0))


def next_history(previous: Column, current: Column, successful: Column) -> Column:
    """The last successful latencies after this run."""
    kept = valid_history(previous)
    return last_items(F.when(successful & (current >= 0), F.concat(kept, F.array(current))).otherwise(kept))


def response_rank(history: Column, current: Column) -> Column:
    """Median of the history, else the current latency, else infinity."""
    kept = last_items(valid_history(history))
    return F.coalesce(middle(kept), F.when(current >= 0, current.cast("double")), F.lit(float("inf")))


def next_streak(technical: Column, successes: Column, failures: Column, last_success: Column, checked_at: Column) -> Column:
    """Struct of streaks and last success after this run; anything but healthy breaks a run of successes."""
    ok = technical.eqNullSafe("healthy")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return F.struct(
        F.when(ok, zero(successes) + 1).otherwise(0).alias("consecutive_successes"),
        F.when(ok, 0).otherwise(zero(failures) + 1).alias("consecutive_failures"),
        F.when(ok, checked_at).otherwise(F.nullif(last_success, F.lit(""))).alias("last_success_at"),
    )
