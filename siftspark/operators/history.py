"""State carried from run to run: streaks, rolling latencies, missing children, restored parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark.functions.media import middle, next_history, next_streak
from siftspark.schemas import HISTORY


def step(observed: DataFrame, previous: DataFrame, key: str = "entity_id", checked_at: str = "checked_at") -> DataFrame:
    """One run's observations joined with the state before it; an entity without state starts anew."""
    old = previous.select(key, *[F.col(c).alias(f"_{c}") for c in ("consecutive_successes", "consecutive_failures", "last_success_at", "response_ms_history")])
    joined = observed.join(old, key, "left")
    streak = next_streak(F.col("technical_status"), F.col("_consecutive_successes"), F.col("_consecutive_failures"), F.col("_last_success_at"), F.col(checked_at))
    kept = next_history(F.col("_response_ms_history"), F.col("response_ms"), F.col("technical_status") == "healthy")
    return joined.withColumn("_s", streak).select(*observed.columns, "_s.*", kept.alias("response_ms_history"))


def replay_streaks(df: DataFrame, entity: list[str], order: list[str], ok: Column, at: str) -> DataFrame:
    """Streaks and last success after every row of a whole history, as repeated steps would give them."""
    by = Window.partitionBy(*entity).orderBy(*order)
    ok = F.coalesce(ok, F.lit(False))
    flagged = df.withColumn("_ok", ok)
    flagged = flagged.withColumn("_breaks", F.sum(F.when(F.col("_ok"), 0).otherwise(1)).over(by)).withColumn("_wins", F.sum(F.when(F.col("_ok"), 1).otherwise(0)).over(by))
    last = F.max(F.when(F.col("_ok"), F.col(at))).over(by)
    runs = flagged.withColumn("_since_break", F.row_number().over(Window.partitionBy(*entity, "_breaks", "_ok").orderBy(*order)))
    fails = F.row_number().over(Window.partitionBy(*entity, "_wins", "_ok").orderBy(*order))
    return (
        runs.withColumn("consecutive_successes", F.when(F.col("_ok"), F.col("_since_break")).otherwise(0).cast("long"))
        .withColumn("consecutive_failures", F.when(F.col("_ok"), 0).otherwise(fails).cast("long"))
        .withColumn("last_success_at", last)
        .drop("_ok", "_breaks", "_wins", "_since_break")
    )


def rolling_median(df: DataFrame, entity: list[str], order: list[str], value: str, n: int = HISTORY) -> DataFrame:
    """Median of the last n values after every row."""
    by = Window.partitionBy(*entity).orderBy(*order).rowsBetween(1 - n, 0)
    return df.withColumn("rolling_median", middle(F.collect_list(value).over(by)))


def missing_children(previous: DataFrame, current: DataFrame, key: list[str]) -> DataFrame:
    return previous.join(current.select(*key).distinct(), key, "left_anti")


def carried_over(previous: DataFrame, current: DataFrame, sources: DataFrame) -> DataFrame:
    """Items that vanished while their source is still registered: dead if the source reads well or is dead itself."""
    gone = missing_children(previous, current, ["entity_id"]).join(sources.select("source_id", F.col("technical_status").alias("_source")), "source_id")
    return gone.select(
        "entity_id", "source_id",
        F.when(F.col("_source").isNull() | (F.col("_source") == "dead"), "dead").otherwise("suspect").alias("technical_status"),
        F.when(F.col("_source").isNull(), "missing_upstream").otherwise("blocked_by_source").alias("failure_reason"),
        F.lit(0).alias("consecutive_successes"), (F.coalesce("consecutive_failures", F.lit(0)) + 1).alias("consecutive_failures"), "last_success_at",
    )
