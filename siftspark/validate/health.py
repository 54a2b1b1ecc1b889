"""Rules that published health tables must keep, derived apart from what produced them: none broken means no row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TECHNICAL = ["healthy", "partial", "suspect", "unknown", "unsupported_environment", "dead"]


def _rows(df: DataFrame, rule: str, key: str, detail="") -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"))


def violations(items: DataFrame, channels: DataFrame, sources: DataFrame) -> DataFrame:
    """(rule, key, detail) of every rule that is broken."""
    out = _rows(items.groupBy("entity_id").count().where("count > 1"), "repeated_entity", "entity_id")
    out = out.unionByName(_rows(items.join(sources, "source_id", "left_anti"), "unknown_source", "entity_id"))
    streak = ((F.col("technical_status") == "healthy") & ((F.col("consecutive_failures") > 0) | (F.col("consecutive_successes") < 1))) | ((F.col("technical_status") != "healthy") & (F.col("consecutive_successes") > 0))
    out = out.unionByName(_rows(items.where(streak), "bad_streak", "entity_id"))
    barred = items.join(sources.select("source_id", F.col("rights_status").alias("_r")), "source_id").where("_r in ('restricted', 'takedown', 'unknown') and publication_status in ('stable', 'experimental')")
    out = out.unionByName(_rows(barred, "rights_barred", "entity_id", F.col("_r")))
    own = items.where("channel_id is not null").groupBy("channel_id").agg(F.array_sort(F.collect_set("entity_id")).alias("_ids"), *[F.bool_or(F.col("technical_status") == s).alias(f"_{i}") for i, s in enumerate(_TECHNICAL)])
    status = F.coalesce(*[F.when(F.col(f"_{i}"), s) for i, s in enumerate(_TECHNICAL)])
    both = channels.join(own.withColumn("_status", status), "channel_id", "full_outer")
    out = out.unionByName(_rows(both.where(~F.col("candidate_url_ids").eqNullSafe(F.col("_ids"))), "channel_candidates", "channel_id"))
    out = out.unionByName(_rows(both.where(~F.col("technical_status").eqNullSafe(F.col("_status"))), "channel_status", "channel_id", F.col("_status")))
    won = channels.where("selected_url_id is not null").join(items.select(F.col("entity_id").alias("selected_url_id"), F.col("technical_status").alias("_t"), F.col("publication_status").alias("_p")), "selected_url_id", "left")
    return out.unionByName(_rows(won.where("not (_t <=> 'healthy' and _p <=> 'stable')"), "bad_winner", "channel_id"))
