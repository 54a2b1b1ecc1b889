"""The health tables of a run: items with what was carried over, sources and channels rolled up from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.functions import policy
from siftspark.operators.history import carried_over

ITEM = ["entity_id", "source_id", "entity_type", "channel_id", "technical_status", "publication_status", "rights_status", "consecutive_successes", "consecutive_failures", "last_success_at", "failure_reason"]


def items(current: DataFrame, previous: DataFrame, sources: DataFrame) -> DataFrame:
    """Current items and those that vanished while their source is registered, with the state that follows from why."""
    status = sources.select("source_id", "technical_status", "rights_status")
    gone = carried_over(previous, current, status).join(previous.select("entity_id", "entity_type", "channel_id"), "entity_id").join(status.select("source_id", "rights_status"), "source_id")
    published = policy.publication_for(F.col("rights_status"), F.col("technical_status"), F.when(F.col("entity_type") == "live_url", "live").otherwise("vod"), F.lit(None).cast("int"), F.lit(False), F.col("failure_reason"))
    return current.select(ITEM).unionByName(gone.withColumn("publication_status", published).select(ITEM))


def source_rollup(all_items: DataFrame) -> DataFrame:
    return all_items.groupBy("source_id").agg(
        policy.technical_rollup(F.col("technical_status")).alias("technical_status"),
        policy.publication_rollup(F.col("publication_status")).alias("publication_status"),
        policy.primary_reason(policy.ordered_reasons(F.col("failure_reason"))).alias("failure_reason"),
    )


def channels(all_items: DataFrame, winners: DataFrame) -> DataFrame:
    """Channels from all their items, those carried over too, with the winner and its rights if there is one."""
    live = all_items.where("channel_id is not null")
    rolled = live.groupBy("channel_id").agg(
        policy.technical_rollup(F.col("technical_status")).alias("technical_status"), policy.publication_rollup(F.col("publication_status")).alias("_p"),
        policy.rights_rollup(F.col("rights_status")).alias("_r"), F.array_sort(F.collect_set("entity_id")).alias("candidate_url_ids"),
    )
    won = winners.select("channel_id", F.col("entity_id").alias("selected_url_id"), F.col("rights_status").alias("_w"))
    joined = rolled.join(won, "channel_id", "left")
    return joined.select(
        "channel_id", "technical_status", F.when(F.col("selected_url_id").isNotNull(), "stable").otherwise(F.when(F.col("_p") == "stable", "withheld").otherwise(F.col("_p"))).alias("publication_status"),
        F.coalesce("_w", "_r").alias("rights_status"), "selected_url_id", "candidate_url_ids",
    )
