"""Observations as a stream: the batch step applied to each micro-batch, and windowed counts with late data bounded."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftspark.operators.history import step
from siftspark.operators.select import best_per_group

STATE = "entity_id string, consecutive_successes int, consecutive_failures int, last_success_at string, response_ms_history array<int>"


def follow(observations: DataFrame, state_dir: str, checkpoint: str) -> StreamingQuery:
    """Keeps the state table up with a stream of observations (entity_id, technical_status, response_ms, checked_at).

    Every micro-batch writes the state anew under its batch id, so that a batch run twice gives the same state.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(STATE).parquet(f"{state_dir}/{batch_id - 1}") if batch_id else spark.createDataFrame([], STATE)
        last = best_per_group(batch, ["entity_id"], [F.desc("checked_at"), F.desc("technical_status")])
        columns = [c.split()[0] for c in STATE.split(", ")]
        now = step(last, before).select(columns)
        before.join(now, "entity_id", "left_anti").select(columns).unionByName(now).write.mode("overwrite").parquet(f"{state_dir}/{batch_id}")

    return observations.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state(spark: SparkSession, state_dir: str) -> DataFrame:
    """The newest state."""
    newest = max(int(p.name) for p in Path(state_dir).iterdir() if p.name.isdigit())
    return spark.read.schema(STATE).parquet(f"{state_dir}/{newest}")


def status_counts(observations: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Observations by window and status; rows later than the watermark are left out."""
    return observations.withWatermark("ts", late).groupBy(F.window("ts", width), "technical_status").agg(F.count("*").alias("n"))
