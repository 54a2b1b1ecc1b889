"""The driver's tables read as the engine's records: what stands in for what."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.session import table

STATUS = {"purchase": "healthy", "click": "partial", "signup": "suspect", "view": "unknown", "error": "dead"}
REASON = {"error": "http_404", "view": "fetch_timeout", "signup": "rate_limited", "click": "media_probe_failed"}


def _case(column: str, values: dict[str, str]):
    out = None
    for k, v in values.items():
        out = F.when(F.col(column) == k, v) if out is None else out.when(F.col(column) == k, v)
    return out


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as probe observations."""
    return observed(table(spark, sf_dir, "events"))


def observed(events: DataFrame) -> DataFrame:
    """Rows of events, of a table or a stream, as probe observations."""
    return events.select(
        "event_id", "ts", F.to_date("ts").alias("day"), F.col("user_id").alias("entity_id"),
        _case("event_type", STATUS).alias("technical_status"), _case("event_type", REASON).alias("failure_reason"),
        F.floor(F.coalesce("value", F.lit(0.0))).cast("long").alias("latency"),
        F.get_json_object("props", "$.k").cast("int").alias("score"),
    )


#: The same in SQL.
OBSERVATIONS = """
obs AS (SELECT event_id, ts, CAST(ts AS DATE) AS day, user_id AS entity_id,
  CASE event_type WHEN 'purchase' THEN 'healthy' WHEN 'click' THEN 'partial' WHEN 'signup' THEN 'suspect' WHEN 'view' THEN 'unknown' WHEN 'error' THEN 'dead' END AS technical_status,
  CASE event_type WHEN 'error' THEN 'http_404' WHEN 'view' THEN 'fetch_timeout' WHEN 'signup' THEN 'rate_limited' WHEN 'click' THEN 'media_probe_failed' END AS failure_reason,
  CAST(floor(coalesce(value, 0.0)) AS BIGINT) AS latency, CAST(json_extract_string(props, '$.k') AS INTEGER) AS score
  FROM events)"""

#: Ranks of statuses in SQL, over a column that is put in by format().
TECH = "CASE {0} WHEN 'healthy' THEN 0 WHEN 'partial' THEN 1 WHEN 'suspect' THEN 2 WHEN 'unknown' THEN 3 WHEN 'unsupported_environment' THEN 4 WHEN 'dead' THEN 5 END"
TECH_NAMES = "['healthy','partial','suspect','unknown','unsupported_environment','dead']"
