"""Queries of whole payloads: configurations, catalogues, probed playlists, terms, and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftspark.functions import headers
from siftspark.operators import config
from siftspark.plans.registry import query
from siftspark.plans.tables import OBSERVATIONS, observations
from siftspark.session import table


def _configs(spark, sf_dir):
    """One configuration a brand, with its parts as sites; sizes stand for types, so that some are illegal."""
    site = F.struct(F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("name"), (F.col("p_size") % 6).alias("type"), F.concat(F.lit("/api/"), F.col("p_partkey").cast("string")).alias("api"))
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", site.alias("s")))).alias("x"))
    content = F.to_json(F.struct(F.transform("x", lambda e: e["s"]).alias("sites")))
    return rows.select(F.col("p_brand").alias("source_id"), content.alias("content"), F.lit("https://h.example.test/c.json").alias("base_url"))


@query(
    "config_entries",
    """SELECT p_brand AS source_id, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INTEGER) AS ordinal, CAST(p_partkey AS VARCHAR) AS key, 'https://h.example.test/api/' || p_partkey AS url,
CASE WHEN p_size % 6 NOT IN (0, 1, 3, 4) THEN 'schema_incompatible' END AS issue FROM part""",
)
def config_entries(spark, sf_dir):
    return config.read(_configs(spark, sf_dir)).select("source_id", "ordinal", "key", "url", "issue")


@query(
    "catalogue_outcomes",
    """SELECT p_brand AS source_id, count(*) AS candidates, count(*) FILTER (p_size % 6 = 3) AS spiders, CASE WHEN count(*) > 80 THEN 'catalog_limit_exceeded' ELSE 'ok' END AS outcome FROM part GROUP BY p_brand""",
)
def catalogue_outcomes(spark, sf_dir):
    entries = config.read(_configs(spark, sf_dir)).withColumn("path", F.lit("c.json"))
    found = config.within_limits(config.catalogue_candidates(entries), 80)
    return found.groupBy("source_id").agg(F.count("*").alias("candidates"), F.count_if(F.col("failure_reason").eqNullSafe("unsupported_spider")).alias("spiders"), F.max("outcome").alias("_o"), F.min("outcome").alias("outcome")).drop("_o")


@query(
    "header_issues",
    """SELECT conv_id, turn, CASE WHEN role = 'user' AND turn % 4 = 0 THEN 'credential_header_rejected' WHEN turn % 4 = 1 AND role = 'assistant' THEN 'invalid_header_syntax' END AS issue FROM conversations""",
)
def header_issues(spark, sf_dir):
    name = F.when((F.col("role") == "user") & (F.col("turn") % 4 == 0), "Cookie").otherwise("Accept")
    value = F.when((F.col("role") == "assistant") & (F.col("turn") % 4 == 1), "a\nb").otherwise("text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", headers.issue(F.create_map(name, value)).alias("issue"))


@query(
    "terms_changed",
    """WITH d AS (SELECT doc_id, source, sha256(text) AS now, sha256(CASE WHEN doc_id % 40 = 11 THEN text || '.' ELSE text END) AS reviewed FROM documents)
SELECT source, lang, bool_or(now <> reviewed) AS changed FROM d JOIN documents USING (doc_id, source) GROUP BY source, lang""",
)
def terms_changed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    reviewed = F.sha2(F.when(F.col("doc_id") % 40 == 11, F.concat("text", F.lit("."))).otherwise(F.col("text")), 256)
    return docs.groupBy("source", "lang").agg(F.bool_or(F.sha2("text", 256) != reviewed).alias("changed"))


@query(
    "single_step_history",
    f"""WITH {OBSERVATIONS}, last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY ts DESC, event_id DESC) AS rn FROM obs) WHERE rn = 1)
SELECT entity_id, CAST(CASE WHEN technical_status = 'healthy' THEN entity_id % 5 + 1 ELSE 0 END AS INTEGER) AS consecutive_successes, CAST(CASE WHEN technical_status = 'healthy' THEN 0 ELSE entity_id % 3 + 1 END AS INTEGER) AS consecutive_failures,
CASE WHEN technical_status = 'healthy' THEN 'now' WHEN entity_id % 2 = 0 THEN 'before' END AS last_success_at FROM last""",
)
def single_step_history(spark, sf_dir):
    from siftspark.operators.history import step
    from siftspark.operators.select import best_per_group

    obs = observations(spark, sf_dir)
    last = best_per_group(obs, ["entity_id"], [F.desc("ts"), F.desc("event_id")]).select("entity_id", "technical_status", F.col("latency").cast("int").alias("response_ms"), F.lit("now").alias("checked_at"))
    before = obs.select("entity_id").distinct().select(
        "entity_id", (F.col("entity_id") % 5).cast("int").alias("consecutive_successes"), (F.col("entity_id") % 3).cast("int").alias("consecutive_failures"),
        F.when(F.col("entity_id") % 2 == 0, "before").alias("last_success_at"), F.array(F.lit(1), F.lit(2)).alias("response_ms_history"),
    )
    return step(last, before).select("entity_id", "consecutive_successes", "consecutive_failures", "last_success_at")


@query("ext_approx_entities")
def ext_approx_entities(spark, sf_dir):
    """Not of the reference: distinct entities a day, by sketch."""
    return observations(spark, sf_dir).groupBy("day").agg(F.approx_count_distinct("entity_id", 0.02).alias("entities"))
