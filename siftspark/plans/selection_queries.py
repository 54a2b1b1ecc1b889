"""Queries of ranked selection, duplicates, roll-ups and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftspark import schemas as S
from siftspark.functions import ids, media, policy
from siftspark.operators import history, numbering, select
from siftspark.plans.registry import query
from siftspark.plans.tables import OBSERVATIONS, TECH, TECH_NAMES, observations
from siftspark.session import table

_Q = "CASE WHEN nullif(score % 7, 0) IS NULL THEN 1 WHEN score >= 70 THEN 4 WHEN score >= 40 THEN 3 WHEN score >= 20 THEN 2 ELSE 0 END"


def _quality():
    """Score as width, height and bandwidth of equal class; one in seven unknown."""
    known = F.when(F.col("score") % 7 != 0, F.col("score"))
    size = lambda a, b, c: F.when(known >= 70, a).when(known >= 40, b).when(known >= 20, c).when(known.isNotNull(), 1)
    return media.quality_score(size(1920, 1280, 640), size(1080, 720, 360), size(3_000_000, 1_500_000, 500_000))


@query(
    "best_observation_per_entity",
    f"""WITH {OBSERVATIONS}
SELECT entity_id, event_id, score, latency, quality FROM (
  SELECT *, {_Q} AS quality, row_number() OVER (PARTITION BY entity_id ORDER BY score DESC, latency, {_Q} DESC, event_id) AS rn
  FROM obs WHERE technical_status = 'healthy') WHERE rn = 1""",
)
def best_observation_per_entity(spark, sf_dir):
    df = observations(spark, sf_dir).where("technical_status = 'healthy'").withColumn("quality", _quality())
    order = [-F.col("score"), F.col("latency"), -F.col("quality"), F.col("event_id")]
    return select.best_by_struct(df, ["entity_id"], order, ["event_id", "score", "latency", "quality"]).select("entity_id", "event_id", "score", "latency", "quality")


@query(
    "dedup_flag_losers",
    f"""WITH {OBSERVATIONS}, p AS (SELECT *, technical_status = 'healthy' AS ok FROM obs)
SELECT event_id, CASE WHEN ok AND row_number() OVER (PARTITION BY ok, score ORDER BY latency, event_id) > 1 THEN 'withheld' WHEN ok THEN 'stable' ELSE 'withheld' END AS publication_status FROM p""",
)
def dedup_flag_losers(spark, sf_dir):
    df = observations(spark, sf_dir).withColumn("publication_status", F.when(F.col("technical_status") == "healthy", "stable").otherwise("withheld"))
    out = select.flag_losers(df, [F.col("score")], F.col("technical_status") == "healthy", [F.asc("latency"), F.asc("event_id")])
    return out.select("event_id", "publication_status")


@query(
    "dedup_two_stage",
    """WITH f AS (SELECT l_suppkey AS source_id, p_type AS type, p_size AS api, l_orderkey, l_linenumber, l_quantity, l_returnflag <> 'R' AS ok FROM lineitem JOIN part ON l_partkey = p_partkey),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, type, api ORDER BY ok DESC, l_quantity DESC, l_orderkey, l_linenumber) AS rn FROM f) WHERE rn = 1)
SELECT source_id, type, api, l_orderkey, l_linenumber,
  CASE WHEN ok AND row_number() OVER (PARTITION BY ok, type, api ORDER BY l_quantity DESC, source_id) > 1 THEN 'withheld' WHEN ok THEN 'stable' ELSE 'rejected' END AS publication_status FROM a""",
)
def dedup_two_stage(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.col("l_suppkey").alias("source_id"), (F.col("l_returnflag") != "R").alias("ok"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("type"), F.col("p_size").alias("api"))
    df = line.join(part, line["l_partkey"] == part["p_partkey"]).withColumn("publication_status", F.when(F.col("ok"), "stable").otherwise("rejected"))
    first = select.best_per_group(df, ["source_id", "type", "api"], [F.desc("ok"), F.desc("l_quantity"), F.asc("l_orderkey"), F.asc("l_linenumber")])
    out = select.flag_losers(first, [F.col("type"), F.col("api")], F.col("ok"), [F.desc("l_quantity"), F.asc("source_id")])
    return out.select("source_id", "type", "api", "l_orderkey", "l_linenumber", "publication_status")


@query(
    "client_dedup_first_wins",
    "SELECT p_type, p_size, min(p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name FROM part GROUP BY p_type, p_size",
)
def client_dedup_first_wins(spark, sf_dir):
    return select.best_by_struct(table(spark, sf_dir, "part"), ["p_type", "p_size"], [F.col("p_partkey")], ["p_partkey", "p_name"])


@query(
    "rank_key_components",
    f"""WITH {OBSERVATIONS}
SELECT entity_id, day, count(*) FILTER (technical_status = 'healthy') AS successes, max({_Q}) AS quality, CAST(coalesce(median(latency) FILTER (technical_status = 'healthy'), -1) * 2 AS BIGINT) AS double_median
FROM obs GROUP BY entity_id, day""",
)
def rank_key_components(spark, sf_dir):
    df = observations(spark, sf_dir).withColumn("quality", _quality())
    ok = F.col("technical_status") == "healthy"
    out = df.groupBy("entity_id", "day").agg(
        F.count_if(ok).alias("successes"), F.max("quality").alias("quality"), F.collect_list(F.when(ok, F.col("latency"))).alias("h")
    )
    return out.select("entity_id", "day", "successes", "quality", (F.coalesce(media.middle(F.col("h")), F.lit(-1.0)) * 2).cast("long").alias("double_median"))


@query(
    "rolling_last7_median",
    f"""WITH {OBSERVATIONS}
SELECT event_id, CAST(2 * median(latency) OVER (PARTITION BY entity_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS double_median FROM obs WHERE technical_status = 'healthy'""",
)
def rolling_last7_median(spark, sf_dir):
    df = observations(spark, sf_dir).where("technical_status = 'healthy'")
    return history.rolling_median(df, ["entity_id"], ["ts", "event_id"], "latency").select("event_id", (F.col("rolling_median") * 2).cast("long").alias("double_median"))


@query(
    "streaks_and_last_success",
    f"""WITH {OBSERVATIONS}, a AS (SELECT *, technical_status = 'healthy' AS ok, sum(CASE WHEN technical_status = 'healthy' THEN 0 ELSE 1 END) OVER w AS breaks,
  sum(CASE WHEN technical_status = 'healthy' THEN 1 ELSE 0 END) OVER w AS wins, max(CASE WHEN technical_status = 'healthy' THEN event_id END) OVER w AS last_success
  FROM obs WINDOW w AS (PARTITION BY entity_id ORDER BY ts, event_id))
SELECT event_id, CAST(CASE WHEN ok THEN row_number() OVER (PARTITION BY entity_id, breaks, ok ORDER BY ts, event_id) ELSE 0 END AS BIGINT) AS consecutive_successes,
  CAST(CASE WHEN ok THEN 0 ELSE row_number() OVER (PARTITION BY entity_id, wins, ok ORDER BY ts, event_id) END AS BIGINT) AS consecutive_failures, last_success FROM a""",
)
def streaks_and_last_success(spark, sf_dir):
    out = history.replay_streaks(observations(spark, sf_dir), ["entity_id"], ["ts", "event_id"], F.col("technical_status") == "healthy", "event_id")
    return out.select("event_id", "consecutive_successes", "consecutive_failures", F.col("last_success_at").alias("last_success"))


@query(
    "status_rollup_entity",
    f"WITH {OBSERVATIONS} SELECT entity_id, day, {TECH_NAMES}[min({TECH.format('technical_status')}) + 1] AS technical_status FROM obs GROUP BY entity_id, day",
)
def status_rollup_entity(spark, sf_dir):
    return observations(spark, sf_dir).groupBy("entity_id", "day").agg(policy.technical_rollup(F.col("technical_status")).alias("technical_status"))


@query(
    "status_rollup_global",
    f"WITH {OBSERVATIONS} SELECT coalesce({TECH_NAMES}[min({TECH.format('technical_status')}) FILTER (score > 90 AND technical_status <> 'healthy') + 1], 'unknown') AS technical_status, coalesce({TECH_NAMES}[min({TECH.format('technical_status')}) FILTER (score > 1000) + 1], 'unknown') AS of_none FROM obs",
)
def status_rollup_global(spark, sf_dir):
    df = observations(spark, sf_dir)
    over = F.when((F.col("score") > 90) & (F.col("technical_status") != "healthy"), F.col("technical_status"))
    none = F.when(F.col("score") > 1000, F.col("technical_status"))
    return df.agg(policy.technical_rollup(over).alias("technical_status"), policy.technical_rollup(none).alias("of_none"))


_LANG_RIGHTS = {"en": "verified", "de": "open_license", "fr": "public_unverified", "es": "restricted"}
_LANG_SQL = "CASE lang WHEN 'en' THEN 'verified' WHEN 'de' THEN 'open_license' WHEN 'fr' THEN 'public_unverified' WHEN 'es' THEN 'restricted' END"
_RIGHTS_SQL = "CASE r WHEN 'takedown' THEN 0 WHEN 'restricted' THEN 1 WHEN 'unknown' THEN 2 WHEN 'public_unverified' THEN 3 WHEN 'open_license' THEN 4 WHEN 'verified' THEN 5 END"


def _with_rights(df):
    out = None
    for k, v in _LANG_RIGHTS.items():
        out = F.when(F.col("lang") == k, v) if out is None else out.when(F.col("lang") == k, v)
    return df.withColumn("rights", out)


@query(
    "rights_most_restrictive",
    f"""WITH d AS (SELECT source, n_chars, doc_id, {_LANG_SQL} AS r FROM documents)
SELECT source, n_chars % 50 AS bucket, ['takedown','restricted','unknown','public_unverified','open_license','verified'][min({_RIGHTS_SQL}) + 1] AS rights, arg_min(r, doc_id) AS winner_rights FROM d GROUP BY ALL""",
)
def rights_most_restrictive(spark, sf_dir):
    df = _with_rights(table(spark, sf_dir, "documents")).withColumn("bucket", F.col("n_chars") % 50)
    return df.groupBy("source", "bucket").agg(policy.rights_rollup(F.col("rights")).alias("rights"), F.min_by("rights", "doc_id").alias("winner_rights"))


@query(
    "primary_and_secondary_reasons",
    f"""WITH {OBSERVATIONS}, g AS (SELECT entity_id, day, list(DISTINCT struct_pack(k := CASE failure_reason WHEN 'http_404' THEN 13 WHEN 'media_probe_failed' THEN 25 WHEN 'rate_limited' THEN 26 WHEN 'fetch_timeout' THEN 28 END, v := failure_reason)) FILTER (failure_reason IS NOT NULL) AS s FROM obs GROUP BY entity_id, day),
o AS (SELECT entity_id, day, list_transform(list_sort(coalesce(s, [])), lambda x: x.v) AS r FROM g)
SELECT entity_id, day, r[1] AS failure_reason, array_to_string(r[2:], ',') AS secondary_reasons FROM o""",
)
def primary_and_secondary_reasons(spark, sf_dir):
    out = observations(spark, sf_dir).groupBy("entity_id", "day").agg(policy.ordered_reasons(F.col("failure_reason")).alias("r"))
    return out.select("entity_id", "day", policy.primary_reason(F.col("r")).alias("failure_reason"), F.array_join(policy.secondary_reasons(F.col("r")), ",").alias("secondary_reasons"))


@query(
    "rights_counts_zero_filled",
    "SELECT source, " + ", ".join(f"count(*) FILTER ({_LANG_SQL} = '{r}') AS {r}" for r in S.RIGHTS) + " FROM documents GROUP BY source",
)
def rights_counts_zero_filled(spark, sf_dir):
    df = _with_rights(table(spark, sf_dir, "documents"))
    return df.groupBy("source").agg(*[F.count_if(F.coalesce(F.col("rights") == r, F.lit(False))).alias(r) for r in S.RIGHTS])


@query(
    "failure_histogram",
    f"""WITH {OBSERVATIONS} SELECT failure_reason, count(*) AS n FROM (SELECT failure_reason FROM obs WHERE failure_reason IS NOT NULL
UNION ALL SELECT CASE WHEN toxic = 1 THEN 'takedown' ELSE 'terms_changed' END FROM labels WHERE toxic = 1 OR quality = 0) GROUP BY failure_reason""",
)
def failure_histogram(spark, sf_dir):
    entity = observations(spark, sf_dir).where("failure_reason is not null").select("failure_reason")
    source = table(spark, sf_dir, "labels").where("toxic = 1 or quality = 0").select(F.when(F.col("toxic") == 1, "takedown").otherwise("terms_changed").alias("failure_reason"))
    return entity.unionByName(source).groupBy("failure_reason").agg(F.count("*").alias("n"))


@query(
    "current_baseline_sets",
    f"""WITH {OBSERVATIONS} SELECT day, count(DISTINCT entity_id) FILTER (technical_status = 'healthy') AS healthy_entities, count(DISTINCT score) FILTER (technical_status = 'healthy') AS published_keys,
count(*) FILTER (technical_status = 'healthy' AND score >= 50) AS stable FROM obs GROUP BY day""",
)
def current_baseline_sets(spark, sf_dir):
    ok = F.col("technical_status") == "healthy"
    return observations(spark, sf_dir).groupBy("day").agg(
        F.countDistinct(F.when(ok, F.col("entity_id"))).alias("healthy_entities"), F.countDistinct(F.when(ok, F.col("score"))).alias("published_keys"), F.count_if(ok & (F.col("score") >= 50)).alias("stable")
    )


@query(
    "line_rollup_min_rank",
    """WITH a AS (SELECT l_suppkey AS source_id, min(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) AS publication_rank, bool_or(l_quantity >= 49) AS has_stable FROM lineitem GROUP BY 1)
SELECT source_id, publication_rank, has_stable, CAST(row_number() OVER (ORDER BY publication_rank, has_stable DESC, source_id) AS BIGINT) AS line FROM a""",
)
def line_rollup_min_rank(spark, sf_dir):
    place = policy.rank(F.col("l_returnflag"), ["A", "N", "R"])
    out = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("source_id")).agg(F.min(place).alias("publication_rank"), F.bool_or(F.col("l_quantity") >= 49).alias("has_stable"))
    return numbering.numbered(out, [F.asc("publication_rank"), F.desc("has_stable"), F.asc("source_id")], "line").withColumn("line", F.col("line").cast("long"))


@query(
    "grouped_candidates_sorted",
    f"WITH {OBSERVATIONS} SELECT score, technical_status, string_agg(DISTINCT CAST(entity_id AS VARCHAR), ',' ORDER BY CAST(entity_id AS VARCHAR)) AS candidates FROM obs GROUP BY ALL",
)
def grouped_candidates_sorted(spark, sf_dir):
    return observations(spark, sf_dir).groupBy("score", "technical_status").agg(F.array_join(F.array_sort(F.collect_set(F.col("entity_id").cast("string"))), ",").alias("candidates"))


@query(
    "outage_group_count",
    f"""WITH {OBSERVATIONS}, g AS (SELECT day, entity_id % 4 AS grp, bool_or(technical_status = 'healthy' AND score > 60) AS passed FROM obs GROUP BY ALL)
SELECT day, count(*) AS groups, count(*) FILTER (NOT passed) AS failed, count(*) FILTER (NOT passed) >= 2 AS outage FROM g GROUP BY day""",
)
def outage_group_count(spark, sf_dir):
    ok = (F.col("technical_status") == "healthy") & (F.col("score") > 60)
    groups = observations(spark, sf_dir).groupBy("day", (F.col("entity_id") % 4).alias("grp")).agg(F.bool_or(ok).alias("passed"))
    return groups.groupBy("day").agg(F.count("*").alias("groups"), F.count_if(~F.col("passed")).alias("failed"), (F.count_if(~F.col("passed")) >= 2).alias("outage"))


@query("enabled_sources", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def enabled_sources(spark, sf_dir):
    return table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey", "s_name").orderBy("s_suppkey")


@query(
    "publishable_predicate",
    f"""WITH {OBSERVATIONS}, p AS (SELECT event_id, technical_status, score % 5 AS site_type, CASE WHEN score > 60 THEN 'stable' WHEN score > 20 THEN 'experimental' ELSE 'withheld' END AS publication_status, score % 3 AS media_score, latency % 2 = 0 AS has_ext FROM obs)
SELECT event_id, technical_status = 'healthy' AND publication_status = 'stable' AND media_score IN (1, 2) AS live,
  publication_status IN ('stable','experimental') AND site_type IN (0, 1, 4) AND CASE WHEN publication_status = 'stable' THEN technical_status = 'healthy' AND site_type IN (0, 1) ELSE technical_status IN ('healthy','partial') AND NOT (site_type = 4 AND has_ext) END AS vod FROM p""",
)
def publishable_predicate(spark, sf_dir):
    df = observations(spark, sf_dir).withColumn("publication_status", F.when(F.col("score") > 60, "stable").when(F.col("score") > 20, "experimental").otherwise("withheld"))
    live = policy.publishable_live(F.col("technical_status"), F.col("publication_status"), F.lit(True), F.col("score") % 3)
    vod = policy.publishable_vod(F.lit("verified"), F.col("publication_status"), F.col("technical_status"), F.col("score") % 5, F.lit(False), F.col("latency") % 2 == 0)
    return df.select("event_id", live.alias("live"), vod.alias("vod"))


@query(
    "client_key_collision_rename",
    """WITH a AS (SELECT p_partkey, p_brand, p_name, CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 THEN 'src_' || p_brand || '_' || p_name ELSE p_name END AS base FROM part),
b AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS n FROM a)
SELECT p_partkey, CASE WHEN n > 1 THEN base || '_' || n ELSE base END AS client_key FROM b""",
)
def client_key_collision_rename(spark, sf_dir):
    return select.unique_keys(table(spark, sf_dir, "part"), "p_brand", "p_name", ["p_partkey"]).select("p_partkey", "client_key")


@query(
    "pinned_first_then_ranked",
    """WITH r AS (SELECT p_partkey AS id, p_name AS name, p_size FROM part WHERE p_type = 'ECONOMY' UNION ALL SELECT -1, 'DS stable', -1)
SELECT id, name, CAST(row_number() OVER (ORDER BY CASE WHEN id = -1 THEN 0 ELSE 1 END, p_size DESC, id) - 1 AS BIGINT) AS line FROM r""",
)
def pinned_first_then_ranked(spark, sf_dir):
    df = table(spark, sf_dir, "part").where("p_type = 'ECONOMY'").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_size")
    pinned = spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit("DS stable").alias("name"), F.lit(-1).alias("p_size"))
    return select.pinned_first(df, pinned, [F.desc("p_size"), F.asc("id")]).select("id", "name", F.col("line").cast("long").alias("line"))


@query(
    "entity_ids_sha16",
    """SELECT 'vod:' || p_brand || ':' || substr(sha256(p_size || p_type || '/' || p_partkey), 1, 16) AS entity_id, substr(sha256(p_brand || chr(0) || p_size || chr(0) || p_name), 1, 8) AS suffix, printf('g%08d', p_partkey) AS release_id FROM part
UNION ALL SELECT 'live-url:pages:' || substr(sha256(url), 1, 16), 'channel:' || substr(sha256('tvg:' || lower(url)), 1, 16), 'source:' || page_id FROM pages""",
)
def entity_ids_sha16(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        ids.vod_id(F.col("p_brand"), F.col("p_size"), F.concat("p_type", F.lit("/"), F.col("p_partkey").cast("string"))).alias("entity_id"),
        ids.client_suffix(F.col("p_brand"), F.col("p_size"), F.col("p_name")).alias("suffix"),
        ids.release_id(F.col("p_partkey")).alias("release_id"),
    )
    pages = table(spark, sf_dir, "pages").select(
        ids.live_url_id(F.lit("pages"), F.col("url")).alias("entity_id"),
        ids.channel_id(ids.channel_key(ids.ascii_lower(F.col("url")), F.lit("pages"), F.col("url"))).alias("suffix"),
        ids.source_id(F.col("page_id").cast("string")).alias("release_id"),
    )
    return part.unionByName(pages)
