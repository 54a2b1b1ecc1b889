"""Queries of joins, set algebra and gates between runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftspark.functions import policy, urls
from siftspark.operators import closure, history, select, sets
from siftspark.plans.registry import query
from siftspark.plans.tables import OBSERVATIONS, observations
from siftspark.session import table


def _year(spark, sf_dir, year):
    """Customers of one year's orders as a run's entities."""
    df = table(spark, sf_dir, "orders").where(F.year("o_orderdate") == year)
    status = F.when(F.max("o_totalprice") > 400000, "healthy").when(F.max("o_totalprice") > 200000, "partial").otherwise("dead")
    return df.groupBy(F.col("o_custkey").alias("source_id")).agg(F.count("*").alias("n"), status.alias("technical"), F.min("o_orderstatus").alias("flag"))


_YEAR = """SELECT o_custkey AS source_id, count(*) AS n, CASE WHEN max(o_totalprice) > 400000 THEN 'healthy' WHEN max(o_totalprice) > 200000 THEN 'partial' ELSE 'dead' END AS technical, min(o_orderstatus) AS flag FROM orders WHERE year(o_orderdate) = {0} GROUP BY 1"""
_RUNS = f"prev AS ({_YEAR.format(1995)}), cur AS ({_YEAR.format(1996)})"


@query(
    "registry_broadcast_join",
    "SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def registry_broadcast_join(spark, sf_dir):
    # nation and region are fixed by the registry's own schema, 25 and 5 rows at any scale
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    nation = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"])
    return supplier.join(F.broadcast(nation), supplier["s_nationkey"] == nation["n_nationkey"]).select("s_suppkey", "s_name", "n_name", "r_name")


@query("observation_left_previous", f"WITH {_RUNS} SELECT cur.source_id, cur.n, coalesce(prev.n, 0) AS before, prev.source_id IS NULL AS is_new FROM cur LEFT JOIN prev USING (source_id)")
def observation_left_previous(spark, sf_dir):
    prev = _year(spark, sf_dir, 1995).select("source_id", F.col("n").alias("before"))
    return _year(spark, sf_dir, 1996).join(prev, "source_id", "left").select("source_id", "n", F.coalesce("before", F.lit(0)).alias("before"), F.col("before").isNull().alias("is_new"))


@query(
    "missing_children",
    f"""WITH {_RUNS} SELECT source_id, CASE WHEN c_acctbal > 0 THEN 'suspect' ELSE 'dead' END AS technical_status, n + 1 AS consecutive_failures FROM prev JOIN customer ON c_custkey = source_id WHERE source_id NOT IN (SELECT source_id FROM cur)""",
)
def missing_children(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"), F.when(F.col("c_acctbal") > 0, "suspect").otherwise("dead").alias("technical_status"))
    prev = _year(spark, sf_dir, 1995).select(F.col("source_id").alias("entity_id"), "source_id", F.col("n").alias("consecutive_failures"), F.lit(None).cast("string").alias("last_success_at"))
    out = history.carried_over(prev, _year(spark, sf_dir, 1996).select(F.col("source_id").alias("entity_id")), customers)
    return out.select("source_id", "technical_status", "consecutive_failures")


@query(
    "restored_parents",
    """WITH p AS (SELECT DISTINCT l_partkey AS channel, l_suppkey AS url FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = 1995),
c AS (SELECT DISTINCT l_partkey AS channel FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = 1996)
SELECT channel, string_agg(CAST(url AS VARCHAR), ',' ORDER BY CAST(url AS VARCHAR)) AS candidates FROM p WHERE channel NOT IN (SELECT channel FROM c) AND url IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY channel""",
)
def restored_parents(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("channel"), F.col("l_suppkey").alias("url"))
    both = line.join(orders.where("y in (1995, 1996)"), line["l_orderkey"] == orders["o_orderkey"])
    gone = history.missing_children(both.where("y = 1995").select("channel", "url"), both.where("y = 1996"), ["channel"])
    known = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("url"))
    return gone.join(known, "url", "left_semi").groupBy("channel").agg(F.array_join(F.array_sort(F.collect_set(F.col("url").cast("string"))), ",").alias("candidates"))


@query(
    "winner_left_join",
    f"""WITH {OBSERVATIONS}, w AS (SELECT entity_id, day, min(event_id) AS selected FROM obs WHERE technical_status = 'healthy' AND score > 50 GROUP BY ALL)
SELECT entity_id, day, count(*) AS candidates, any_value(selected) AS selected FROM obs LEFT JOIN w USING (entity_id, day) GROUP BY entity_id, day""",
)
def winner_left_join(spark, sf_dir):
    obs = observations(spark, sf_dir)
    winner = obs.where("technical_status = 'healthy' and score > 50").groupBy("entity_id", "day").agg(F.min("event_id").alias("selected"))
    return obs.groupBy("entity_id", "day").agg(F.count("*").alias("candidates")).join(winner, ["entity_id", "day"], "left")


_RANK = "CASE {0} WHEN 'dead' THEN 0 WHEN 'partial' THEN 4 WHEN 'healthy' THEN 5 END"


@query(
    "source_full_outer_change",
    f"""WITH {_RUNS} SELECT coalesce(prev.source_id, cur.source_id) AS source_id, CASE WHEN prev.source_id IS NULL THEN 'new' WHEN cur.source_id IS NULL THEN 'removed' WHEN cur.technical = 'dead' THEN 'dead' WHEN cur.flag = 'F' THEN 'withheld'
 WHEN {_RANK.format('cur.technical')} > {_RANK.format('prev.technical')} OR (prev.flag = 'F') THEN 'recovered' WHEN {_RANK.format('cur.technical')} < {_RANK.format('prev.technical')} THEN 'degraded' ELSE 'unchanged' END AS category
FROM prev FULL OUTER JOIN cur USING (source_id)""",
)
def source_full_outer_change(spark, sf_dir):
    side = lambda year, p: _year(spark, sf_dir, year).select("source_id", F.col("technical").alias(f"{p}t"), F.when(F.col("flag") == "F", "withheld").otherwise("stable").alias(f"{p}p"))
    both = side(1995, "a").join(side(1996, "b"), "source_id", "full_outer")
    facts = lambda p: {"technical": F.col(f"{p}t"), "publication": F.col(f"{p}p"), "rights": F.lit("verified")}
    return both.select("source_id", policy.change_category(F.col("at").isNotNull(), F.col("bt").isNotNull(), facts("a"), facts("b")).alias("category"))


_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1))"


@query(
    "denylist_semi_join_or",
    f"""WITH v AS (SELECT page_id AS source_id, url, {_HOST} AS host FROM pages), b AS (SELECT host FROM v WHERE source_id % 17 = 3), u AS (SELECT url FROM v WHERE source_id % 29 = 5)
SELECT source_id, 'host' AS reason FROM v WHERE host IN (SELECT host FROM b) UNION SELECT source_id, 'url' FROM v WHERE url IN (SELECT url FROM u) UNION SELECT source_id, 'id' FROM v WHERE source_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""",
)
def denylist_semi_join_or(spark, sf_dir):
    values = table(spark, sf_dir, "pages").select(F.col("page_id").alias("source_id"), "url", urls.host(F.col("url")).alias("host"))
    denied = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("source_id"))
    return sets.denied_sources(values, denied, values.where("source_id % 17 = 3").select("host"), values.where("source_id % 29 = 5").select("url"))


@query(
    "hash_target_join",
    "WITH h AS (SELECT doc_id, source, sha256(text) AS target_hash FROM documents), g AS (SELECT source, target_hash, min(doc_id) AS entity, count(*) AS n FROM h WHERE target_hash IS NOT NULL GROUP BY ALL HAVING count(*) > 1) SELECT doc_id, entity, n FROM h JOIN g USING (source, target_hash)",
)
def hash_target_join(spark, sf_dir):
    h = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("target_hash"))
    return sets.class_members(h, ["source", "target_hash"], "doc_id", "entity")


@query(
    "new_failure_ratio_gate",
    f"""WITH {_RUNS}, f AS (SELECT (SELECT count(*) FROM prev) AS previous, (SELECT count(*) FROM prev WHERE source_id NOT IN (SELECT source_id FROM cur)) AS lost, (SELECT count(*) FROM cur) AS now)
SELECT 'orders' AS gate, previous, lost, CASE WHEN previous >= 5 AND lost > previous * 0.2 THEN 'vod_failure_ratio' ELSE '' END AS reasons FROM f
UNION ALL SELECT 'exactly_twenty_percent', 5, 1, '' UNION ALL SELECT 'two_of_five', 5, 2, 'vod_failure_ratio' UNION ALL SELECT 'four_of_four', 4, 4, ''""",
)
def new_failure_ratio_gate(spark, sf_dir):
    prev, cur = (_year(spark, sf_dir, y).select("source_id") for y in (1995, 1996))
    marked = prev.join(cur.withColumn("here", F.lit(True)), "source_id", "left")
    facts = marked.agg(F.lit("orders").alias("gate"), F.count("*").alias("previous"), F.count_if(F.col("here").isNull()).alias("lost"))
    bounds = spark.createDataFrame([("exactly_twenty_percent", 5, 1), ("two_of_five", 5, 2), ("four_of_four", 4, 4)], "gate string, previous long, lost long")
    lit = lambda **k: {n: F.lit(v) for n, v in k.items()}
    known = lit(state_available=True, previous_known=True, live_lost=0, live_previous=0, vod_now=9, live_now=9, least_vod=1, least_live=1, least_previous=5, max_ratio=0.2, failed_groups=0, abort_groups=2)
    reasons = policy.gate_reasons(known | {"vod_lost": F.col("lost"), "vod_previous": F.col("previous")})
    return facts.unionByName(bounds).select("gate", "previous", "lost", F.array_join(reasons, ",").alias("reasons"))


@query(
    "unique_binding",
    """WITH c AS (SELECT p_type, p_size, count(*) AS owners, min(p_partkey) AS owner FROM part GROUP BY ALL)
SELECT p_type, p_size, owners, CASE WHEN owners = 1 THEN owner END AS owner, (SELECT count(*) FROM lineitem JOIN part p ON l_partkey = p_partkey WHERE p.p_type = c.p_type AND p.p_size = c.p_size) AS uses FROM c""",
)
def unique_binding(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    uses = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("u"))
    out = part.join(uses, "p_partkey", "left").groupBy("p_type", "p_size").agg(F.count("*").alias("owners"), F.min("p_partkey").alias("owner"), F.coalesce(F.sum("u"), F.lit(0)).alias("uses"))
    return out.withColumn("owner", F.when(F.col("owners") == 1, F.col("owner")))


@query("metadata_fallback_coalesce", "SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, CAST(n_chars % 2 AS INTEGER)) AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def metadata_fallback_coalesce(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.select("doc_id", "n_chars").join(labels, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", (F.col("n_chars") % 2).cast("int")).alias("toxic"))


_GLOBS = {"/en/**": "tvbox_json", "/*/*.html": "m3u", "/de/?*": "txt_live"}


@query(
    "exactly_one_glob",
    r"""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages), m AS (SELECT page_id, path, list_filter([CASE WHEN regexp_full_match(path, '/en/.*') THEN 'tvbox_json' END, CASE WHEN regexp_full_match(path, '/[^/]*/[^/]*\.html') THEN 'm3u' END, CASE WHEN regexp_full_match(path, '/de/[^/][^/]*') THEN 'txt_live' END], lambda x: x IS NOT NULL) AS hits FROM p)
SELECT page_id, path, CAST(len(hits) AS INTEGER) AS matches, CASE WHEN len(hits) = 1 THEN hits[1] END AS parser FROM m""",
)
def exactly_one_glob(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", urls.part(F.col("url"), 3).alias("path"))
    return closure.matched_once(pages, "path", _GLOBS)


@query(
    "historical_release_hits",
    """SELECT year(o_orderdate) AS release, count(DISTINCT l_suppkey) AS hits FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY 1""",
)
def historical_release_hits(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("release"))
    denied = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    hit = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").join(denied, "l_suppkey", "left_semi")
    return hit.join(orders, hit["l_orderkey"] == orders["o_orderkey"]).groupBy("release").agg(F.countDistinct("l_suppkey").alias("hits"))


@query(
    "manifest_closure_diff",
    """WITH d AS (SELECT doc_id AS path, sha256(text) AS h FROM documents WHERE doc_id % 10 <> 3), a AS (SELECT doc_id AS path, sha256(CASE WHEN doc_id % 50 = 7 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 10 <> 4)
SELECT coalesce(d.path, a.path) AS path, CASE WHEN a.path IS NULL THEN 'missing' WHEN d.path IS NULL THEN 'undeclared' ELSE 'changed' END AS rule FROM d FULL OUTER JOIN a ON d.path = a.path WHERE d.h IS DISTINCT FROM a.h""",
)
def manifest_closure_diff(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    declared = docs.where("path % 10 <> 3").select("path", F.sha2("text", 256).alias("h"))
    actual = docs.where("path % 10 <> 4").select("path", F.sha2(F.when(F.col("path") % 50 == 7, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("h"))
    return sets.closure_mismatch(declared, actual, "path", "h")


@query(
    "rebuild_equality",
    f"WITH {OBSERVATIONS} SELECT (SELECT count(DISTINCT (entity_id, day)) FROM obs WHERE technical_status = 'healthy') AS winners, (SELECT CAST(count(*) AS INTEGER) FROM (SELECT arg_min(event_id, {{'a': -score, 'b': latency, 'c': event_id}}) AS e FROM obs WHERE technical_status = 'healthy' GROUP BY entity_id, day) w WHERE e NOT IN (SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY entity_id, day ORDER BY -score, latency, event_id) AS r FROM obs WHERE technical_status = 'healthy') WHERE r = 1)) AS differences",
)
def rebuild_equality(spark, sf_dir):
    obs = observations(spark, sf_dir).where("technical_status = 'healthy'")
    order = [-F.col("score"), F.col("latency"), F.col("event_id")]
    produced = select.best_by_struct(obs, ["entity_id", "day"], order, ["event_id"]).select("entity_id", "day", "event_id")
    derived = select.best_per_group(obs, ["entity_id", "day"], order).select("entity_id", "day", "event_id")
    counted = sets.differences(produced, derived).agg(F.count("*").cast("int").alias("differences"))
    return produced.agg(F.count("*").alias("winners")).join(counted, F.lit(True))


@query(
    "safety_subtraction",
    f"""WITH {OBSERVATIONS}, bad AS (SELECT DISTINCT entity_id FROM obs WHERE technical_status = 'dead' AND score > 95)
SELECT day, count(*) AS items, count(DISTINCT entity_id) AS entities, count(*) FILTER (technical_status = 'healthy') AS healthy FROM obs WHERE entity_id NOT IN (SELECT entity_id FROM bad) GROUP BY day""",
)
def safety_subtraction(spark, sf_dir):
    obs = observations(spark, sf_dir)
    kept = sets.without(obs, obs.where("technical_status = 'dead' and score > 95"), ["entity_id"])
    return kept.groupBy("day").agg(F.count("*").alias("items"), F.countDistinct("entity_id").alias("entities"), F.count_if(F.col("technical_status") == "healthy").alias("healthy"))


@query(
    "exclude_then_reselect",
    f"""WITH {OBSERVATIONS}, k AS (SELECT * FROM obs WHERE technical_status = 'healthy' AND entity_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0))
SELECT score, arg_min(event_id, {{'a': latency, 'b': event_id}}) AS event_id, count(*) AS candidates FROM k GROUP BY score""",
)
def exclude_then_reselect(spark, sf_dir):
    denied = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("entity_id"))
    kept = sets.without(observations(spark, sf_dir).where("technical_status = 'healthy'"), denied, ["entity_id"])
    return kept.groupBy("score").agg(F.min_by("event_id", F.struct("latency", "event_id")).alias("event_id"), F.count("*").alias("candidates"))


@query(
    "pure_subtraction_proof",
    f"""WITH {OBSERVATIONS}, claimed AS (SELECT DISTINCT entity_id FROM obs WHERE technical_status = 'dead' AND score > 95), required AS (SELECT DISTINCT entity_id FROM obs WHERE technical_status = 'dead' AND score > 96)
SELECT entity_id, 'claimed' AS side FROM claimed WHERE entity_id NOT IN (SELECT entity_id FROM required) UNION ALL SELECT entity_id, 'required' FROM required WHERE entity_id NOT IN (SELECT entity_id FROM claimed)""",
)
def pure_subtraction_proof(spark, sf_dir):
    dead = observations(spark, sf_dir).where("technical_status = 'dead'")
    return sets.differences(dead.where("score > 95").select("entity_id").distinct(), dead.where("score > 96").select("entity_id").distinct())


@query(
    "union_publishable_kinds",
    f"""WITH {OBSERVATIONS} SELECT kind, count(*) AS n, count(DISTINCT id) AS ids FROM (SELECT 'live' AS kind, CAST(entity_id AS VARCHAR) AS id FROM obs WHERE technical_status = 'healthy' UNION ALL SELECT 'vod', p_type || p_size FROM part WHERE p_size > 10) GROUP BY kind""",
)
def union_publishable_kinds(spark, sf_dir):
    live = observations(spark, sf_dir).where("technical_status = 'healthy'").select(F.lit("live").alias("kind"), F.col("entity_id").cast("string").alias("id"))
    vod = table(spark, sf_dir, "part").where("p_size > 10").select(F.lit("vod").alias("kind"), F.concat("p_type", F.col("p_size").cast("string")).alias("id"))
    return live.unionByName(vod).groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))


@query("limit_exceeded_not_truncated", "SELECT source, lang, count(*) AS n, CASE WHEN count(*) > 20 THEN 'catalog_limit_exceeded' ELSE 'ok' END AS outcome FROM documents GROUP BY ALL")
def limit_exceeded_not_truncated(spark, sf_dir):
    return sets.outcome_within(table(spark, sf_dir, "documents"), ["source", "lang"], 20)


@query("duplicate_key_violations", "SELECT sha256(text) AS key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_key_violations(spark, sf_dir):
    return sets.repeated(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("key")), ["key"])


@query(
    "bounded_closure",
    """WITH RECURSIVE e(src, dst) AS (SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || n_regionkey, 'n' || ((n_nationkey * 7 + 3) % 25) FROM nation),
w(node, depth) AS (SELECT 'n0', 0 UNION ALL SELECT DISTINCT e.dst, w.depth + 1 FROM w JOIN e ON w.node = e.src WHERE w.depth < 4)
SELECT node, min(depth) AS depth FROM w GROUP BY node""",
)
def bounded_closure(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    n = lambda c: F.concat(F.lit("n"), c.cast("string"))
    r = F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))
    edges = nation.select(n(F.col("n_nationkey")).alias("src"), r.alias("dst")).unionByName(nation.select(r.alias("src"), n((F.col("n_nationkey") * 7 + 3) % 25).alias("dst")))
    return closure.reachable(spark.range(1).select(F.lit("n0").alias("node")), edges, 4)
