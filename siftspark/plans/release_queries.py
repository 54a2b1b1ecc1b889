"""Queries of release rules, rebuilt facts and removals: suppliers stand in for sources, line items for their entities, pages
for addresses, documents for files."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftspark import schemas as S
from siftspark.functions import policy, urls
from siftspark.operators import rebuild
from siftspark.plans.registry import query
from siftspark.session import table
from siftspark.validate import release

_list = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]"
SRC = f"""src AS (SELECT 's' || s_suppkey AS source_id, s_suppkey AS k, s_suppkey % 7 <> 0 AS enabled, {_list(S.RIGHTS)}[s_suppkey % 6 + 1] AS rights_status,
  {_list(S.SOURCE_KINDS)}[s_nationkey % 4 + 1] AS kind, {_list(S.FETCH_MODES)}[s_suppkey % 3 + 1] AS mode, 'h' || s_nationkey || '.example.com' AS host,
  'https://h' || s_nationkey || '.example.com/' || s_suppkey AS url, CASE WHEN s_suppkey % 3 <> 0 THEN substr(sha256(s_name), 1, 40) END AS revision, s_acctbal FROM supplier)"""
ITM = """itm AS (SELECT 'live:s' || l_suppkey || ':' || l_orderkey || '-' || l_linenumber AS entity_id, 's' || l_suppkey AS source_id, 'live' AS entity_type, 'c' || l_partkey AS channel_id,
  CASE l_linestatus WHEN 'O' THEN 'stable' ELSE 'withheld' END AS publication_status, CASE l_returnflag WHEN 'N' THEN 'healthy' WHEN 'A' THEN 'partial' ELSE 'dead' END AS technical_status, l_orderkey, l_suppkey FROM lineitem)"""


def _pick(values, n):
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def sources(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    k, nation = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    host = F.concat(F.lit("h"), nation, F.lit(".example.com"))
    return s.select(
        F.concat(F.lit("s"), k.cast("string")).alias("source_id"), k.alias("k"), (k % 7 != 0).alias("enabled"), _pick(S.RIGHTS, k).alias("rights_status"),
        _pick(S.SOURCE_KINDS, F.col("s_nationkey")).alias("kind"), _pick(S.FETCH_MODES, k).alias("mode"), host.alias("host"),
        F.concat(F.lit("https://"), host, F.lit("/"), k.cast("string")).alias("url"), F.when(k % 3 != 0, F.substring(F.sha2("s_name", 256), 1, 40)).alias("revision"), "s_acctbal",
    )


def items(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    text = lambda c: F.col(c).cast("string")
    return line.select(
        F.concat(F.lit("live:s"), text("l_suppkey"), F.lit(":"), text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("entity_id"),
        F.concat(F.lit("s"), text("l_suppkey")).alias("source_id"), F.lit("live").alias("entity_type"), F.concat(F.lit("c"), text("l_partkey")).alias("channel_id"),
        F.when(F.col("l_linestatus") == "O", "stable").otherwise("withheld").alias("publication_status"),
        F.when(F.col("l_returnflag") == "N", "healthy").when(F.col("l_returnflag") == "A", "partial").otherwise("dead").alias("technical_status"), "l_orderkey", "l_suppkey",
    )


def _denylist(src):
    return src.where("k % 11 = 3").select("source_id"), src.where("k % 50 = 9").select("host").distinct(), src.where("k % 13 = 5").select("url")


_HIT = "(source_id IN (SELECT source_id FROM src WHERE k % 11 = 3) OR host IN (SELECT host FROM src WHERE k % 50 = 9) OR url IN (SELECT url FROM src WHERE k % 13 = 5))"


def _with_lists(src):
    return src.withColumn("hosts", F.array("host")).withColumn("urls", F.array("url"))


@query("active_sources", f"WITH {SRC} SELECT source_id, rights_status FROM src WHERE enabled AND NOT {_HIT}")
def active_sources(spark, sf_dir):
    src = sources(spark, sf_dir)
    return release.active_sources(_with_lists(src), *_denylist(src)).select("source_id", "rights_status")


@query("denied_but_active", f"WITH {SRC} SELECT 'denied_source_active' AS rule, source_id AS key, '' AS detail FROM src WHERE enabled AND {_HIT}")
def denied_but_active(spark, sf_dir):
    src = sources(spark, sf_dir)
    return release.denied_but_active(_with_lists(src), *_denylist(src))


@query(
    "upstream_bindings",
    f"""WITH {SRC}, u AS (SELECT source_id, k, CASE WHEN k % 17 = 4 THEN 'direct_url' ELSE mode END AS fetch_mode, revision AS reviewed_revision, CASE WHEN k % 19 = 3 THEN 'abc' ELSE revision END AS resolved_revision,
  CASE WHEN k % 23 = 2 THEN url || '/x' ELSE url END AS resolved_fetch_url, CASE WHEN k % 29 = 1 THEN 'changed' ELSE 'same' END AS terms FROM src WHERE k % 10 <> 1),
h AS (SELECT source_id, revision AS upstream_revision FROM src WHERE k % 10 <> 2), r AS (SELECT source_id, mode, revision AS reviewed, url AS expected_url, 'same' AS reviewed_terms FROM src WHERE k % 10 <> 3),
j AS (SELECT coalesce(u.source_id, h.source_id, r.source_id) AS key, u.source_id AS us, h.source_id AS hs, r.source_id AS rs, * EXCLUDE (source_id) FROM u FULL JOIN h ON u.source_id = h.source_id FULL JOIN r ON coalesce(u.source_id, h.source_id) = r.source_id)
SELECT rule, key, '' AS detail FROM (
SELECT 'upstream_without_health' AS rule, key FROM j WHERE us IS NOT NULL AND hs IS NULL UNION ALL SELECT 'health_without_upstream', key FROM j WHERE hs IS NOT NULL AND us IS NULL
UNION ALL SELECT 'revision_differs_from_health', key FROM j WHERE us IS NOT NULL AND hs IS NOT NULL AND upstream_revision IS DISTINCT FROM resolved_revision
UNION ALL SELECT 'mode_differs', key FROM j WHERE us IS NOT NULL AND rs IS NOT NULL AND fetch_mode <> mode
UNION ALL SELECT 'direct_claims_revision', key FROM j WHERE us IS NOT NULL AND mode = 'direct_url' AND (reviewed_revision IS NOT NULL OR resolved_revision IS NOT NULL)
UNION ALL SELECT 'bad_revision', key FROM j WHERE us IS NOT NULL AND mode <> 'direct_url' AND NOT coalesce(regexp_full_match(resolved_revision, '[0-9a-f]{{40}}'), false)
UNION ALL SELECT 'url_differs', key FROM j WHERE us IS NOT NULL AND rs IS NOT NULL AND resolved_fetch_url <> expected_url
UNION ALL SELECT 'not_in_registry', key FROM j WHERE us IS NOT NULL AND rs IS NULL UNION ALL SELECT 'registry_without_upstream', key FROM j WHERE rs IS NOT NULL AND us IS NULL
UNION ALL SELECT 'reviewed_revision_differs', key FROM j WHERE us IS NOT NULL AND rs IS NOT NULL AND reviewed_revision IS DISTINCT FROM reviewed
UNION ALL SELECT 'terms_differ', key FROM j WHERE us IS NOT NULL AND rs IS NOT NULL AND terms <> reviewed_terms)""",
)
def upstream_bindings(spark, sf_dir):
    src, k = sources(spark, sf_dir), F.col("k")
    claimed = src.where("k % 10 <> 1").select(
        "source_id", F.when(k % 17 == 4, "direct_url").otherwise(F.col("mode")).alias("fetch_mode"), F.col("revision").alias("reviewed_revision"),
        F.when(k % 19 == 3, "abc").otherwise(F.col("revision")).alias("resolved_revision"), F.when(k % 23 == 2, F.concat("url", F.lit("/x"))).otherwise(F.col("url")).alias("resolved_fetch_url"),
        F.when(k % 29 == 1, "changed").otherwise("same").alias("terms"),
    )
    health = src.where("k % 10 <> 2").select("source_id", F.col("revision").alias("upstream_revision"))
    known = src.where("k % 10 <> 3").select("source_id", "mode", F.col("revision").alias("reviewed"), F.col("url").alias("expected_url"), F.lit("same").alias("reviewed_terms"))
    return release.upstream_bindings(claimed, health, known)


_ROLL = "CASE min(CASE r WHEN 'takedown' THEN 0 WHEN 'restricted' THEN 1 WHEN 'unknown' THEN 2 WHEN 'public_unverified' THEN 3 WHEN 'open_license' THEN 4 WHEN 'verified' THEN 5 END) WHEN 0 THEN 'takedown' WHEN 1 THEN 'restricted' WHEN 2 THEN 'unknown' WHEN 3 THEN 'public_unverified' WHEN 4 THEN 'open_license' WHEN 5 THEN 'verified' END"


@query(
    "rights_bindings",
    f"""WITH {SRC}, {ITM}, d AS (SELECT channel_id, {_ROLL} AS rights FROM (SELECT channel_id, rights_status AS r FROM itm JOIN src USING (source_id)) GROUP BY 1)
SELECT 'rights_differ' AS rule, source_id AS key, rights_status AS detail FROM src WHERE k % 9 = 2 AND rights_status <> 'verified'
UNION ALL SELECT 'rights_barred', entity_id, rights_status FROM itm JOIN src USING (source_id) WHERE rights_status IN ('takedown', 'restricted', 'unknown') AND publication_status = 'stable'
UNION ALL SELECT 'channel_rights', channel_id, rights FROM d WHERE rights <> 'takedown'""",
)
def rights_bindings(spark, sf_dir):
    src, rows = sources(spark, sf_dir), items(spark, sf_dir)
    health = src.select("source_id", F.when(F.col("k") % 9 == 2, "verified").otherwise(F.col("rights_status")).alias("rights_status"))
    channels = rows.select("channel_id").distinct().withColumn("rights_status", F.lit("takedown"))
    return release.rights_bindings(health, src, rows, channels)


@query("rights_floor", f"WITH {SRC} SELECT 'retained_though_blocked' AS rule, source_id AS key, rights_status AS detail FROM src WHERE k % 4 <> 1 AND rights_status IN ('restricted', 'takedown')")
def rights_floor(spark, sf_dir):
    src = sources(spark, sf_dir)
    return release.rights_floor(src.where("k % 4 <> 1").select("source_id"), src)


@query(
    "site_categories",
    """WITH s AS (SELECT p_partkey AS key, string_split(p_name, ' ') AS c, 'https://' || CASE WHEN p_size % 5 = 0 THEN 'other' ELSE 'shop' END || '.example.com/' || p_partkey AS api, p_partkey % 3 = 0 AS free FROM part)
SELECT rule, CAST(key AS VARCHAR) AS key, '' AS detail FROM (SELECT 'categories_not_canonical' AS rule, key FROM s WHERE c <> list_sort(list_distinct(c)) UNION ALL SELECT 'denied_category', key FROM s WHERE list_contains(c, 'widget')
UNION ALL SELECT 'host_not_allowed', key FROM s WHERE NOT free AND api LIKE 'https://other%')""",
)
def site_categories(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    host = F.when(F.col("p_size") % 5 == 0, "other").otherwise("shop")
    sites = part.select(
        F.col("p_partkey").alias("site_id"), F.when(F.col("p_partkey") % 3 == 0, "free").otherwise("bound").alias("source_id"), F.split("p_name", " ").alias("categories"),
        F.concat(F.lit("https://"), host, F.lit(".example.com/"), F.col("p_partkey").cast("string")).alias("api"),
    )
    rows = [("free", [" widget "], [], True), ("bound", ["widget"], ["shop.example.com"], False)]
    return release.site_categories(sites, spark.createDataFrame(rows, "source_id string, denied_categories array<string>, allowed_hosts array<string>, allow_discovered_media_hosts boolean"))


@query(
    "facts_differ",
    """WITH a AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 8 = 1 THEN NULL ELSE p_brand END AS p_brand, p_type, p_size FROM part WHERE p_partkey % 9 <> 2), e AS (SELECT p_partkey AS k, p_brand, CASE WHEN p_partkey % 12 = 5 THEN 'X' ELSE p_type END AS p_type, p_size FROM part WHERE p_partkey % 9 <> 3)
SELECT rule, CAST(key AS VARCHAR) AS key, '' AS detail FROM (SELECT 'missing' AS rule, k AS key FROM e WHERE k NOT IN (SELECT k FROM a) UNION ALL SELECT 'unexpected', k FROM a WHERE k NOT IN (SELECT k FROM e)
UNION ALL SELECT 'p_brand_differs', k FROM a JOIN e USING (k) WHERE a.p_brand IS DISTINCT FROM e.p_brand UNION ALL SELECT 'p_type_differs', k FROM a JOIN e USING (k) WHERE a.p_type IS DISTINCT FROM e.p_type)""",
)
def facts_differ(spark, sf_dir):
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    actual = part.where("p_partkey % 9 <> 2").withColumn("p_brand", F.when(k % 8 != 1, F.col("p_brand")))
    expected = part.where("p_partkey % 9 <> 3").withColumn("p_type", F.when(k % 12 == 5, "X").otherwise(F.col("p_type")))
    return release.facts_differ(actual, expected, "p_partkey", ["p_brand", "p_type", "p_size"])


@query(
    "kind_matrix",
    f"""WITH {SRC}, i AS (SELECT source_id, CASE WHEN k % 5 = 0 THEN 'live' ELSE CASE kind WHEN 'live_playlist' THEN 'live' WHEN 'repository_catalog' THEN 'catalog' ELSE 'vod' END END AS t, k % 2 = 0 AS shown FROM src WHERE k % 8 <> 3),
j AS (SELECT source_id AS key, kind, t, shown, k % 3 <> 1 AS c, CASE kind WHEN 'live_playlist' THEN 'live' WHEN 'repository_catalog' THEN 'catalog' ELSE 'vod' END AS fit FROM src LEFT JOIN i USING (source_id))
SELECT rule, key, '' AS detail FROM (SELECT 'foreign_item_type' AS rule, key FROM j WHERE t <> fit UNION ALL SELECT 'config_of_other_kind', key FROM j WHERE c AND fit <> 'vod'
UNION ALL SELECT 'config_missing', key FROM j WHERE fit = 'vod' AND shown AND NOT c UNION ALL SELECT 'config_without_items', key FROM j WHERE fit = 'vod' AND c AND NOT coalesce(shown, false))""",
)
def kind_matrix(spark, sf_dir):
    src = sources(spark, sf_dir)
    fit = F.when(F.col("kind") == "live_playlist", "live").when(F.col("kind") == "repository_catalog", "catalog").otherwise("vod")
    rows = src.where("k % 8 <> 3").select("source_id", F.when(F.col("k") % 5 == 0, "live").otherwise(fit).alias("entity_type"), (F.col("k") % 2 == 0).alias("published"))
    return release.kind_matrix(src.select("source_id", "kind"), rows, src.where("k % 3 <> 1").select("source_id"))


@query(
    "denied_payload",
    """WITH v AS (SELECT 'p' || page_id AS s, url, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host, regexp_replace(url, '#.*', '') AS n FROM pages)
SELECT 'denied_value' AS rule, s AS key, 'host' AS detail FROM v WHERE host IN (SELECT host FROM v WHERE s LIKE '%7') UNION SELECT 'denied_value', s, 'url' FROM v WHERE n IN (SELECT n FROM v WHERE s LIKE '%3') UNION SELECT 'denied_value', s, 'id' FROM v WHERE s LIKE '%1'""",
)
def denied_payload(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("source_id"), "url")
    hosts = pages.where("source_id like '%7'").select(urls.host(F.col("url")).alias("host")).distinct()
    blocked = pages.where("source_id like '%3'").select(urls.normal_url(F.col("url")).alias("url")).distinct()
    return release.denied_payload(pages, pages.where("source_id like '%1'").select("source_id"), hosts, blocked)


_FILES = "SELECT source || '/' || doc_id AS path, octet_length(encode(text)) AS size, sha256(text) AS h, doc_id FROM documents"


def _files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"), F.octet_length("text").cast("long").alias("size"), F.sha2("text", 256).alias("sha256"), "doc_id")


@query(
    "file_inventory",
    f"""WITH f AS ({_FILES} WHERE text IS NOT NULL), d AS (SELECT path, CASE WHEN doc_id % 40 = 1 THEN size + 1 ELSE size END AS size, CASE WHEN doc_id % 30 = 2 THEN 'x' ELSE h END AS h FROM f WHERE doc_id % 20 <> 3), a AS (SELECT CASE WHEN doc_id % 25 = 6 THEN '../' || path ELSE path END AS path, size, h FROM f WHERE doc_id % 20 <> 4)
SELECT rule, key, '' AS detail FROM (SELECT 'missing' AS rule, path AS key FROM d WHERE path NOT IN (SELECT path FROM a) UNION ALL SELECT 'undeclared', path FROM a WHERE path NOT IN (SELECT path FROM d)
UNION ALL SELECT 'size_differs', path FROM d JOIN a USING (path) WHERE d.size <> a.size UNION ALL SELECT 'hash_differs', path FROM d JOIN a USING (path) WHERE d.h <> a.h UNION ALL SELECT 'unsafe_path', path FROM a WHERE path LIKE '../%')
UNION ALL SELECT 'total_exceeds_cap', '*', CAST(sum(size) AS VARCHAR) FROM a HAVING sum(size) > 1000""",
)
def file_inventory(spark, sf_dir):
    files, k = _files(spark, sf_dir), F.col("doc_id")
    declared = files.where("doc_id % 20 <> 3").select("path", F.when(k % 40 == 1, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(k % 30 == 2, "x").otherwise(F.col("sha256")).alias("sha256"))
    actual = files.where("doc_id % 20 <> 4").select(F.when(k % 25 == 6, F.concat(F.lit("../"), "path")).otherwise(F.col("path")).alias("path"), "size", "sha256")
    return release.inventory(declared, actual, 1000)


@query(
    "sealed_inventory",
    f"""WITH f AS ({_FILES} WHERE text IS NOT NULL), p AS (SELECT split_part(path, '/', 1) AS top, count(*) AS n, sum(size) AS size, sha256(array_to_string(list_sort(list(path || ':' || size || ':' || h)), chr(10))) AS h FROM f GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS files, CAST(sum(size) AS BIGINT) AS bytes, sha256(array_to_string(list_sort(list(top || ':' || h)), chr(10))) AS digest FROM p""",
)
def sealed_inventory(spark, sf_dir):
    return release.sealed(_files(spark, sf_dir))


@query(
    "release_closure",
    f"""WITH {SRC}, l AS (SELECT source_id AS name, CASE WHEN k % 10 = 1 THEN 'https://x.example.com/' ELSE 'https://r.example.com/releases/g00000001/' END || CASE WHEN k % 15 = 2 THEN '../' ELSE '' END || 'configs/' || source_id || '.json' AS url FROM src WHERE k % 6 <> 5),
p AS (SELECT 'configs/' || source_id || '.json' AS path FROM src WHERE k % 9 <> 4), o AS (SELECT name, url, CASE WHEN url LIKE 'https://r.example.com/releases/g00000001/%' THEN substr(url, 42) END AS path FROM l)
SELECT 'crosses_release' AS rule, name AS key, url AS detail FROM o WHERE path IS NULL OR path LIKE '../%' UNION ALL SELECT 'target_missing', name, path FROM o WHERE path IS NOT NULL AND path NOT IN (SELECT path FROM p)
UNION ALL SELECT 'config_unreferenced', path, '' FROM p WHERE path NOT IN (SELECT path FROM o WHERE path IS NOT NULL)""",
)
def release_closure(spark, sf_dir):
    src, k, prefix = sources(spark, sf_dir), F.col("k"), "https://r.example.com/releases/g00000001/"
    file = F.concat(F.lit("configs/"), "source_id", F.lit(".json"))
    head = F.when(k % 10 == 1, "https://x.example.com/").otherwise(prefix)
    links = src.where("k % 6 <> 5").select(F.col("source_id").alias("name"), F.concat(head, F.when(k % 15 == 2, "../").otherwise(""), file).alias("url"))
    return release.release_closure(links, src.where("k % 9 <> 4").select(file.alias("path")), prefix)


_UPS = f"""{SRC}, u AS (SELECT CAST(row_number() OVER (ORDER BY source_id) AS BIGINT) + CASE WHEN k % 21 = 8 THEN 1 ELSE 0 END AS ordinal, CASE WHEN k % 31 = 7 THEN upper(source_id) ELSE source_id END AS source_id, k, CASE WHEN k % 16 = 3 THEN 'ftp' ELSE mode END AS fetch_mode, revision AS reviewed_revision,
  CASE WHEN k % 18 = 1 THEN NULL ELSE revision END AS resolved_revision, CASE WHEN k % 14 = 6 THEN url || '?token=1' WHEN k % 14 = 9 THEN 'https://a@b.example.com/' ELSE url END AS resolved_fetch_url, CASE WHEN k % 27 = 5 THEN 'zz' ELSE 'sha256:' || sha256(source_id) END AS term FROM src)"""


def _upstreams(spark, sf_dir):
    from pyspark.sql.window import Window

    src, k = sources(spark, sf_dir), F.col("k")
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("source_id")).cast("long")  # a registry is a few rows
    return src.select(
        (place + F.when(k % 21 == 8, 1).otherwise(0)).alias("ordinal"), F.when(k % 31 == 7, F.upper("source_id")).otherwise(F.col("source_id")).alias("source_id"),
        F.when(k % 16 == 3, "ftp").otherwise(F.col("mode")).alias("fetch_mode"), F.col("revision").alias("reviewed_revision"), F.when(k % 18 != 1, F.col("revision")).alias("resolved_revision"),
        F.when(k % 14 == 6, F.concat("url", F.lit("?token=1"))).when(k % 14 == 9, "https://a@b.example.com/").otherwise(F.col("url")).alias("resolved_fetch_url"),
        F.create_map(F.lit("terms"), F.when(k % 27 == 5, "zz").otherwise(F.concat(F.lit("sha256:"), F.sha2("source_id", 256)))).alias("terms"),
    )


_SHA = "coalesce(regexp_full_match({0}, '[0-9a-f]{{40}}'), false)"
_BAD = f"""SELECT 'bad_source_id' AS rule, source_id AS key FROM u WHERE NOT regexp_full_match(source_id, '[a-z0-9][a-z0-9-]*') UNION ALL SELECT 'bad_mode', source_id FROM u WHERE fetch_mode = 'ftp'
UNION ALL SELECT 'direct_claims_revision', source_id FROM u WHERE fetch_mode = 'direct_url' AND (reviewed_revision IS NOT NULL OR resolved_revision IS NOT NULL)
UNION ALL SELECT 'bad_revision', source_id FROM u WHERE fetch_mode <> 'direct_url' AND NOT ({_SHA.format('reviewed_revision')} AND {_SHA.format('resolved_revision')})
UNION ALL SELECT 'bad_url', source_id FROM u WHERE resolved_fetch_url LIKE '%?token=%' OR resolved_fetch_url LIKE '%@%'"""


@query(
    "upstream_records",
    f"""WITH {_UPS} SELECT rule, key, '' AS detail FROM ({_BAD} UNION ALL SELECT 'bad_terms', source_id FROM u
UNION ALL SELECT CASE WHEN a.source_id < b.source_id THEN 'not_sorted' ELSE 'repeated' END, a.source_id FROM u a JOIN u b ON a.ordinal = b.ordinal + 1 WHERE a.source_id <= b.source_id)""",
)
def upstream_records(spark, sf_dir):
    return release.upstream_records(_upstreams(spark, sf_dir))


@query(
    "normalised_upstreams",
    f"""WITH {_UPS} SELECT source_id, regexp_replace(term, '^sha256:', '') AS term, NOT (source_id IN (SELECT key FROM ({_BAD})) OR term = 'zz') AS fit FROM u""",
)
def normalised_upstreams(spark, sf_dir):
    return release.normalised_upstreams(_upstreams(spark, sf_dir)).select("source_id", F.col("terms")["terms"].alias("term"), "fit")


_MAN = """m AS (SELECT 'g' || lpad(CAST(CASE WHEN o_orderkey % 9 = 1 THEN o_orderkey + 1 ELSE o_orderkey END AS VARCHAR), 8, '0') AS release_id, o_orderkey AS k FROM orders)"""


@query(
    "manifest_rules",
    f"""WITH {_MAN} SELECT rule, release_id AS key, '' AS detail FROM (SELECT 'id_is_not_generation' AS rule, release_id FROM m WHERE k % 9 = 1 OR k < 1 UNION ALL SELECT 'bad_count', release_id FROM m WHERE k % 40 = 2
UNION ALL SELECT 'source_count_differs', release_id FROM m WHERE k % 33 = 4 UNION ALL SELECT 'bad_identity', release_id FROM m WHERE k % 25 = 6 UNION ALL SELECT 'root_generated_at_differs', release_id FROM m WHERE k % 28 = 3)""",
)
def manifest_rules(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        release.release_id(F.when(k % 9 == 1, k + 1).otherwise(k)).alias("release_id"), k.alias("generation"), F.lit(5).alias("source_count"), F.when(k % 40 == 2, -1).otherwise(0).alias("vod_site_count"),
        F.lit(0).alias("live_channel_count"), F.when(k % 33 == 4, 4).otherwise(5).alias("upstreams"), F.when(k % 25 == 6, "").otherwise("7").alias("content_run_id"), F.lit(1).alias("content_run_attempt"),
        F.lit("a").alias("generated_at"), F.lit(None).cast("string").alias("previous_commit_sha"), F.when(k % 28 == 3, "b").otherwise("a").alias("root_generated_at"),
        F.lit(None).cast("string").alias("root_previous_commit_sha"), F.when(k % 25 == 6, "").otherwise("7").alias("root_content_run_id"), F.lit(1).alias("root_content_run_attempt"),
    )
    return release.manifest_rules(rows)


@query(
    "state_and_report",
    """WITH s AS (SELECT 'g' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS key, o_orderkey AS k, CASE WHEN o_orderkey % 4 = 1 THEN 'rollback' ELSE 'regular' END AS kind, o_orderkey + CASE WHEN o_orderkey % 8 = 1 THEN 1 WHEN o_orderkey % 12 = 2 THEN 2 ELSE 0 END AS sg FROM orders)
SELECT rule, key, '' AS detail FROM (SELECT 'not_together' AS rule, key FROM s WHERE k % 50 = 3 UNION ALL SELECT 'status_pair', key FROM s WHERE k % 50 <> 3 AND k % 30 = 4 UNION ALL SELECT 'active_release', key FROM s WHERE k % 50 <> 3 AND k % 35 = 6
UNION ALL SELECT 'kind', key FROM s WHERE k % 50 <> 3 AND k % 45 = 7 UNION ALL SELECT 'rollback_generation', key FROM s WHERE k % 50 <> 3 AND kind = 'rollback' AND sg <= k UNION ALL SELECT 'content_generation', key FROM s WHERE k % 50 <> 3 AND kind <> 'rollback' AND sg <> k)""",
)
def state_and_report(spark, sf_dir):
    k = F.col("o_orderkey")
    kind, generation = F.when(k % 4 == 1, "rollback").otherwise("regular"), k + F.when(k % 8 == 1, 1).when(k % 12 == 2, 2).otherwise(0)
    own = release.release_id(k)
    rows = table(spark, sf_dir, "orders").select(
        own.alias("release_id"), k.alias("generation"), F.lit("success").alias("state_status"), F.when(k % 50 != 3, F.when(k % 30 == 4, "safety_degraded").otherwise("success")).alias("report_status"),
        kind.alias("state_kind"), F.when(k % 45 == 7, "safety").otherwise(kind).alias("report_kind"), F.array(F.lit("safety_degraded")).alias("gate_reasons"), own.alias("state_release"),
        F.when(k % 35 == 6, "g00000000").otherwise(own).alias("report_release"), F.lit("1").alias("state_run"), F.lit("1").alias("report_run"), generation.alias("state_generation"), generation.alias("report_generation"),
    )
    return release.state_and_report(rows)


@query(
    "success_state",
    """WITH s AS (SELECT 'g' || lpad(CAST(CASE WHEN o_orderkey % 9 = 1 THEN o_orderkey + 1 ELSE o_orderkey END AS VARCHAR), 8, '0') AS key, o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'rollback' WHEN o_orderstatus = 'O' THEN 'safety' ELSE 'regular' END AS kind FROM orders)
SELECT rule, key, '' AS detail FROM (SELECT 'not_success' AS rule, key FROM s WHERE k % 20 = 3 UNION ALL SELECT 'bad_generation', key FROM s WHERE k < 1 UNION ALL SELECT 'release_is_not_generation', key FROM s WHERE kind <> 'rollback' AND k % 9 = 1
UNION ALL SELECT 'no_publish_time', key FROM s WHERE k % 13 = 2 UNION ALL SELECT 'no_success_time', key FROM s WHERE kind = 'regular' AND k % 7 = 5)""",
)
def success_state(spark, sf_dir):
    k = F.col("o_orderkey")
    kind = F.when(F.col("o_orderstatus") == "F", "rollback").when(F.col("o_orderstatus") == "O", "safety").otherwise("regular")
    rows = table(spark, sf_dir, "orders").select(
        F.lit("1.0.0").alias("schema_version"), F.when(k % 20 == 3, "pending").otherwise("success").alias("status"), kind.alias("release_kind"), k.alias("generation"),
        release.release_id(F.when(k % 9 == 1, k + 1).otherwise(k)).alias("active_release_id"), F.when(k % 13 == 2, "2024-02-31T00:00:00Z").otherwise("2024-02-28T00:00:00Z").alias("last_publish_at"),
        F.when(k % 7 != 5, "2024-02-28T01:02:03Z").alias("last_success_at"), F.lit("c").alias("content_commit_sha"), F.lit("1").alias("workflow_run_id"), F.lit(1).alias("workflow_run_attempt"),
    )
    return release.success_state(rows)


@query("refused_client_urls", "SELECT 'refused_url' AS rule, CAST(page_id AS VARCHAR) AS key, 'client_http_disallowed' AS detail FROM pages WHERE url LIKE 'http://%'")
def refused_client_urls(spark, sf_dir):
    return release.client_urls(table(spark, sf_dir, "pages").select(F.col("page_id").alias("key"), "url"))


@query(
    "single_line_bounds",
    """SELECT rule, CAST(conv_id AS VARCHAR) || '/' || turn AS key, '' AS detail FROM (SELECT 'text_bounds' AS rule, conv_id, turn FROM conversations WHERE length(trim(text)) = 0 OR length(text) > 200 UNION ALL SELECT 'text_lines', conv_id, turn FROM conversations WHERE regexp_matches(text, '[\\x00-\\x1f\\x7f]'))""",
)
def single_line_bounds(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("key"), "text")
    return release.single_line(rows, {"text": 200})


@query(
    "entity_index",
    f"""WITH {ITM}, i AS (SELECT CASE WHEN l_orderkey % 50 = 1 THEN 'vod' || substr(entity_id, 5) ELSE entity_id END AS entity_id, l_orderkey FROM itm)
SELECT 'foreign_prefix' AS rule, entity_id AS key, '' AS detail FROM i WHERE l_orderkey % 50 = 1 UNION ALL SELECT 'repeated_entity', entity_id, CAST(count(*) AS VARCHAR) FROM i GROUP BY entity_id HAVING count(*) > 1""",
)
def entity_index(spark, sf_dir):
    rows = items(spark, sf_dir)
    return release.entity_index(rows.withColumn("entity_id", F.when(F.col("l_orderkey") % 50 == 1, F.concat(F.lit("vod"), F.expr("substr(entity_id, 5)"))).otherwise(F.col("entity_id"))))


@query(
    "report_audit",
    f"""WITH {ITM}, d AS (SELECT source_id, technical_status, count(*) AS n FROM itm GROUP BY ALL) SELECT 'count_differs' AS rule, source_id || ':' || technical_status AS key, CAST(n AS VARCHAR) AS detail FROM d WHERE length(source_id) = 2 AND technical_status <> 'dead' OR technical_status = 'dead'
UNION ALL SELECT 'count_differs', 's-:dead', '0'""",
)
def report_audit(spark, sf_dir):
    rows = items(spark, sf_dir)
    claimed = rows.where("technical_status <> 'dead'").groupBy("source_id", "technical_status").agg((F.count("*") + F.max(F.when(F.length("source_id") == 2, 1).otherwise(0))).alias("n"))
    return release.report_audit(claimed.unionByName(spark.createDataFrame([("s-", "dead", 3)], "source_id string, technical_status string, n long")), rows)


@query(
    "deletion_scope",
    """WITH c AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS r FROM orders WHERE o_orderstatus = 'P' AND month(o_orderdate) <> 3), s AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS r FROM orders WHERE month(o_orderdate) <> 5), a AS (SELECT max(strftime(o_orderdate, '%Y-%m')) AS r FROM orders)
SELECT 'not_scanned' AS rule, r AS key, '' AS detail FROM c WHERE r NOT IN (SELECT r FROM s) UNION ALL SELECT 'not_claimed', r, '' FROM s WHERE r NOT IN (SELECT r FROM c) UNION ALL SELECT 'active_release', r, '' FROM c WHERE r IN (SELECT r FROM a)""",
)
def deletion_scope(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", F.month("o_orderdate").alias("m"), F.date_format("o_orderdate", "yyyy-MM").alias("release"))
    return release.deletion_scope(orders.where("o_orderstatus = 'P' and m <> 3"), orders.where("m <> 5"), orders.agg(F.max("release").alias("release")))


@query(
    "absent_paths",
    f"""WITH f AS ({_FILES} WHERE text IS NOT NULL) SELECT 'still_present' AS rule, path AS key, '' AS detail FROM f WHERE doc_id % 6 = 0 UNION ALL SELECT 'receipt_too_long', '*', CAST(count(*) AS VARCHAR) FROM f WHERE doc_id % 2 = 0 HAVING count(*) > 10""",
)
def absent_paths(spark, sf_dir):
    files = _files(spark, sf_dir)
    return release.absent_paths(files.where("doc_id % 2 = 0"), files.where("doc_id % 3 = 0"), 10)


@query(
    "forbidden_text_scan",
    """WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS path, unnest(list_distinct(regexp_extract_all(text, '[a-z]{9,}'))) AS value FROM documents), w AS (SELECT DISTINCT value FROM t WHERE path LIKE '%7')
SELECT 'forbidden_value' AS rule, path AS key, value AS detail FROM t WHERE value IN (SELECT value FROM w)""",
)
def forbidden_text_scan(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "text")
    wanted = files.where("path like '%7'").select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{9,}"), F.lit(0))).alias("value"))
    return release.text_scan(files, wanted, "[a-z]{9,}")


@query(
    "changed_beyond_scope",
    f"""WITH f AS ({_FILES} WHERE text IS NOT NULL), b AS (SELECT path, h FROM f WHERE doc_id % 10 <> 1), a AS (SELECT path, CASE WHEN doc_id % 10 = 2 THEN 'x' ELSE h END AS h FROM f WHERE doc_id % 10 <> 3)
SELECT 'changed_path' AS rule, coalesce(a.path, b.path) AS key, CASE WHEN a.path IS NULL THEN 'missing' WHEN b.path IS NULL THEN 'undeclared' ELSE 'changed' END AS detail FROM a FULL JOIN b ON a.path = b.path WHERE a.h IS DISTINCT FROM b.h AND coalesce(a.path, b.path) NOT IN ('src0/1', 'src1/2', 'src2/3')""",
)
def changed_beyond_scope(spark, sf_dir):
    files = _files(spark, sf_dir)
    after = files.where("doc_id % 10 <> 3").withColumn("sha256", F.when(F.col("doc_id") % 10 == 2, "x").otherwise(F.col("sha256")))
    return release.changed_beyond(files.where("doc_id % 10 <> 1"), after, ["src0/1", "src1/2", "src2/3"])


@query(
    "rollback_target",
    """WITH r AS (SELECT year(o_orderdate) AS release, CASE WHEN year(o_orderdate) % 3 = 0 THEN 'failed' ELSE 'success' END AS status FROM orders GROUP BY 1), h AS (SELECT year(o_orderdate) AS release, count(*) AS n FROM orders WHERE o_totalprice > 499900 GROUP BY 1)
SELECT rule, CAST(release AS VARCHAR) AS key, CAST(coalesce(n, 0) AS VARCHAR) AS detail FROM (SELECT 'not_success' AS rule, release, n FROM r LEFT JOIN h USING (release) WHERE status <> 'success' UNION ALL SELECT 'holds_mandatory_removal', release, n FROM r JOIN h USING (release))""",
)
def rollback_target(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("release"), "o_totalprice")
    known = orders.select("release").distinct().withColumn("status", F.when(F.col("release") % 3 == 0, "failed").otherwise("success"))
    return release.rollback_target(known, orders.where("o_totalprice > 499900"))


def _side(spark, sf_dir, year):
    df = table(spark, sf_dir, "orders").where(F.year("o_orderdate") == year).groupBy(F.col("o_custkey").alias("source_id"))
    return df.agg(F.when(F.max("o_totalprice") > 300000, "healthy").otherwise("partial").alias("technical"), F.when(F.min("o_orderstatus") == "F", "stable").otherwise("experimental").alias("publication"), F.lit("verified").alias("rights"))


_SIDE = "SELECT o_custkey AS source_id, max(o_totalprice) > 300000 AS t, min(o_orderstatus) = 'F' AS p FROM orders WHERE year(o_orderdate) = {0} GROUP BY 1"


@query(
    "rollback_change_rows",
    f"""WITH b AS ({_SIDE.format(1996)}), a AS ({_SIDE.format(1995)}) SELECT coalesce(b.source_id, a.source_id) AS source_id, CASE WHEN b.source_id IS NULL THEN 'new' WHEN a.source_id IS NULL THEN 'removed' WHEN (a.t AND NOT b.t) OR (a.p AND NOT b.p) THEN 'recovered' WHEN (b.t AND NOT a.t) OR (b.p AND NOT a.p) THEN 'degraded' ELSE 'unchanged' END AS category
FROM b FULL JOIN a ON b.source_id = a.source_id""",
)
def rollback_change_rows(spark, sf_dir):
    return release.change_rows(_side(spark, sf_dir, 1996), _side(spark, sf_dir, 1995))


@query(
    "alias_hashes",
    """WITH f AS (SELECT 'src' || n_nationkey AS path, sha256(n_name) AS h FROM nation), al AS (SELECT 'a' || n_regionkey AS alias, 'src' || min(n_nationkey) AS path FROM nation GROUP BY n_regionkey)
SELECT 'unknown_alias' AS rule, alias AS key, '' AS detail FROM al WHERE alias NOT IN ('a0', 'a1', 'a7') UNION ALL SELECT 'alias_missing', 'a7', '' UNION ALL SELECT 'alias_bytes_differ', alias, '' FROM al WHERE alias <> 'a1'""",
)
def alias_hashes(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    files = nation.select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("path"), F.sha2("n_name", 256).alias("sha256"))
    aliases = nation.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("n")).select(F.concat(F.lit("a"), F.col("n_regionkey").cast("string")).alias("alias"), F.concat(F.lit("src"), F.col("n").cast("string")).alias("path"))
    copies = aliases.where("alias = 'a1'").join(files, "path").select(F.col("alias").alias("path"), "sha256")
    return release.alias_hashes(aliases, files.unionByName(copies), ["a0", "a1", "a7"])


@query(
    "playlist_rules",
    """WITH t AS (SELECT page_id AS file, url, page_id % 9 = 1 AS bad, page_id % 20 = 3 AS odd, page_id % 5 = 2 AS twice FROM pages)
SELECT rule, key, detail FROM (SELECT 'bad_head' AS rule, file || ':0' AS key, '' AS detail FROM t WHERE file % 30 = 4 UNION ALL SELECT 'bad_directive', file || ':1', '' FROM t WHERE bad UNION ALL SELECT 'refused_url', file || ':2', '' FROM t WHERE url LIKE 'http://%'
UNION ALL SELECT 'refused_url', file || ':4', '' FROM t WHERE twice AND url LIKE 'http://%' UNION ALL SELECT 'unpaired', CAST(file AS VARCHAR), '' FROM t WHERE odd UNION ALL SELECT 'repeated_url', CAST(file AS VARCHAR), url FROM t WHERE twice)""",
)
def playlist_rules(spark, sf_dir):
    k = F.col("page_id")
    info = F.lit('#EXTINF:-1 tvg-id="a" group-title="b",name')
    lines = F.array(F.when(k % 30 == 4, "#EXTM3U8").otherwise("#EXTM3U"), F.when(k % 9 == 1, "#EXTINF:0,x").otherwise(info), F.col("url"))
    more = F.when(k % 5 == 2, F.array(info, F.col("url"))).otherwise(F.array().cast("array<string>"))
    tail = F.when(k % 20 == 3, F.array(info)).otherwise(F.array().cast("array<string>"))
    rows = table(spark, sf_dir, "pages").select(k.cast("string").alias("file"), F.posexplode(F.concat(lines, more, tail)).alias("number", "line"))
    return release.playlist_rules(rows)


@query(
    "release_transitions",
    """WITH r AS (SELECT o_custkey AS line, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + CASE WHEN o_orderkey % 15 = 2 THEN 100000 ELSE 0 END AS g, CASE WHEN o_orderkey % 6 = 1 THEN 'rollback' ELSE 'regular' END AS kind, CAST(o_orderkey AS VARCHAR) AS head FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders)),
w AS (SELECT *, lag(g) OVER (PARTITION BY line ORDER BY g) AS bg, lag(head) OVER (PARTITION BY line ORDER BY g) AS bh FROM r)
SELECT rule, line || ':' || g AS key, '' AS detail FROM (SELECT 'generation_gap' AS rule, line, g FROM w WHERE bg IS NOT NULL AND g <> bg + 1 UNION ALL SELECT 'wrong_parent', line, g FROM w WHERE bh IS NOT NULL UNION ALL SELECT 'rollback_without_release', line, g FROM w WHERE bg IS NULL AND kind = 'rollback')""",
)
def release_transitions(spark, sf_dir):
    from pyspark.sql.window import Window

    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("line"), F.col("o_orderkey").alias("k")).distinct()
    place = F.row_number().over(Window.partitionBy("line").orderBy("k"))
    rows = orders.select(
        "line", (place + F.when(F.col("k") % 15 == 2, 100000).otherwise(0)).alias("generation"), F.when(F.col("k") % 6 == 1, "rollback").otherwise("regular").alias("kind"),
        F.col("k").cast("string").alias("head"), F.lit(None).cast("string").alias("previous"),
    )
    return release.transitions(rows)


@query("taken_down_sources", f"WITH {SRC} SELECT source_id, CASE WHEN s_acctbal < 0 THEN 'takedown' ELSE rights_status END AS rights_status FROM src")
def taken_down_sources(spark, sf_dir):
    src = sources(spark, sf_dir)
    return rebuild.taken_down(src, src.where("s_acctbal < 0")).select("source_id", "rights_status")


@query(
    "previous_sources",
    f"""WITH {SRC} SELECT source_id, CASE WHEN k % 3 = 0 AND k % 4 <> 0 THEN 'vod_config' WHEN k % 4 = 0 AND k % 3 <> 0 THEN 'live_playlist' END AS kind, CASE WHEN k % 10 <> 9 THEN mode END AS fetch_mode, CASE WHEN k % 13 <> 4 THEN rights_status END AS rights_status,
CASE WHEN k % 10 = 9 THEN 'no_upstream' WHEN k % 13 = 4 THEN 'no_health' WHEN (k % 3 = 0) = (k % 4 = 0) THEN 'ambiguous_kind' END AS error FROM src""",
)
def previous_sources(spark, sf_dir):
    src = sources(spark, sf_dir)
    index = src.select("source_id", F.when(F.col("k") % 4 == 0, 2).otherwise(0).alias("live_lines"))
    claimed, health = src.where("k % 10 <> 9").select("source_id", F.col("mode").alias("fetch_mode")), src.where("k % 13 <> 4").select("source_id", "rights_status")
    return rebuild.previous_sources(index, claimed, health, src.where("k % 3 = 0").select("source_id"))


@query(
    "previous_vod",
    """SELECT 'vod:' || p_partkey AS entity_id, p_brand AS source_id, p_size AS type, p_type AS api, CASE WHEN s THEN 'healthy' ELSE 'partial' END AS technical_status, CASE WHEN s THEN 'stable' ELSE 'experimental' END AS publication_status, s AS media_probe
FROM (SELECT *, (p_size, p_type) IN (SELECT (p_size, p_type) FROM part WHERE p_partkey % 5 = 0) AS s FROM part WHERE p_partkey % 8 <> 3)""",
)
def previous_vod(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    sites = part.select(F.concat(F.lit("vod:"), F.col("p_partkey").cast("string")).alias("entity_id"), F.col("p_brand").alias("source_id"), F.col("p_size").alias("type"), F.col("p_type").alias("api"), "p_partkey")
    return rebuild.previous_vod(sites, sites.where("p_partkey % 5 = 0"), sites.where("p_partkey % 8 = 3"))


@query(
    "previous_live",
    """WITH l AS (SELECT url, count(*) AS n, min('n' || page_id) AS name FROM pages WHERE page_id % 6 <> 2 GROUP BY url), i AS (SELECT page_id, 'p' || page_id % 10 AS source_id, url, 'live-url:p' || page_id % 10 || ':' || substr(sha256(url), 1, 16) || CASE WHEN page_id % 12 = 5 THEN 'x' ELSE '' END AS entity_id FROM pages)
SELECT entity_id, source_id, i.url, CASE WHEN n = 1 THEN name END AS name, CASE WHEN page_id % 12 = 5 THEN 'id_differs' WHEN n IS NULL THEN 'no_line' WHEN n > 1 THEN 'ambiguous_line' END AS error FROM i LEFT JOIN l ON i.url = l.url""",
)
def previous_live(spark, sf_dir):
    from siftspark.functions import ids

    pages, k = table(spark, sf_dir, "pages"), F.col("page_id")
    owner = F.concat(F.lit("p"), (k % 10).cast("string"))
    rows = pages.select(F.concat(ids.live_url_id(owner, F.col("url")), F.when(k % 12 == 5, "x").otherwise("")).alias("entity_id"), owner.alias("source_id"), "url")
    return rebuild.previous_live(rows, pages.where("page_id % 6 <> 2").select("url", F.concat(F.lit("n"), k.cast("string")).alias("name")))


@query(
    "upstream_audit",
    f"""WITH {SRC}, o AS (SELECT source_id, true AS observed, CASE WHEN k % 4 = 0 THEN url END AS u, CASE WHEN k % 5 = 0 THEN revision END AS r FROM src WHERE k % 9 <> 1),
j AS (SELECT source_id, mode, k, url, CASE WHEN k % 8 <> 5 THEN revision END AS reviewed, observed, u, CASE WHEN mode <> 'direct_url' THEN coalesce(r, CASE WHEN k % 8 <> 5 THEN revision END) END AS rev FROM src LEFT JOIN o USING (source_id) WHERE enabled),
f AS (SELECT *, coalesce(u, CASE WHEN mode = 'direct_url' THEN url WHEN k % 2 = 0 THEN 'https://raw.example.com/o/r/' || rev || '/a%20b/c.json' ELSE 'https://raw.example.com/o/r/tree/' || rev END) AS full_url FROM j)
SELECT source_id, mode AS fetch_mode, reviewed AS reviewed_revision, rev AS resolved_revision, full_url AS resolved_fetch_url, CASE WHEN observed IS NULL THEN 'missing_observation' WHEN mode <> 'direct_url' AND rev IS NULL THEN 'no_revision' WHEN full_url IS NULL THEN 'no_url' END AS error FROM f""",
)
def upstream_audit(spark, sf_dir):
    src, k = sources(spark, sf_dir), F.col("k")
    known = src.select(
        "source_id", "enabled", "mode", F.when(k % 8 != 5, F.col("revision")).alias("reviewed_revision"), F.col("url").alias("reviewed_url"), F.lit("o/r").alias("repository"),
        F.when(k % 2 == 0, "a b/c.json").alias("config_path"),
    )
    seen = src.where("k % 9 <> 1").select("source_id", F.lit(True).alias("observed"), F.when(k % 4 == 0, F.col("url")).alias("resolved_fetch_url"), F.when(k % 5 == 0, F.col("revision")).alias("resolved_revision"))
    return rebuild.upstream_audit(known, seen, "https://raw.example.com")


_FAIL = "CASE event_type WHEN 'error' THEN 'private_address_rejected' WHEN 'view' THEN 'fetch_timeout' WHEN 'signup' THEN 'terms_changed' END"


def _failures(spark, sf_dir):
    event = F.col("event_type")
    why = F.when(event == "error", "private_address_rejected").when(event == "view", "fetch_timeout").when(event == "signup", "terms_changed")
    return table(spark, sf_dir, "events").select("event_id", "user_id", why.alias("failure_reason"))


@query(
    "entity_failure_reasons",
    f"WITH f AS (SELECT event_id, {_FAIL} AS failure_reason FROM events) SELECT CASE event_id % 3 WHEN 0 THEN 'discarded' WHEN 1 THEN 'vod' ELSE 'live' END AS kind, failure_reason, count(*) AS n FROM f WHERE failure_reason IS NOT NULL GROUP BY ALL",
)
def entity_failure_reasons(spark, sf_dir):
    rows = _failures(spark, sf_dir)
    return rebuild.failure_reasons(*[rows.where(f"event_id % 3 = {i}") for i in range(3)]).groupBy("kind", "failure_reason").agg(F.count("*").alias("n"))


@query(
    "gate_payload",
    "SELECT 'regular' AS release_kind, count(*) <= 5 AS publish, CASE WHEN count(*) > 5 THEN 'too_many' ELSE '' END AS reasons, count(*) AS previous, count(*) FILTER (o_orderstatus = 'F') AS current, 5 AS least FROM orders",
)
def gate_payload(spark, sf_dir):
    facts = table(spark, sf_dir, "orders").agg(F.count("*").alias("previous"), F.count_if(F.col("o_orderstatus") == "F").alias("current"), F.lit(5).alias("least"))
    decided = facts.withColumn("reasons", F.when(F.col("previous") > 5, F.array(F.lit("too_many"))).otherwise(F.array().cast("array<string>"))).withColumn("release_kind", F.lit("regular"))
    return rebuild.gate_payload(decided, ["previous", "current"], ["least"]).select("release_kind", "publish", F.array_join("reasons", ",").alias("reasons"), "inputs.*", "thresholds.*")


@query(
    "retained_ids",
    f"WITH {ITM} SELECT DISTINCT entity_id AS id FROM itm WHERE l_orderkey % 4 <> 1 AND entity_id NOT IN (SELECT entity_id FROM itm WHERE technical_status = 'dead') AND entity_id NOT IN (SELECT entity_id FROM itm WHERE l_suppkey % 5 = 2)",
)
def retained_ids(spark, sf_dir):
    rows = items(spark, sf_dir).withColumnRenamed("entity_id", "id")
    return rebuild.retained(rows.where("l_orderkey % 4 <> 1"), rows.where("technical_status = 'dead'"), rows.where("l_suppkey % 5 = 2"))


_MAND = f"""{SRC}, {ITM}, p AS (SELECT source_id, entity_id, l_orderkey FROM itm WHERE l_orderkey % 10 = 0 AND l_suppkey % 4 <> 3), r AS (SELECT source_id FROM src WHERE rights_status IN ('takedown', 'restricted') AND k % 12 = 3), f AS (SELECT source_id, CASE WHEN k % 2 = 0 THEN 'terms_changed' ELSE 'private_address_rejected' END AS reason FROM src WHERE k % 25 = 4 OR k % 25 = 9),
w AS (SELECT source_id, bool_or(h) AS h FROM (SELECT source_id, true AS h FROM r UNION ALL SELECT source_id, reason <> 'terms_changed' FROM f) GROUP BY 1), ws AS (SELECT * FROM w WHERE source_id IN (SELECT source_id FROM p)),
m AS (SELECT id, bool_or(h) AS historical FROM (SELECT 'source:' || source_id AS id, h FROM ws UNION ALL SELECT entity_id, false FROM p WHERE source_id IN (SELECT source_id FROM ws) UNION ALL SELECT entity_id, true FROM p WHERE entity_id IN (SELECT entity_id FROM itm WHERE technical_status = 'dead' AND l_orderkey % 20 = 0)) GROUP BY 1)"""


def _mandatory(spark, sf_dir):
    src, rows, k = sources(spark, sf_dir), items(spark, sf_dir), F.col("k")
    failures = src.where("k % 25 in (4, 9)").select("source_id", F.when(k % 2 == 0, "terms_changed").otherwise("private_address_rejected").alias("failure_reason"))
    unsafe = rows.where("technical_status = 'dead' and l_orderkey % 20 = 0").select("entity_id", F.lit("dangerous_scheme_rejected").alias("failure_reason"))
    previous = rows.where("l_orderkey % 10 = 0 and l_suppkey % 4 <> 3").select("source_id", "entity_id")
    return rebuild.mandatory_removals(previous, src.where("rights_status in ('takedown', 'restricted') and k % 12 = 3"), failures, unsafe)


@query("mandatory_removals", f"WITH {_MAND} SELECT id, historical FROM m")
def mandatory_removals(spark, sf_dir):
    return _mandatory(spark, sf_dir)


@query("removal_leaks", f"WITH {_MAND} SELECT id FROM m WHERE id IN (SELECT 'source:' || source_id FROM src WHERE k % 2 = 1) OR id IN (SELECT entity_id FROM itm WHERE l_suppkey % 3 = 1)")
def removal_leaks(spark, sf_dir):
    return rebuild.removal_leaks(_mandatory(spark, sf_dir), sources(spark, sf_dir).where("k % 2 = 1"), items(spark, sf_dir).where("l_suppkey % 3 = 1"))


@query(
    "claims_not_reproduced",
    f"WITH {SRC} SELECT 'claim_not_reproduced' AS rule, source_id AS key, '' AS detail FROM src WHERE k % 3 = 0 AND NOT s_acctbal < 3000",
)
def claims_not_reproduced(spark, sf_dir):
    src = sources(spark, sf_dir)
    return release.claims_not_reproduced(src.where("k % 3 = 0").select("source_id"), src.where("s_acctbal < 3000"), ["source_id"])


@query(
    "tree_paths",
    """WITH t AS (SELECT source, count(*) AS n, bool_or(doc_id % 400 = 1) AS cut, list_sort(list('d/' || doc_id || '.json')) AS paths FROM documents GROUP BY source) SELECT source AS source_id, CASE WHEN cut THEN 'catalog_limit_exceeded' END AS failure_reason, i - 1 AS ordinal, CASE WHEN NOT cut THEN paths[i] END AS path
FROM t, unnest(generate_series(1, CASE WHEN cut THEN 1 ELSE n END)) AS g(i) WHERE NOT cut UNION ALL SELECT source, 'catalog_limit_exceeded', NULL, NULL FROM t WHERE cut""",
)
def tree_paths(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    entry = F.struct(F.concat(F.lit("d/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("path"), F.lit("blob").alias("type"), F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 40).alias("sha"))
    other = F.struct(F.lit("d").alias("path"), F.lit("tree").alias("type"), F.lit("0" * 40).alias("sha"))
    trees = docs.groupBy(F.col("source").alias("source_id")).agg(F.to_json(F.struct(F.concat(F.collect_list(entry), F.array(other)).alias("tree"), F.bool_or(F.col("doc_id") % 400 == 1).alias("truncated"))).alias("body"))
    return rebuild.tree_paths(trees)


@query(
    "commit_facts",
    f"WITH {SRC} SELECT source_id, CASE WHEN revision IS NOT NULL AND k % 6 <> 2 THEN revision END AS sha, CASE WHEN revision IS NOT NULL AND k % 6 <> 2 THEN substr(sha256(source_id), 1, 40) END AS tree FROM src",
)
def commit_facts(spark, sf_dir):
    src = sources(spark, sf_dir)
    tree = F.when(F.col("k") % 6 == 2, "short").otherwise(F.substring(F.sha2("source_id", 256), 1, 40))
    body = F.to_json(F.struct(F.col("revision").alias("sha"), F.struct(F.struct(tree.alias("sha")).alias("tree")).alias("commit")))
    return src.select("source_id", rebuild.commit_facts(body).alias("c")).select("source_id", "c.sha", "c.tree")


@query(
    "security_paths",
    """SELECT page_id, '/' || regexp_extract(url, '^[a-z]+://[^/?#]*/([^/?#]*)', 1) || '/end' AS path FROM pages""",
)
def security_paths(spark, sf_dir):
    first = F.element_at(F.split(urls.part(F.col("url"), 3), "/"), 2)
    path = F.concat(F.lit("//./x/%2e%2E/"), first, F.lit("/gone/../end/"))
    return table(spark, sf_dir, "pages").select("page_id", urls.security_path(path).alias("path"))


@query(
    "http_exceptions",
    """SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) = (SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) FROM pages WHERE page_id = 0) AND url LIKE 'http://%' AND starts_with(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/es') AS allowed FROM pages""",
)
def http_exceptions(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    reviewed = pages.where("page_id = 0").agg(F.min(urls.host(F.col("url")))).first()[0]
    exceptions = F.array(F.struct(F.lit(reviewed).alias("host"), F.lit(80).alias("port"), F.lit("/x/../es").alias("path_prefix")))
    return pages.select("page_id", urls.http_allowed(F.col("url"), exceptions).alias("allowed"))


@query(
    "same_repository_paths",
    f"WITH {SRC} SELECT source_id, CASE WHEN k % 5 <> 3 AND k % 4 <> 1 THEN 'a b/' || k || '.json' END AS path FROM src WHERE revision IS NOT NULL",
)
def same_repository_paths(spark, sf_dir):
    src, k = sources(spark, sf_dir).where("revision is not null"), F.col("k")
    file = F.concat(F.lit("/a%20b/"), k.cast("string"), F.lit(".json"))
    owner = F.when(k % 4 == 1, "o/other").otherwise("o/r")
    raw, page = (F.concat(F.lit(h), owner, F.lit(m), F.when(k % 5 == 3, "main").otherwise(F.col("revision")), file) for h, m in (("https://raw.example.com/", "/"), ("https://www.example.com/", "/blob/")))
    url = F.when(k % 2 == 0, raw).otherwise(page)
    return src.select("source_id", urls.same_repository_path(url, F.lit("o/r"), F.col("revision"), "raw.example.com", "www.example.com").alias("path"))


@query("other_release_links", f"WITH {SRC} SELECT source_id, CASE WHEN k % 3 = 0 THEN url ELSE 'https://r.example.com/releases/g00000009/configs/' || source_id || '.json' END AS url FROM src")
def other_release_links(spark, sf_dir):
    src = sources(spark, sf_dir)
    link = F.when(F.col("k") % 3 == 0, F.col("url")).otherwise(F.concat(F.lit("https://r.example.com/releases/g00000001/configs/"), "source_id", F.lit(".json")))
    return src.select("source_id", urls.other_release(link, F.lit("g00000009")).alias("url"))



_KINDS = [*policy.ERROR_REASONS, "Unheard"]


@query(
    "error_text_reasons",
    f"""SELECT event_id, CASE WHEN event_type = 'error' AND {_list(_KINDS)}[event_id % 11 + 1] IN ('SecretInHeader', 'MalformedHeader') THEN 'private_address_rejected' ELSE {_list([*policy.ERROR_REASONS.values(), "fetch_timeout"])}[event_id % 11 + 1] END AS reason FROM events""",
)
def error_text_reasons(spark, sf_dir):
    """The failures that typed errors are; errors of the events' own kind stand for upstream fetches."""
    return table(spark, sf_dir, "events").select("event_id", policy.reason_of_error(_pick(_KINDS, F.col("event_id")), F.col("event_type") == "error").alias("reason"))


@query(
    "retry_delays",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 3 = 2 THEN NULL WHEN event_id % 4 = 0 THEN 30.0 WHEN event_id % 4 = 1 THEN NULL WHEN event_id % 4 = 2 THEN 45.0 ELSE pow(2.0, event_id % 3) END AS delay FROM events""",
)
def retry_delays(spark, sf_dir):
    k, now = F.col("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    after = F.when(k % 4 == 0, " 30 ").when(k % 4 == 1, "61").when(k % 4 == 2, "Mon, 01 Jan 2024 00:00:45 GMT")
    status = F.when(k % 5 == 0, 404).when(k % 2 == 0, 429).otherwise(503)
    return table(spark, sf_dir, "events").select("event_id", policy.retry_delay(status, k % 3 + 1, after, now).alias("delay"))
