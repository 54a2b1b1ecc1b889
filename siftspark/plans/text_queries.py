"""Queries of URLs, texts, statuses and schedules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftspark import schemas as S
from siftspark.functions import policy, urls
from siftspark.operators import parse
from siftspark.plans.registry import query
from siftspark.session import table


def _list(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url")


#: Further URLs for rules that the table's URLs don't exercise.
LITERALS = [
    (-1, "HTTPS://EX.Example.test:443/A/B?x=1#f"), (-2, "http://a.example.test:8080/p?token=1&b=2"), (-3, "https://a.example.test/x.jar?y=1"),
    (-4, "https://a.example.test/spider.py"), (-5, "https://a.example.test/?api_key=1&Sign=2&q=a+b"), (-6, "https://a.example.test."),
]
_LITERALS = ", ".join(f"({i}, '{u}')" for i, u in LITERALS)
_U = f"u AS (SELECT page_id, url FROM pages UNION ALL SELECT * FROM (VALUES {_LITERALS}) t(page_id, url))"


def _urls(spark, sf_dir):
    return _pages(spark, sf_dir).unionByName(spark.createDataFrame(LITERALS, "page_id long, url string"))


_PARTS = r"""p AS (SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS authority,
 regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS q FROM u),
h AS (SELECT *, lower(regexp_replace(regexp_replace(authority, ':[0-9]*$', ''), '\.+$', '')) AS host, CASE WHEN regexp_matches(authority, ':[0-9]+$') THEN CAST(regexp_extract(authority, ':([0-9]+)$', 1) AS INTEGER) WHEN scheme = 'https' THEN 443 ELSE 80 END AS port FROM p)"""


@query(
    "url_host_port_normalise",
    f"""WITH {_U}, {_PARTS} SELECT page_id, scheme, host, port, scheme || '://' || host || CASE WHEN (scheme = 'https' AND port = 443) OR (scheme = 'http' AND port = 80) THEN '' ELSE ':' || port END || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS normal FROM h""",
)
def url_host_port_normalise(spark, sf_dir):
    u = F.col("url")
    return _urls(spark, sf_dir).select("page_id", urls.scheme(u).alias("scheme"), urls.host(u).alias("host"), urls.port(u).alias("port"), urls.normal_url(u).alias("normal"))


_STAND_IN = ["utmsource", "page", *S.SENSITIVE_KEYS]


@query(
    "sensitive_query_keys",
    f"""WITH {_U}, {_PARTS} SELECT page_id, coalesce(array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(q, '&'), lambda x: replace(replace(lower(string_split(x, '=')[1]), '_', ''), '-', '')), lambda k: k IN {_list(_STAND_IN)}))), ','), '') AS keys FROM h""",
)
def sensitive_query_keys(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", F.array_join(urls.rejected_keys(F.col("url"), _STAND_IN), ",").alias("keys"))


@query(
    "url_redaction",
    f"""WITH {_U}, {_PARTS} SELECT page_id, regexp_extract(url, '^([A-Za-z]+)://', 1) || '://' || authority || path || CASE WHEN q <> '' THEN '?' || array_to_string(list_transform(string_split(q, '&'), lambda x: string_split(x, '=')[1] || '=<redacted>'), '&') ELSE '' END AS safe FROM h""",
)
def url_redaction(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", urls.redacted(F.col("url")).alias("safe"))


@query(
    "request_url_rewrite",
    f"""WITH {_U}, {_PARTS} SELECT page_id, regexp_extract(url, '^([A-Za-z]+)://', 1) || '://' || authority || path || '?' || array_to_string(list_concat(list_filter(string_split(q, '&'), lambda x: x <> '' AND lower(string_split(x, '=')[1]) NOT IN ('ac', 'page', 'pg')), ['ac=list', 'pg=1']), '&') AS request FROM h""",
)
def request_url_rewrite(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", urls.rewritten(F.col("url"), ["ac", "page", "pg"], {"ac": "list", "pg": "1"}).alias("request"))


@query(
    "url_structural_reason",
    f"""WITH {_U}, {_PARTS} SELECT page_id, CASE WHEN scheme NOT IN ('http', 'https') THEN 'dangerous_scheme_rejected' WHEN len(list_filter(list_transform(string_split(q, '&'), lambda x: replace(replace(lower(string_split(x, '=')[1]), '_', ''), '-', '')), lambda k: k IN {_list(S.SENSITIVE_KEYS)})) > 0 THEN 'credential_query_rejected' WHEN scheme = 'http' THEN 'client_http_disallowed' END AS reason FROM h""",
)
def url_structural_reason(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", urls.structural_reason(F.col("url")).alias("reason"))


@query(
    "executable_suffix_reject",
    rf"""WITH {_U} SELECT page_id, regexp_matches(lower(url), '\.(jar|js|py|dex|so)($|[?#])') AS executable, regexp_matches(lower(url), '\.html($|[?#])') AS page FROM u""",
)
def executable_suffix_reject(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", urls.executable(F.col("url")).alias("executable"), F.col("url").rlike(r"(?i)\.html($|[?#])").alias("page"))


@query("denied_category_subtraction", "SELECT p_brand, coalesce(string_agg(DISTINCT p_type, ',' ORDER BY p_type) FILTER (p_type NOT IN ('ECONOMY', 'PROMO')), '') AS categories FROM part GROUP BY p_brand")
def denied_category_subtraction(spark, sf_dir):
    kept = F.array_sort(F.array_except(F.collect_set("p_type"), F.array(F.lit("ECONOMY"), F.lit("PROMO"))))
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(kept, ",").alias("categories"))


@query(
    "warning_prefix_once",
    "SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN '⚠️ ' || s_name ELSE s_name END AS name FROM supplier",
)
def warning_prefix_once(spark, sf_dir):
    times = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("⚠️ ⚠️"), "s_name")).when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("⚠️"), "s_name")).otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", policy.warned(times, F.col("s_acctbal") < 0).alias("name"))


@query(
    "carry_forward_group",
    """WITH l AS (SELECT conv_id, turn, role, text, CASE WHEN role = 'user' THEN substr(text, 1, 12) END AS g FROM conversations)
SELECT conv_id, turn, last_value(g IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS grp FROM l""",
)
def carry_forward_group(spark, sf_dir):
    df = table(spark, sf_dir, "conversations").withColumn("g", F.when(F.col("role") == "user", F.substring("text", 1, 12)))
    return df.select("conv_id", "turn", F.last("g", ignorenulls=True).over(Window.partitionBy("conv_id").orderBy("turn")).alias("grp"))


_LINE = "'a$https://h.test/' || turn || '#b$https://h.test/b' || CASE WHEN turn % 3 = 0 THEN '#' ELSE '' END || CASE WHEN turn % 2 = 0 THEN '$$$c$https://h.test/c' ELSE '' END"


@query(
    "nested_split_playlines",
    f"""WITH l AS (SELECT conv_id, turn, string_split({_LINE}, '$$$') AS lines FROM conversations),
e AS (SELECT conv_id, turn, unnest(lines) AS line, generate_subscripts(lines, 1) AS k FROM l), s AS (SELECT conv_id, turn, k, unnest(list_filter(string_split(line, '#'), lambda x: x <> '')) AS ep FROM e)
SELECT conv_id, turn, k AS line, count(*) AS episodes, min(substr(ep, strpos(ep, '$') + 1)) AS first_url FROM s GROUP BY ALL""",
)
def nested_split_playlines(spark, sf_dir):
    turn = F.col("turn").cast("string")
    line = F.concat(F.lit("a$https://h.test/"), turn, F.lit("#b$https://h.test/b"), F.when(F.col("turn") % 3 == 0, "#").otherwise(""), F.when(F.col("turn") % 2 == 0, "$$$c$https://h.test/c").otherwise(""))
    df = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(parse.play_lines(line)).alias("k", "episodes"))
    return df.select("conv_id", "turn", (F.col("k") + 1).cast("long").alias("line"), F.size("episodes").cast("long").alias("episodes"), F.array_min(F.transform("episodes", lambda e: e["url"])).alias("first_url"))


@query("json_pointer_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_pointer_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", parse.pointer(F.col("props"), "/k").cast("int").alias("k"), parse.pointer(F.col("props"), "/missing").alias("missing"))


@query(
    "html_error_sniff",
    """SELECT page_id, regexp_matches(lower(substr(html, 1, 16384)), '<html|<!doctype html') AND regexp_matches(lower(substr(html, 1, 16384)), 'captcha|access denied|404 not found|track\\(3') AS error_page FROM pages""",
)
def html_error_sniff(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", parse.html_error(F.col("html"), ["captcha", "access denied", "404 not found", "track\\(3"]).alias("error_page"))


def _cross(spark, **columns):
    out = None
    for name, values in columns.items():
        df = spark.createDataFrame([(v,) for v in values], f"{name} {'int' if isinstance(values[0], int) else 'string'}")
        out = df if out is None else out.join(F.broadcast(df), F.lit(True))  # fixed lists, a few hundred rows in all
    return out


_CODES = [200, 302, 401, 403, 404, 408, 410, 429, 500, 503, 599, 600]


@query(
    "http_status_reason",
    f"""SELECT status, context, CASE WHEN status IN (401, 403) THEN 'credential_required' WHEN status = 404 THEN 'http_404' WHEN status = 410 THEN 'http_410' WHEN status = 408 AND context = 'upstream' THEN 'fetch_timeout' WHEN status = 429 THEN 'rate_limited' WHEN status BETWEEN 500 AND 599 THEN 'upstream_5xx' WHEN context = 'media' THEN 'media_probe_failed' ELSE 'schema_incompatible' END AS reason
FROM (SELECT unnest({_CODES}) AS status) CROSS JOIN (SELECT unnest(['probe', 'media', 'upstream']) AS context)""",
)
def http_status_reason(spark, sf_dir):
    df = _cross(spark, status=_CODES, context=["probe", "media", "upstream"])
    of = lambda c: policy.http_reason(F.col("status"), c)
    return df.withColumn("reason", F.when(F.col("context") == "probe", of("probe")).when(F.col("context") == "media", of("media")).otherwise(of("upstream")))


@query(
    "reason_to_status",
    f"""SELECT reason, previous, source_status, CASE WHEN reason IN {_list(S.KEEPS_STATUS)} THEN previous WHEN reason IN {_list(S.CLIENT_LIMITS)} THEN 'partial' WHEN reason IN {_list(S.HARD_FAILURES)} THEN 'dead' WHEN reason IN {_list(S.TEMPORARY_FAILURES)} THEN 'suspect' WHEN reason = 'unsupported_environment' THEN reason WHEN source_status = 'dead' THEN 'dead' ELSE 'suspect' END AS technical_status
FROM (SELECT unnest({S.FAILURES}) AS reason) CROSS JOIN (SELECT unnest({S.TECHNICAL}) AS previous) CROSS JOIN (SELECT unnest(['dead', 'healthy']) AS source_status)""",
)
def reason_to_status(spark, sf_dir):
    df = _cross(spark, reason=S.FAILURES, previous=S.TECHNICAL, source_status=["dead", "healthy"])
    return df.withColumn("technical_status", policy.technical_for_failure(F.col("reason"), F.col("previous"), F.col("source_status")))


@query(
    "publication_matrix",
    f"""SELECT rights, technical, kind, site_type, reason, CASE WHEN rights IN ('restricted', 'takedown') OR kind = 'spider' OR site_type = 3 OR reason IN {_list(S.REJECTING)} THEN 'rejected' WHEN reason IN {_list(S.WITHHOLDING)} OR rights = 'unknown' THEN 'withheld' WHEN technical = 'healthy' THEN CASE WHEN kind = 'vod' AND site_type = 4 THEN 'experimental' ELSE 'stable' END WHEN technical = 'partial' AND kind <> 'live' THEN 'experimental' ELSE 'withheld' END AS publication
FROM (SELECT unnest({S.RIGHTS}) AS rights) CROSS JOIN (SELECT unnest({S.TECHNICAL}) AS technical) CROSS JOIN (SELECT unnest(['vod', 'live', 'spider']) AS kind) CROSS JOIN (SELECT unnest([0, 1, 3, 4]) AS site_type) CROSS JOIN (SELECT unnest(['none', 'takedown', 'terms_changed', 'http_404', 'client_http_disallowed']) AS reason)""",
)
def publication_matrix(spark, sf_dir):
    df = _cross(spark, rights=S.RIGHTS, technical=S.TECHNICAL, kind=["vod", "live", "spider"], site_type=[0, 1, 3, 4], reason=["none", "takedown", "terms_changed", "http_404", "client_http_disallowed"])
    c = F.col
    return df.withColumn("publication", policy.publication_for(c("rights"), c("technical"), c("kind"), c("site_type"), F.lit(True), c("reason")))


@query(
    "due_decision_240h",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'forced' WHEN o_orderstatus = 'P' THEN 'recovery_due' WHEN o_orderdate <= TIMESTAMP '1997-01-01' - INTERVAL 240 HOUR THEN 'elapsed_240h' ELSE 'not_due' END AS reason FROM orders""",
)
def due_decision_240h(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "P", "safety").otherwise("regular")
    due = policy.due_decision(F.lit("1997-01-01").cast("timestamp"), F.col("o_orderdate").cast("timestamp"), kind, F.col("o_orderkey") % 50 == 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", due.alias("reason"))


@query("m3u_parse")
def m3u_parse(spark, sf_dir):
    """A playlist a conversation: its turns as entries."""
    line = F.concat(F.lit('#EXTINF:-1 tvg-id="T'), F.col("turn").cast("string"), F.lit('" group-title="'), F.col("role"), F.lit('",Name '), F.col("turn").cast("string"), F.lit("\nhttps://h.test/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))).alias("x"))
    text = F.concat(F.lit("#EXTM3U\n"), F.array_join(F.transform("x", lambda e: e["l"]), "\n"))
    return parse.m3u_entries(lists.select(F.col("conv_id").cast("string").alias("source_id"), text.cast("binary").alias("content")))


@query("txt_live_parse")
def txt_live_parse(spark, sf_dir):
    """Turns of the user as groups, of the assistant as entries."""
    line = F.when(F.col("role") == "user", F.concat(F.lit("G"), F.col("turn").cast("string"), F.lit(",#genre#"))).otherwise(F.concat(F.lit("N,https://h.test/"), F.col("turn").cast("string")))
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))).alias("x"))
    return parse.txt_live(lists.select(F.col("conv_id").cast("string").alias("source_id"), F.array_join(F.transform("x", lambda e: e["l"]), "\n").alias("content")))


@query("public_ip")
def public_ip(spark, sf_dir):
    rows = spark.createDataFrame([("8.8.8.8",), ("10.0.0.1",), ("127.0.0.1",), ("::1",), ("::ffff:10.0.0.1",), ("2001:4860:4860::8888",), ("example.test",)], "address string")
    return rows.withColumn("public", urls.public_address("address"))


@query("nfkc_channel_identity")
def nfkc_channel_identity(spark, sf_dir):
    from siftspark.functions import ids

    rows = spark.createDataFrame([("ＣＣＴＶ１", "a", "x"), ("cctv1", "b", "y"), ("", "a", " News　One "), ("", "b", "News One")], "tvg string, source string, name string")
    key = ids.channel_key(ids.ascii_lower(ids.nfkc("tvg")), F.col("source"), ids.one_spaced("name"))
    return rows.select("source", key.alias("identity"), ids.channel_id(key).alias("channel_id"))


@query("media_sniff")
def media_sniff(spark, sf_dir):
    rows = spark.createDataFrame([(bytearray(b"\x47" + b"\0" * 187 + b"\x47" + b"\0" * 187),), (bytearray(b"FLV\x01\x05"),), (bytearray(b"<html>"),), (bytearray(b"\x1aE\xdf\xa3"),)], "body binary")
    return rows.select(F.hex(F.substring("body", 1, 4)).alias("head"), parse.media_kind("body").alias("kind"))


@query("json5_parse")
def json5_parse(spark, sf_dir):
    rows = spark.createDataFrame([("{a: 1, 'b': [1, 2,], // note\n}",), ('{"a": 1, "a": 2}',), ("{/* x */ c: +3, d: .5}",)], "text string")
    return rows.withColumn("json", parse.json5("text"))


@query("xml_parse")
def xml_parse(spark, sf_dir):
    body = '<rss><list><video><id>1</id><name>A</name><dl><dd flag="x">e$https://h.test/1</dd></dl></video></list></rss>'
    rows = spark.createDataFrame([(body,), ("<!DOCTYPE a><rss/>",)], "text string")
    return rows.select(parse.maccms_xml(F.col("text")).alias("r")).select(F.to_json("r").alias("parsed"))


@query("hls_parse")
def hls_parse(spark, sf_dir):
    media_ = "#EXTM3U\n#EXT-X-TARGETDURATION:6\n#EXTINF:5.0,\nseg0.ts\n"
    master = "#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=3000000,RESOLUTION=1920x1080\nhi.m3u8\n"
    rows = spark.createDataFrame([(media_,), (master,), ("nothing",)], "text string")
    return rows.select(parse.hls("text").alias("h")).select("h.*")


@query(
    "ext_grouping_sets_status",
    "SELECT event_type, user_id % 10 AS shard, count(*) AS n FROM events GROUP BY GROUPING SETS ((event_type), (user_id % 10), ())",
)
def ext_grouping_sets_status(spark, sf_dir):
    """Not of the reference: roll-ups over several groupings at once."""
    df = table(spark, sf_dir, "events").withColumn("shard", F.col("user_id") % 10)
    return df.groupingSets([["event_type"], ["shard"], []], "event_type", "shard").agg(F.count("*").alias("n"))


@query(
    "ext_tumbling_window_counts",
    "SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def ext_tumbling_window_counts(spark, sf_dir):
    """Not of the reference: events by hour."""
    return table(spark, sf_dir, "events").groupBy(F.unix_timestamp(F.date_trunc("hour", "ts")).alias("hour"), "event_type").agg(F.count("*").alias("n"))


@query(
    "ext_asof_previous_success",
    "SELECT event_id, max(CASE WHEN event_type = 'purchase' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM events",
)
def ext_asof_previous_success(spark, sf_dir):
    """Not of the reference: the last success before each event."""
    by = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, sf_dir, "events").select("event_id", F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).over(by).alias("previous"))
