"""Queries of crawls, chains, numbering, names, nested values, schemas and pattern searches."""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import functions as F

from siftspark.functions import decode
from siftspark.operators import crawl, merkle, names, numbering, patterns, redirects, walk
from siftspark.plans.registry import query
from siftspark.plans.tables import OBSERVATIONS, observed
from siftspark.session import shared_place, table
from siftspark.streaming import tracker
from siftspark.validate import schema

#: A document's path in its source's repository is its third word; of several documents of a path the first is the file.
_FILES = """words AS (SELECT doc_id, source, unnest(string_split(text, ' ')) AS w FROM documents WHERE text IS NOT NULL AND source IS NOT NULL),
named AS (SELECT doc_id, source, lang, string_split(text, ' ')[3] AS path FROM documents WHERE source IS NOT NULL),
file AS (SELECT source, path, min(doc_id) AS doc_id FROM named WHERE path IS NOT NULL GROUP BY ALL),
roots AS (SELECT DISTINCT source, arg_min(path, doc_id) AS path FROM named WHERE lang IS NOT NULL AND path IS NOT NULL GROUP BY source, lang)"""


@query(
    "crawl_frontier",
    f"""WITH RECURSIVE {_FILES},
edge AS (SELECT DISTINCT f.source, f.path, g.path AS next_path FROM file f JOIN words w USING (doc_id) JOIN file g ON g.source = f.source AND g.path = w.w),
reach(source, path, depth) AS (SELECT source, path, 0 FROM roots UNION SELECT e.source, e.next_path, depth + 1 FROM reach r JOIN edge e ON e.source = r.source AND e.path = r.path WHERE depth < 3),
least AS (SELECT source, path, min(depth) AS depth FROM reach GROUP BY ALL),
state AS (SELECT source, count(*) AS n, bool_or(depth = 3 AND (source, path) IN (SELECT (source, path) FROM edge)) AS deep FROM least GROUP BY source)
SELECT source, path, CAST(depth AS INTEGER) AS depth, CAST(n AS INTEGER) AS files_scanned, CASE WHEN deep THEN 'catalog_depth_exceeded' END AS outcome FROM least JOIN state USING (source) WHERE n <= 25
UNION ALL SELECT source, NULL, NULL, 26, 'catalog_limit_exceeded' FROM state WHERE n > 25""",
)
def crawl_frontier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null and source is not null")
    named = docs.select("doc_id", "source", "lang", F.get(F.split("text", " "), F.lit(2)).alias("path")).where("path is not null")
    files = named.groupBy("source", "path").agg(F.min("doc_id").alias("doc_id"))
    roots = named.where("lang is not null").groupBy("source", "lang").agg(F.min_by("path", "doc_id").alias("path")).select(F.col("source").alias("source_id"), "path")
    tree = files.join(docs.select("doc_id", "text"), "doc_id").select(F.col("source").alias("repository"), F.lit("1").alias("revision"), "path", F.col("text").alias("content"))
    sources = docs.select("source").distinct().select(F.col("source").alias("source_id"), F.col("source").alias("repository"), F.lit("1").alias("revision"), F.lit(3).alias("max_depth"), F.lit(25).alias("max_files"))
    names = files.select(F.col("source").alias("repository"), F.col("path").alias("next_path"))

    def read(reached):
        """Words that name a file of the same repository."""
        every = reached.select("source_id", "repository", "path", F.posexplode(F.split("content", " ")).alias("ordinal", "next_path"))
        once = every.groupBy("source_id", "repository", "path", "next_path").agg(F.min("ordinal").alias("ordinal"))
        none = F.lit(None)
        return once.join(names, ["repository", "next_path"]).select("source_id", "path", F.lit("depot").alias("kind"), "ordinal", none.cast("int").alias("type"), F.col("next_path").alias("url"), F.lit(False).alias("executable"), none.cast("string").alias("issue"), "next_path")

    found = crawl.crawl(sources, roots, tree, read)
    over = found.outcomes.where("failure_reason = 'catalog_limit_exceeded'")
    within = found.files.join(found.outcomes.where("not inconclusive"), "source_id")
    rows = within.select(F.col("source_id").alias("source"), "path", "depth", "files_scanned", F.col("failure_reason").alias("outcome"))
    return rows.unionByName(over.select(F.col("source_id").alias("source"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("int").alias("depth"), "files_scanned", F.col("failure_reason").alias("outcome")))


@query(
    "byte_budget",
    """SELECT doc_id, CAST(sum(coalesce(strlen(text), 0)) OVER (ORDER BY doc_id) AS BIGINT) AS used, sum(coalesce(strlen(text), 0)) OVER (ORDER BY doc_id) <= (SELECT sum(strlen(text)) // 2 FROM documents) AS fits FROM documents""",
)
def byte_budget(spark, sf_dir):
    """Which documents a budget of half of all bytes covers, in order."""
    sized = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("size"))
    budget = sized.agg(F.sum("size")).first()[0] // 2
    return numbering.within_budget(sized, [F.asc("doc_id")], F.col("size"), budget).select("doc_id", "used", "fits")


_BASES = "SELECT item_id, CASE WHEN item_id % 5 = 0 THEN brand || '_' || (item_id % 7 + 2) ELSE brand END AS base FROM items"


@query(
    "first_free_names",
    f"""WITH x AS ({_BASES}), r AS (SELECT item_id, base, row_number() OVER (PARTITION BY base ORDER BY item_id) - 1 AS k FROM x WHERE base IS NOT NULL),
n AS (SELECT base, n, row_number() OVER (PARTITION BY base ORDER BY n) AS k FROM (SELECT base, unnest(range(2, count(*) + 50)) AS n FROM x GROUP BY base) WHERE base || '_' || n NOT IN (SELECT base FROM x WHERE base IS NOT NULL))
SELECT item_id, CASE WHEN k = 0 THEN base ELSE base || '_' || n END AS client_key FROM r LEFT JOIN n USING (base, k) UNION ALL SELECT item_id, NULL FROM x WHERE base IS NULL""",
)
def first_free_names(spark, sf_dir):
    """Names of items, the brand or the brand with a number, made unique: a brand's repeats skip numbers that other items have."""
    base = F.when(F.col("item_id") % 5 == 0, F.concat("brand", F.lit("_"), (F.col("item_id") % 7 + 2).cast("string"))).otherwise(F.col("brand"))
    items = table(spark, sf_dir, "items").select("item_id", base.alias("base"))
    return names.first_free(items, "base", ["item_id"], "client_key").select("item_id", "client_key")


@query(
    "redirect_chains",
    """WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages),
l AS (SELECT p.url, q.url AS location FROM pages p CROSS JOIN n JOIN pages q ON q.page_id = (p.page_id * 7 + length(p.url)) % n.n WHERE p.page_id % 5 <> 0),
c AS (SELECT page_id, url AS node, 0 AS hops, [url] AS path, CAST(NULL AS VARCHAR) AS reason FROM pages
  UNION ALL SELECT page_id, location, hops + 1, list_append(path, location), CASE WHEN hops + 1 <= 5 AND contains(location, 'example.net/de') THEN 'redirect_refused' WHEN list_contains(path, location) THEN 'redirect_loop' WHEN hops + 1 > 5 THEN 'redirect_limit' END FROM c JOIN l ON l.url = c.node WHERE reason IS NULL)
SELECT page_id, max(hops) AS hops, arg_max(reason, hops) FILTER (reason IS NOT NULL) AS reason, CASE WHEN bool_and(reason IS NULL) THEN arg_max(node, hops) END AS final_url FROM c GROUP BY page_id""",
)
def redirect_chains(spark, sf_dir):
    """Where each page's address ends if four of five pages send on to another one."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    count = pages.count()
    onward = pages.where("page_id % 5 <> 0").select("url", ((F.col("page_id") * 7 + F.length("url")) % F.lit(count)).alias("to"))
    hops = onward.join(pages.select(F.col("page_id").alias("to"), F.col("url").alias("location")), "to").select("url", "location")
    return redirects.branches(pages, hops, ~F.col("_to").contains("example.net/de")).select("page_id", "hops", "reason", "final_url")


@query(
    "nested_scalars",
    """SELECT click_id, replace(replace(replace(substr(fullkey, 2), '.', '/'), '[', '/'), ']', '') AS path, CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'number' END AS kind,
CASE WHEN type NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN atom ->> '$' END AS scalar FROM (SELECT click_id, props FROM clicks WHERE json_valid(props)) c, json_tree(c.props) t""",
)
def nested_scalars(spark, sf_dir):
    """Every value inside the clicks' properties with its path."""
    rows = walk.walk(_parsed_clicks(spark, sf_dir), ["click_id"], "v")
    return rows.select("click_id", "path", "kind", "scalar")


#: What a click's properties should look like.
CLICK_SCHEMA = {
    "type": "object", "required": ["k", "device"], "additionalProperties": False,
    "properties": {
        "k": {"type": "integer", "minimum": 0, "maximum": 94}, "tags": {"type": "array", "items": {"type": "string", "minLength": 2}}, "items": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/item"}},
        "device": {"type": "object", "required": ["os", "ver"], "properties": {"os": {"enum": ["ios", "android", "web"]}, "ver": {"type": "string", "pattern": r"^[0-4]\.[0-9]+$"}}},
    },
    "$defs": {"item": {"type": "object", "required": ["sku", "qty"], "properties": {"sku": {"type": "integer"}, "qty": {"anyOf": [{"const": 1}, {"type": "integer", "minimum": 3}]}}}},
}


@query(
    "schema_violations",
    r"""WITH c AS (SELECT click_id, CAST(props AS JSON) AS v FROM clicks WHERE json_valid(props)), top AS (SELECT click_id, v, unnest(json_keys(v)) AS n FROM c),
i AS (SELECT click_id, pos - 1 AS pos, json_extract(v, '$.items[' || (pos - 1) || ']') AS x FROM (SELECT click_id, v, unnest(range(1, CAST(json_array_length(v, '$.items') AS BIGINT) + 1)) AS pos FROM c WHERE json_type(v, '$.items') = 'ARRAY')),
t AS (SELECT click_id, pos - 1 AS pos, json_extract(v, '$.tags[' || (pos - 1) || ']') AS x FROM (SELECT click_id, v, unnest(range(1, CAST(json_array_length(v, '$.tags') AS BIGINT) + 1)) AS pos FROM c WHERE json_type(v, '$.tags') = 'ARRAY'))
SELECT click_id, '/k' AS path, 'required' AS rule FROM c WHERE json_type(v, '$.k') IS NULL
UNION ALL SELECT click_id, '/device', 'required' FROM c WHERE json_type(v, '$.device') IS NULL
UNION ALL SELECT click_id, '/' || n, 'additionalProperties' FROM top WHERE n NOT IN ('k', 'tags', 'items', 'device')
UNION ALL SELECT click_id, '/k', 'type' FROM c WHERE json_type(v, '$.k') NOT IN ('UBIGINT', 'BIGINT')
UNION ALL SELECT click_id, '/k', 'maximum' FROM c WHERE json_type(v, '$.k') IN ('UBIGINT', 'BIGINT') AND CAST(v ->> '$.k' AS BIGINT) > 94
UNION ALL SELECT click_id, '/tags', 'type' FROM c WHERE json_type(v, '$.tags') <> 'ARRAY'
UNION ALL SELECT click_id, '/items', 'type' FROM c WHERE json_type(v, '$.items') <> 'ARRAY'
UNION ALL SELECT click_id, '/device', 'type' FROM c WHERE json_type(v, '$.device') <> 'OBJECT'
UNION ALL SELECT click_id, '/items', 'minItems' FROM c WHERE json_type(v, '$.items') = 'ARRAY' AND json_array_length(v, '$.items') = 0
UNION ALL SELECT click_id, '/tags/' || pos, 'type' FROM t WHERE json_type(x) <> 'VARCHAR'
UNION ALL SELECT click_id, '/tags/' || pos, 'minLength' FROM t WHERE json_type(x) = 'VARCHAR' AND length(x ->> '$') < 2
UNION ALL SELECT click_id, '/device/' || n, 'required' FROM c, (VALUES ('os'), ('ver')) r(n) WHERE json_type(v, '$.device') = 'OBJECT' AND json_type(v, '$.device.' || n) IS NULL
UNION ALL SELECT click_id, '/device/os', 'enum' FROM c WHERE json_type(v, '$.device.os') IS NOT NULL AND coalesce(v ->> '$.device.os', '') NOT IN ('ios', 'android', 'web')
UNION ALL SELECT click_id, '/device/ver', 'type' FROM c WHERE json_type(v, '$.device.ver') <> 'VARCHAR'
UNION ALL SELECT click_id, '/device/ver', 'pattern' FROM c WHERE json_type(v, '$.device.ver') = 'VARCHAR' AND NOT regexp_matches(v ->> '$.device.ver', '^[0-4]\.[0-9]+$')
UNION ALL SELECT click_id, '/items/' || pos, 'type' FROM i WHERE json_type(x) <> 'OBJECT'
UNION ALL SELECT click_id, '/items/' || pos || '/' || n, 'required' FROM i, (VALUES ('sku'), ('qty')) r(n) WHERE json_type(x) = 'OBJECT' AND json_type(x, '$.' || n) IS NULL
UNION ALL SELECT click_id, '/items/' || pos || '/sku', 'type' FROM i WHERE json_type(x, '$.sku') NOT IN ('UBIGINT', 'BIGINT')
UNION ALL SELECT click_id, '/items/' || pos || '/qty', 'anyOf' FROM i WHERE json_type(x, '$.qty') IS NOT NULL AND NOT (json_type(x, '$.qty') IN ('UBIGINT', 'BIGINT') AND (CAST(x ->> '$.qty' AS BIGINT) = 1 OR CAST(x ->> '$.qty' AS BIGINT) >= 3))""",
)
def schema_violations(spark, sf_dir):
    """What of the clicks' properties breaks their schema, and where."""
    clicks = _parsed_clicks(spark, sf_dir).where("v is not null")
    # The outer form: for the inner one Spark infers filters that work the whole expression out again.
    rows = clicks.select("click_id", F.explode_outer(schema.violations(F.col("v"), CLICK_SCHEMA)).alias("x")).where("x is not null")
    return rows.select("click_id", "x.path", "x.rule")


_PATTERNS = """p AS (SELECT 'item:' || item_id AS rule, array_to_string(list_slice(string_split(text, ' '), 2, 6), ' ') AS pattern FROM benchmark
UNION SELECT 'host:' || n_name, lower(n_name) FROM nation UNION SELECT 'mail:' || i, '@mail' || i || '.example.com' FROM (SELECT unnest(range(10)) AS i) UNION SELECT 'word:' || i, 'er' || i FROM (SELECT unnest(range(10)) AS i))"""


@query(
    "texts_with_patterns",
    f"""WITH {_PATTERNS} SELECT doc_id, rule, (strlen(text) - strlen(replace(text, pattern, ''))) // strlen(pattern) AS hits FROM documents, p WHERE length(pattern) > 0 AND contains(text, pattern)""",
)
def texts_with_patterns(spark, sf_dir):
    """Documents that hold a phrase of a benchmark item, a name or a host, wherever it stands, and how often."""
    phrase = F.array_join(F.slice(F.split("text", " "), 2, 5), " ")
    rules = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("item:"), F.col("item_id").cast("string")).alias("rule"), phrase.alias("pattern"))
    rules = rules.union(table(spark, sf_dir, "nation").select(F.concat(F.lit("host:"), "n_name"), F.lower("n_name")))
    digits = spark.range(10).select(F.col("id").cast("string").alias("i"))
    rules = rules.union(digits.select(F.concat(F.lit("mail:"), "i"), F.concat(F.lit("@mail"), "i", F.lit(".example.com")))).union(digits.select(F.concat(F.lit("word:"), "i"), F.concat(F.lit("er"), "i")))
    found = patterns.search(table(spark, sf_dir, "documents"), rules, "doc_id", "text", "rule", "pattern")
    return found.select(F.col("key").alias("doc_id"), "rule", "hits")


@query(
    "tracked_streaks",
    f"""WITH {OBSERVATIONS}, a AS (SELECT *, technical_status = 'healthy' AS ok, sum(CASE WHEN technical_status = 'healthy' THEN 0 ELSE 1 END) OVER w AS breaks, sum(CASE WHEN technical_status = 'healthy' THEN 1 ELSE 0 END) OVER w AS wins,
  max(CASE WHEN technical_status = 'healthy' THEN ts END) OVER w AS last_at FROM obs WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY entity_id ORDER BY ts, event_id))
SELECT event_id, CAST(CASE WHEN ok THEN row_number() OVER (PARTITION BY entity_id, breaks, ok ORDER BY ts, event_id) ELSE 0 END AS BIGINT) AS consecutive_successes,
  CAST(CASE WHEN ok THEN 0 ELSE row_number() OVER (PARTITION BY entity_id, wins, ok ORDER BY ts, event_id) END AS BIGINT) AS consecutive_failures, CAST(epoch_us(last_at) AS BIGINT) AS last_success_us FROM a""",
)
def tracked_streaks(spark, sf_dir):
    """Streaks after every observation, by keyed state in a stream."""
    convert = lambda rows: observed(rows).where("ts is not null").withColumn("ts", F.col("ts").cast("timestamp"))
    states = tracker.replayed(spark, f"{sf_dir}/events.parquet", convert, f"{shared_place(spark)}/tracked-{uuid.uuid4().hex}", late="36500 days")
    return states.select("event_id", "consecutive_successes", "consecutive_failures", F.unix_micros("last_success_at").alias("last_success_us"))


@query(
    "merkle_levels",
    r"""WITH f AS (SELECT 'texts/' || doc_id AS path, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
l AS (SELECT substr(sha256(path), 1, 2) AS prefix, sha256(string_agg(path || chr(0) || sha256, chr(10) ORDER BY path || chr(0) || sha256)) AS digest, count(*) AS files FROM f GROUP BY 1),
m AS (SELECT substr(prefix, 1, 1) AS prefix, sha256(string_agg(prefix || ':' || digest, chr(10) ORDER BY prefix)) AS digest, CAST(sum(files) AS BIGINT) AS files FROM l GROUP BY 1),
r AS (SELECT '' AS prefix, sha256(string_agg(prefix || ':' || digest, chr(10) ORDER BY prefix)) AS digest, CAST(sum(files) AS BIGINT) AS files FROM m)
SELECT 2 AS level, prefix, digest, files FROM l UNION ALL SELECT 1, prefix, digest, files FROM m UNION ALL SELECT 0, prefix, digest, files FROM r""",
)
def merkle_levels(spark, sf_dir):
    """The tree over all texts as files, two digits deep."""
    return merkle.tree(_files(table(spark, sf_dir, "documents"), F.col("text")), 2)


def _parsed_clicks(spark, sf_dir):
    """Clicks with valid properties, parsed; dealt out first, since a file's few row groups would keep all the work in as many tasks."""
    clicks = table(spark, sf_dir, "clicks").select("click_id", "props").repartition("click_id", "props")
    return clicks.select("click_id", F.try_parse_json("props").alias("v"))


def _files(docs, content):
    return docs.where("text is not null and doc_id is not null").select(F.concat(F.lit("texts/"), F.col("doc_id").cast("string")).alias("path"), F.sha2(content, 256).alias("sha256"))


@query(
    "merkle_changes",
    """SELECT 'texts/' || doc_id AS path, CASE WHEN doc_id % 97 = 5 THEN 'removed' ELSE 'changed' END AS change FROM documents WHERE text IS NOT NULL AND (doc_id % 97 = 5 OR doc_id % 101 = 7)""",
)
def merkle_changes(spark, sf_dir):
    """Which texts differ between all of them and a copy in which some are missing and some have a full stop more, found from the roots down."""
    docs = table(spark, sf_dir, "documents")
    one = _files(docs, F.col("text"))
    two = _files(docs.where("doc_id % 97 <> 5"), F.when(F.col("doc_id") % 101 == 7, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    leaves = merkle.changed_leaves(merkle.tree(one, 3), merkle.tree(two, 3), 3)
    return merkle.changed_files(one, two, leaves, 3)


@query(
    "bounded_bodies",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'unsupported_encoding' WHEN doc_id % 7 = 3 AND doc_id % 5 <> 0 THEN 'truncated_body' WHEN strlen(text) > 20000 THEN 'response_too_large' END AS reason,
CASE WHEN doc_id % 5 <> 4 AND NOT (doc_id % 7 = 3 AND doc_id % 5 <> 0) AND strlen(text) <= 20000 THEN sha256(text) END AS sha256 FROM documents WHERE length(text) > 0""",
)
def bounded_bodies(spark, sf_dir):
    """Texts as bodies under an encoding each, some cut short, decoded within 20,000 bytes."""
    docs = table(spark, sf_dir, "documents").where("length(text) > 0").select("doc_id", F.col("text").cast("binary").alias("body"))
    kind = F.element_at(F.array(*map(F.lit, ["identity", "GZIP ", "deflate", "raw", "br"])), (F.col("doc_id") % 5 + 1).cast("int"))

    def packed(batches):
        for pdf in batches:
            bodies = []
            for key, body, name in zip(pdf["doc_id"], pdf["body"], pdf["kind"], strict=True):
                bits = {"GZIP ": 31, "deflate": 15, "raw": -15}.get(name)
                engine = zlib.compressobj(wbits=bits) if bits else None
                sent = engine.compress(bytes(body)) + engine.flush() if engine else bytes(body)
                bodies.append(sent[: max(2, len(sent) - 9)] if key % 7 == 3 and engine else sent)
            yield pdf.assign(body=bodies)

    sent = docs.withColumn("kind", kind).mapInPandas(packed, "doc_id long, body binary, kind string")
    name = F.when(F.col("kind") == "raw", "deflate").when(F.col("kind") != "identity", F.col("kind"))
    read = sent.select("doc_id", decode.decoded(F.col("body"), name, 1 << 30, 20_000).alias("d"))
    return read.select("doc_id", "d.reason", F.when(F.col("d.body").isNotNull(), F.sha2("d.body", 256)).alias("sha256"))
